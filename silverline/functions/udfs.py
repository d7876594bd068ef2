"""ZIP extraction three ways.

The native expression is the default and stays inside whole-stage codegen.
The row-at-a-time Python UDF and the Arrow-batched pandas UDF exist to show
the same result and the cost of the Python boundary; use them only where no
built-in expression exists.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

from silverline.functions.reference import STATE_ZIP_PATTERN

DIGITS, CAPITALS = frozenset("0123456789"), frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
ZIP_LENGTH = 5


def zip_native(address) -> Column:
    """JVM regexp_extract; '' when there is no match."""
    col = F.col(address) if isinstance(address, str) else address
    return F.regexp_extract(col, STATE_ZIP_PATTERN, 2)


def trailing_zip(address: str | None) -> str:
    """The five digits that end the address, if a two-letter code and one
    space stand before them; else empty."""
    text = address or ""
    code, digits = text[-ZIP_LENGTH - 3:-ZIP_LENGTH], text[-ZIP_LENGTH:]
    ends_in_zip = len(digits) == ZIP_LENGTH and DIGITS.issuperset(digits)
    follows_code = len(code) == 3 and code[2] == " " and CAPITALS.issuperset(code[:2])
    return digits if ends_in_zip and follows_code else ""


def trailing_digits(addresses: pd.Series) -> pd.Series:
    """The five digits that end each address, whatever stands before them."""
    tail = addresses.astype("string").str.slice(start=-ZIP_LENGTH)
    is_zip = tail.map(lambda t: isinstance(t, str) and len(t) == ZIP_LENGTH and DIGITS.issuperset(t))
    return tail.where(is_zip.astype(bool), "").astype(object)


# UDF objects are built on call, not at import: Python workers import this
# module to unpickle the functions and have no SparkContext to build UDFs.


def zip_python_udf(address) -> Column:
    """one Python call per row."""
    return F.udf(trailing_zip, StringType())(address)


def zip_pandas_udf(address) -> Column:
    """vectorised over an Arrow batch. Matches only the ZIP tail (no state
    part), so it differs from F1 on malformed addresses."""
    return F.pandas_udf(trailing_digits, "string")(address)
