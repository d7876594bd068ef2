"""Text columns to typed columns, with the rows that do not cast kept apart.

All conversions are `try_` forms: a bad value becomes null, and a row whose
non-null text became null (or whose key has not the expected shape) is
quarantined as it came.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from silverline.functions.reference import UUID_PATTERN


def try_long(c: str) -> Column:
    return F.trim(c).try_cast("bigint")


def try_int(c: str) -> Column:
    return F.trim(c).try_cast("int")


def try_double(c: str) -> Column:
    return F.trim(c).try_cast("double")


def try_day(c: str) -> Column:
    return F.trim(c).try_cast("date")


def try_instant(c: str) -> Column:
    """ISO text with an offset (or Z) as UTC wall time."""
    return F.to_utc_timestamp(F.trim(c).try_cast("timestamp"), F.current_timezone()).cast("timestamp_ntz")


def is_uuid(c: str) -> Column:
    return F.trim(c).rlike(f"^{UUID_PATTERN}$")


def cast_columns(text: DataFrame, casts: dict[str, Column], checks: dict[str, Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """(typed rows, rows as they came that fail): `casts` maps columns of `text`
    to their typed form, `checks` columns to a condition on their text."""
    failed = F.lit(False)
    for name, typed in casts.items():
        failed = failed | (F.col(name).isNotNull() & typed.isNull())
    for condition in (checks or {}).values():
        failed = failed | ~F.coalesce(condition, F.lit(False))
    good = text.where(~failed).select(*[casts.get(c, F.col(c)).alias(c) for c in text.columns])
    return good, text.where(failed)
