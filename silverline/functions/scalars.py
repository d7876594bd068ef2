"""Scalar column helpers (all JVM-side built-ins, codegen friendly).

Each helper returns a Column so it composes inside one `select`; none of them
is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from silverline.functions.reference import CITY_PATTERN, STATE_ZIP_PATTERN

NEWLINE = "\n"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean(c) -> Column:
    """SQL trim: strips spaces only (not tabs/newlines), like the reference."""
    return F.trim(col(c))


def normalized(c) -> Column:
    return F.lower(F.trim(col(c)))


def upper_clean(c) -> Column:
    return F.upper(F.trim(col(c)))


def empty_to_null(c) -> Column:
    return F.nullif(col(c), F.lit(""))


def address_line(c, n: int) -> Column:
    """n-th line of a multi-line address; '' when the address has fewer lines
    (split_part never raises, unlike element_at under ANSI)."""
    return F.split_part(col(c), F.lit(NEWLINE), F.lit(n))


def city_of(line2) -> Column:
    return empty_to_null(F.regexp_extract(col(line2), CITY_PATTERN, 1))


def state_of(line2) -> Column:
    return empty_to_null(F.regexp_extract(col(line2), STATE_ZIP_PATTERN, 1))


def zip_of(line2) -> Column:
    return empty_to_null(F.regexp_extract(col(line2), STATE_ZIP_PATTERN, 2))


def year_diff(start, end) -> Column:
    """Calendar-boundary year difference (DuckDB date_diff('year') semantics),
    not whole elapsed years."""
    return F.year(col(end)) - F.year(col(start))


def age_group(birth, reference_date: str, width: int = 20) -> Column:
    """Bucket of `width` years; integer division truncates toward zero so
    dates after the reference fall in group 0."""
    diff = year_diff(birth, F.lit(reference_date).cast("date"))
    # x - x % w: remainder keeps the dividend's sign, so this truncates to 0.
    return diff - diff % F.lit(width)


def month_start(ts) -> Column:
    """First instant of the month as TIMESTAMP_NTZ (no session-zone round trip)."""
    return F.trunc(F.to_date(col(ts)), "MM").cast("timestamp_ntz")


def month_label(ts) -> Column:
    return F.date_format(col(ts), "yyyy-MM")


def day_of(ts) -> Column:
    return F.to_date(col(ts))


def days_between(start, end) -> Column:
    """date_diff('day', start::DATE, end::DATE)."""
    return F.datediff(F.to_date(col(end)), F.to_date(col(start)))
