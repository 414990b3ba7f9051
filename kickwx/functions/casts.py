"""Text-to-type conversions of the staging models, made safe under ANSI mode.

Bronze tables keep every source field as text. The conversions below never
raise on malformed text (they yield NULL), so one bad row cannot fail a large
job; the data-quality checks expose such NULLs instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The tokens pandas' CSV reader turns into missing values by
# default (the reference loads CSV files through pandas with dtype=str).
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]


def c(name_or_col) -> Column:
    return F.col(name_or_col) if isinstance(name_or_col, str) else name_or_col


def na_to_null(x) -> Column:
    """NULL for any NA token (exact, case-sensitive match), else the text."""
    x = c(x)
    return F.when(~x.isin(NA_TOKENS), x)


def empty_to_null(x) -> Column:
    return F.nullif(c(x), F.lit(""))


def trimmed_or_null(x) -> Column:
    """``NULLIF(TRIM(x), '')``."""
    return F.nullif(F.trim(c(x)), F.lit(""))


def to_int(x) -> Column:
    """Integer text -> int; '' and malformed -> NULL."""
    return empty_to_null(x).try_cast("int")


def to_id(x) -> Column:
    """Integer text -> bigint: ids outgrow 32 bits long before the tables do; '' and malformed -> NULL."""
    return empty_to_null(x).try_cast("bigint")


def to_int_via_double(x) -> Column:
    """'6.0' / '6.9' -> 6: through double, then truncate (the reference's toInt32(toFloat64(...)))."""
    return empty_to_null(x).try_cast("double").try_cast("int")


def to_decimal_5_2_trunc(x) -> Column:
    """Text -> decimal(5,2), dropping extra digits instead of rounding ('55.345' -> 55.34)."""
    d = empty_to_null(x).try_cast("decimal(20,6)")
    return (F.floor(d * F.lit(100)) / F.lit(100)).try_cast("decimal(5,2)")


def to_timestamp_ntz(x) -> Column:
    """'yyyy-MM-dd HH:mm:ss' text -> timestamp without time zone (UTC convention)."""
    return empty_to_null(x).try_cast("timestamp_ntz")


def start_of_hour(ts) -> Column:
    """Hour truncation of a timestamp_ntz, independent of the session time zone."""
    ts = c(ts)
    return F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.lit(0), F.lit(0))
