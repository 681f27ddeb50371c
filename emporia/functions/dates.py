"""Date / time expressions: tolerant parsing, integer date keys, calendar
parts, elapsed days and a day series.

Timestamps are TIMESTAMP_NTZ throughout (wall-clock, no zone), so results do
not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Output formats of the date dimension.
DATE_KEY_PATTERN = "yyyyMMdd"
MONTH_NAME_PATTERN = "MMMM"
SECONDS_PER_DAY = 24.0 * 3600.0


def parse_timestamp(c: Column | str, source_type: T.DataType | None = None) -> Column:
    """String -> TIMESTAMP_NTZ; malformed text gives NULL instead of failing
    (ANSI mode raises on a bad CAST).  Already-typed input is only re-typed,
    so the step is idempotent."""
    col = F.col(c) if isinstance(c, str) else c
    if source_type is None or isinstance(source_type, T.StringType):
        return col.try_cast(T.TimestampNTZType())
    return col.cast(T.TimestampNTZType())


def parse_timestamps(df: DataFrame, columns: tuple[str, ...] | list[str]) -> DataFrame:
    """Replace each listed column by its parsed value in one projection."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({c: parse_timestamp(c, types.get(c)) for c in columns})


def date_key(c: Column | str) -> Column:
    """Date or timestamp -> INT key yyyyMMdd (the value of formatting with
    ``DATE_KEY_PATTERN``), computed arithmetically on the local date: no
    per-row string formatting and no dependence on the session zone."""
    d = F.to_date(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast(T.IntegerType())


def date_parts(c: Column | str) -> dict[str, Column]:
    """The seven derived columns of the date dimension (Sunday = 1)."""
    return {
        "date_key": date_key(c),
        "year": F.year(c),
        "month": F.month(c),
        "month_name": F.date_format(c, MONTH_NAME_PATTERN),
        "quarter": F.quarter(c),
        "day_of_week": F.dayofweek(c),
        "day_of_month": F.dayofmonth(c),
    }


def wall_seconds(c: Column | str) -> Column:
    """Whole seconds since 1970-01-01 00:00:00 of a wall-clock timestamp
    (BIGINT), from its date and time-of-day fields, so no session time zone
    (and no daylight-saving jump) takes part."""
    col = F.col(c) if isinstance(c, str) else c
    return (F.unix_date(F.to_date(col)).cast(T.LongType()) * 86400
            + F.hour(col) * 3600 + F.minute(col) * 60 + F.second(col))


def elapsed_days(start: Column | str, end: Column | str) -> Column:
    """Fractional days between two timestamps: (whole seconds of the end -
    whole seconds of the start) / 86400.  NULL if either side is NULL."""
    return ((wall_seconds(end) - wall_seconds(start)).cast(T.DoubleType())
            / F.lit(SECONDS_PER_DAY))


def date_series(first: Column | str, last: Column | str) -> Column:
    """One element per calendar day from ``first`` to ``last`` inclusive."""
    return F.sequence(F.col(first) if isinstance(first, str) else first,
                      F.col(last) if isinstance(last, str) else last,
                      F.expr("INTERVAL 1 DAY"))
