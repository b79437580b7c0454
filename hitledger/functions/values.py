"""Cast rules: text captured from a log line -> typed value, NULL where it does not parse."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hitledger.functions import patterns as P

_ABSENT = ("", "-")
_CLOCK_FORMAT = "'['[dd/MMM/yyyy:HH:mm:ss][yyyy-MM-dd'T'HH:mm:ss] VV"


def absent_to_null(text: Column) -> Column:
    """Unmatched groups arrive as ``''``, fields the server left out as ``-``."""
    return F.when(~text.isin(*_ABSENT), text)


def flag(text: Column) -> Column:
    return F.when(text.isin("true", "1"), True).when(text.isin("false", "0"), False)


def utc_time(text: Column) -> Column:
    """``[dd/Mon/yyyy:HH:MM:SS +hhmm]`` or ``[yyyy-mm-ddTHH:MM:SS+hh:mm]`` -> UTC wall clock.

    Both shapes end in seven characters of offset. The clock before it is read as UTC, the
    offset is plain arithmetic on its digits, because Spark's own offset pattern refuses
    what lies beyond 18 hours. The session time zone plays no part.
    """
    clock = F.concat(F.substring(text, F.lit(1), F.length(text) - 7), F.lit(" UTC"))
    local = F.unix_seconds(F.try_to_timestamp(clock, F.lit(_CLOCK_FORMAT)))
    digits = F.translate(F.right(text, F.lit(7)), " :]", "").try_cast("int")
    # signed hhmm: a unit is 36 seconds, which leaves 24 to each minute
    offset = digits * 36 + digits % 100 * 24
    start = F.lit("1970-01-01").cast("timestamp_ntz")
    utc = start + (local - offset).cast("interval second")
    return F.when(text.rlike(P.LOG_TIME), utc)


# Each takes a captured text that is NULL where the field is absent.
CASTS = {
    "text": lambda text: text,
    "time": utc_time,
    "long": lambda text: text.try_cast("bigint"),
    "double": lambda text: text.try_cast("double"),
    "flag": flag,
}


def server_of(file_name: Column) -> Column:
    return F.nullif(F.regexp_extract(file_name, P.SERVER_IN_NAME, 1), F.lit(""))


def month_day(ts: Column) -> Column:
    """``MM/DD``, NULL for no time."""
    return F.concat(
        F.lpad(F.month(ts).cast("string"), 2, "0"),
        F.lit("/"),
        F.lpad(F.day(ts).cast("string"), 2, "0"),
    )


def human_bytes(count: Column) -> Column:
    """``1536.0 -> 1.5 KB``: divide by 1024 while above 999, one decimal, ties to even."""
    value = count.cast("double")
    steps = sum(
        (
            F.when(value / F.lit(float(1024**i)) > 999, 1).otherwise(0)
            for i in range(len(P.BYTE_UNITS) - 1)
        ),
        F.lit(0),
    )
    scaled = value / F.pow(F.lit(1024.0), steps)
    units = F.array(*[F.lit(u) for u in P.BYTE_UNITS])
    # printf rounds the exact binary value; doubles below 1000 are exact as decimal(38,30)
    shown = F.bround(scaled.cast("decimal(38,30)"), 1).cast("decimal(6,1)")
    return F.concat_ws(" ", shown.cast("string"), F.element_at(units, steps + 1))
