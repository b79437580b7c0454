"""Traffic of a download mirror: bytes served per day and in total."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitledger.functions import patterns as P
from hitledger.functions.values import human_bytes


def is_mirror_line(line: str = "line") -> Column:
    return F.col(line).rlike(P.MIRROR_PATHS)


def mirror_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    return lines.where(is_mirror_line(line))


def served_bytes(line: str = "line") -> Column:
    """Byte count of a successful GET; NULL for any other line or an oversized number."""
    return F.regexp_extract(F.col(line), P.MIRROR_SERVED, 1).try_cast("bigint")


def bytes_by_day(lines: DataFrame, line: str = "line", day: str = "day") -> DataFrame:
    """One row per day that has a log, 0 when nothing on it was served from the mirror."""
    amount = F.when(is_mirror_line(line), served_bytes(line)).cast("decimal(28,0)")
    return lines.groupBy(F.col(day).alias("day")).agg(
        F.coalesce(F.sum(amount), F.lit(0)).cast("decimal(38,0)").alias("bytes")
    )


def total_bytes(per_day: DataFrame) -> DataFrame:
    total = per_day.agg(F.coalesce(F.sum("bytes"), F.lit(0)).cast("decimal(38,0)").alias("bytes"))
    return total.withColumn("human", human_bytes(F.col("bytes")))
