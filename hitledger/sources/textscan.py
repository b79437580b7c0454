"""Text scans of log files."""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitledger.functions import patterns as P
from hitledger.sources.codecs import undecodable_files, with_codec
from hitledger.sources.listing import default_selection, list_files
from hitledger.sources.ranges import lines_by_range
from hitledger.stages import shared

# A compressed file of at least this size, and more than one core's share of the scan, is read by
# the members inside it, or has its lines spread if there is only one.
HEAVY_BYTES = 256 << 20
# Its lines get this many tasks per core's share, and no task more than 1 GB of text.
_TASKS_PER_SHARE = 4
_LINE_BYTES_PER_TASK = 1 << 30
_EXPANSION = 8


def without_carriage_return(line: Column) -> Column:
    return F.when(line.endswith("\r"), F.expr("left(value, length(value) - 1)")).otherwise(line)


def raw_lines(spark: SparkSession, paths: Sequence[str] | str) -> DataFrame:
    """``value`` and ``_metadata``: lines end at newline only."""
    reader = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True)
    return reader.text(paths if isinstance(paths, str) else list(paths))


def text_lines(spark: SparkSession, paths: Sequence[str] | str) -> DataFrame:
    """(value, src_path, src_file): one row per line, ended by newline only."""
    return raw_lines(spark, paths).select(
        without_carriage_return(F.col("value")).alias("value"),
        F.col("_metadata.file_path").alias("src_path"),
        F.col("_metadata.file_name").alias("src_file"),
    )


def lines_of_files(spark: SparkSession, files: DataFrame, sniff: bool = True) -> DataFrame | None:
    """Lines of the files in a listing; None if it is empty.

    A listing that already says how its files are packed (``with_codec``) is taken at its word; it
    should be a written table then. Tasks open the files themselves, large ones by byte ranges
    (``lines_by_range``), so that paths and lines stay out of the driver. Only for stores that nothing
    but Spark's own file systems can open, and without a look at the content (``sniff``), do paths
    go to Spark's text source, whose file index holds them in the driver.
    """
    if "as_named" not in files.columns:
        if not sniff:
            return _lines_by_spark(spark, files)
        files = shared(with_codec(files))
    readable = files.where("decodable")
    reached = lines_by_range(readable.where("reachable"), heavy_bytes(spark, readable))
    others = _lines_by_spark(spark, readable.where("not reachable"))
    parts = [p for p in (reached, others) if p is not None]
    if reached is not None:
        parts[0] = reached.withColumn("value", without_carriage_return(F.col("value")))
    return parts[0].unionByName(parts[1]) if len(parts) > 1 else parts[0] if parts else None


def heavy_bytes(spark: SparkSession, files: DataFrame) -> int:
    """Compressed files beyond this would outlast all others: an even share of the scan."""
    total = files.agg(F.coalesce(F.sum("src_bytes"), F.lit(0))).first()[0]
    return max(HEAVY_BYTES, total // spark.sparkContext.defaultParallelism)


def _lines_by_spark(spark: SparkSession, files: DataFrame) -> DataFrame | None:
    """The same by the text source, which trusts names and cannot split compressed files."""
    found = files.select("src_path", "src_bytes", F.col("src_file").rlike(r"\.(gz|zst|bz2)$").alias("compressed")).collect()
    if not found:
        return None
    share = sum(r.src_bytes for r in found) / spark.sparkContext.defaultParallelism
    big = [r for r in found if r.compressed and r.src_bytes > max(HEAVY_BYTES, share)]
    light = [r.src_path for r in found if r not in big]
    parts = [text_lines(spark, light)] if light else []
    if big:
        size = sum(r.src_bytes for r in big)
        spread = max(_TASKS_PER_SHARE * size / share, size * _EXPANSION / _LINE_BYTES_PER_TASK)
        parts.append(text_lines(spark, [r.src_path for r in big]).repartition(math.ceil(spread)))
    return parts[0].unionByName(parts[1]) if len(parts) > 1 else parts[0]


def scan_directory(
    spark: SparkSession,
    directory: str,
    as_of: datetime,
    criteria: Column | None = None,
    sniff: bool = True,
) -> DataFrame | None:
    """Lines of the files in ``directory`` that meet ``criteria`` on the listing columns."""
    if criteria is None:
        criteria = default_selection(F.col("src_file"), as_of)
    return lines_of_files(spark, list_files(spark, directory).where(criteria), sniff)


def rejected_files(spark: SparkSession, directory: str) -> DataFrame:
    return undecodable_files(with_codec(list_files(spark, directory)))


def mirror_day(name: Column) -> Column:
    """Day of a daily mirror log, from the eight digits in its name."""
    return F.try_to_date(F.regexp_extract(name, r"(\d{8})", 1), "yyyyMMdd")


def in_mirror_window(day: Column, as_of: datetime, days: int = P.MIRROR_WINDOW_DAYS) -> Column:
    """From ``days`` days back up to yesterday."""
    today = F.lit(as_of).cast("date")
    return day.between(F.date_sub(today, days), F.date_sub(today, 1))


def mirror_files(
    spark: SparkSession, directory: str, as_of: datetime, days: int = P.MIRROR_WINDOW_DAYS
) -> DataFrame:
    """(day and listing) of the daily mirror logs in the window.

    Folders named by a day outside the window are not even listed; files of other days are not opened.
    """
    day = mirror_day(F.col("src_file"))
    listed = list_files(spark, directory, folders=day.isNull() | in_mirror_window(day, as_of, days))
    return listed.withColumn("day", day).where(in_mirror_window(F.col("day"), as_of, days))


def mirror_lines_of(spark: SparkSession, files: DataFrame) -> DataFrame:
    """(day, line) of listed mirror logs, packed in whatever way."""
    lines = lines_of_files(spark, files.drop("day"))
    if lines is None:
        return spark.createDataFrame([], "day date, line string")
    return lines.select(mirror_day(F.col("src_file")).alias("day"), F.col("value").alias("line"))


def mirror_scan(
    spark: SparkSession, directory: str, as_of: datetime, days: int = P.MIRROR_WINDOW_DAYS
) -> DataFrame:
    """(day, line) of the daily mirror logs in the window."""
    return mirror_lines_of(spark, mirror_files(spark, directory, as_of, days))
