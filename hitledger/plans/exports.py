"""Sinks: report CSVs, the address-free export, anonymized logs and the mirror cache."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitledger.functions.layout import ACCESS_LOG, Layout
from hitledger.operators import counts, enrich, mirror, privacy
from hitledger.sources.tables import read_if_present
from hitledger.sources.textscan import mirror_files, mirror_lines_of
from hitledger.stages import shared

_DAY = T.StructType([T.StructField("day", T.DateType(), True)])
_LINES = T.StructType([T.StructField("line", T.StringType(), True), *_DAY])


def _csv(report: DataFrame, folder: str) -> str:
    # CSV output is gzip where compressed; Spark writes no zstd text
    report.write.mode("overwrite").option("header", True).csv(folder)
    return folder


def report_folder(output: str, kind: str, as_of: datetime) -> str:
    return f"{output}/{kind}_downloads_by_day_{as_of.month}-{as_of.day}.csv"


def write_package_report(daily: counts.DailyHits, registry: DataFrame, output: str, as_of: datetime) -> str:
    """``uuid,name,total_downloads,<MM/DD>...`` by falling total, as ordered part files."""
    wide = enrich.with_package_name(daily.wide(counts.PACKAGE, "uuid"), registry, "uuid")
    ordered = counts.ranked(wide, "uuid", "total_downloads")
    lead = ["uuid", "name", "total_downloads"]
    report = ordered.select(*lead, *[c for c in ordered.columns if c not in lead])
    return _csv(report, report_folder(output, counts.PACKAGE, as_of))


def write_artifact_report(daily: counts.DailyHits, output: str, as_of: datetime) -> str:
    report = counts.ranked(daily.wide(counts.ARTIFACT, "hash"), "hash", "total_downloads")
    return _csv(report, report_folder(output, counts.ARTIFACT, as_of))


def write_sanitized(
    rows: DataFrame, output: str, fmt: str = "parquet", layout: Layout = ACCESS_LOG
) -> None:
    """Exactly the parsed columns but the address, one folder per source file; no shuffle.

    No path and no run of the store is published. ``legacy_csv`` reads the CSV form back.
    """
    codec = "zstd" if fmt == "parquet" else "gzip"
    parsed = rows.select(*[f.name for f in layout.schema], "src_file")
    writer = privacy.without_address(parsed).write.mode("overwrite").partitionBy("src_file")
    writer.option("compression", codec).option("header", True).format(fmt).save(output)


def write_anonymized(lines: DataFrame, output: str, key: str, **masking) -> None:
    """Masked resource lines as text. ``lines`` has ``value`` and any identity columns."""
    masked = privacy.mask_lines(privacy.resource_lines(lines), key, **masking)
    masked.select("value").write.mode("overwrite").text(output)


def cache_mirror_lines(spark: SparkSession, logs: str, cache: str, as_of: datetime) -> int:
    """Adds the mirror lines of days the cache does not hold yet; how many days those were.

    ``cache/lines`` holds the lines by day, ``cache/days`` the days that are complete, with or
    without lines. A day is listed only after its lines are there, and writing them again
    replaces them, so an interrupted run does no harm.
    """
    seen = shared(mirror_files(spark, logs, as_of))
    new = shared(seen.select("day").distinct().join(mirror_days(spark, cache), "day", "left_anti"))
    # at most one row per day of the window
    n_days = new.count()
    if n_days == 0:
        return 0
    lines = mirror_lines_of(spark, seen.join(F.broadcast(new), "day", "left_semi"))
    (
        mirror.mirror_lines(lines)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy("day")
        .parquet(f"{cache}/lines")
    )
    new.coalesce(1).write.mode("append").parquet(f"{cache}/days")
    return n_days


def _cached(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    found = read_if_present(spark, path, schema)
    return spark.createDataFrame([], schema) if found is None else found


def mirror_days(spark: SparkSession, cache: str) -> DataFrame:
    return _cached(spark, f"{cache}/days", _DAY).distinct()


def mirror_cache(spark: SparkSession, cache: str) -> DataFrame:
    """(line, day) of all cached days."""
    return _cached(spark, f"{cache}/lines", _LINES)


def mirror_bytes(spark: SparkSession, cache: str) -> DataFrame:
    """Bytes per cached day, 0 for days without mirror lines."""
    served = mirror.bytes_by_day(mirror_cache(spark, cache))
    every = mirror_days(spark, cache).join(served, "day", "left")
    return every.select("day", F.coalesce("bytes", F.lit(0).cast("decimal(38,0)")).alias("bytes"))
