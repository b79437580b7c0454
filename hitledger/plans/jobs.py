"""The whole jobs, one function each, for notebooks and ``python -m hitledger``."""

from __future__ import annotations

import secrets
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitledger.functions import patterns as P
from hitledger.operators import counts, enrich, mirror, registers
from hitledger.operators.parse import parse_lines
from hitledger.plans import exports, refresh, summaries
from hitledger.stages import shared
from hitledger.sources.dimensions import read_secret
from hitledger.sources.listing import default_selection, list_files, undated_files
from hitledger.sources.textscan import in_mirror_window, text_lines


def parse_directory(
    spark: SparkSession,
    directory: str,
    store: str,
    as_of: datetime,
    key_file: str | None = None,
    criteria: Column | None = None,
) -> int:
    """Brings the parsed table up to date with the selected files of a folder."""
    if criteria is None:
        criteria = default_selection(F.col("src_file"), as_of)
    return refresh.refresh(spark, store, directory, criteria, _secret(spark, key_file))


def parse_files(spark: SparkSession, files: Sequence[str], store: str, key_file: str | None = None) -> int:
    """The same for an explicit list of files."""
    return refresh.refresh_files(spark, store, list_files(spark, *files), _secret(spark, key_file))


@dataclass(frozen=True)
class ParseReport:
    """What a user should hear after parsing."""

    unreadable: DataFrame
    undated: DataFrame
    rejects: DataFrame


def parse_report(
    spark: SparkSession, store: str, directory: str | None = None, key_file: str | None = None
) -> ParseReport:
    """Files that could not be decoded, access logs whose names hold no date, rejects by reason."""
    rejects = refresh.read_rejects(spark, store, secret=_secret(spark, key_file))
    names = [] if directory is None else [directory]
    listed = list_files(spark, *names) if names else refresh.manifest(spark, store).select(
        "src_path", F.substring_index("src_path", "/", -1).alias("src_file")
    )
    return ParseReport(
        refresh.unreadable_files(spark, store),
        undated_files(listed).select("src_path"),
        rejects.groupBy("reject_class", "reject_field").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "reject_field"),
    )


def tidy(spark: SparkSession, store: str) -> tuple[int, int]:
    """Marks files with damaged rows for parsing and removes superseded runs: how many of each."""
    damaged = refresh.drop_damaged(spark, store).count()
    return damaged, len(refresh.remove_superseded(spark, store))


def _secret(spark: SparkSession, key_file: str | None) -> bytes:
    return b"" if key_file is None else read_secret(spark, key_file)


@dataclass(frozen=True)
class Reports:
    """What the download report publishes, and where the two CSV folders are."""

    totals: DataFrame
    daily: counts.DailyHits
    package_csv: str
    artifact_csv: str

    def top_packages(self, registry: DataFrame, k: int = 10) -> DataFrame:
        series = self.daily.top_series(counts.PACKAGE, k)
        return enrich.with_package_name(series.withColumnRenamed("key", "package_uuid"), registry)


def download_reports(
    rows: DataFrame, prefixes: DataFrame, registry: DataFrame, output: str, as_of: datetime
) -> Reports:
    """Totals by CI flag and the two per-day CSVs of everybody else.

    One pass over a handful of the rows' columns gives the small table behind all of it.
    """
    flagged = enrich.with_ci_flag(rows, enrich.PrefixTable.build(prefixes))
    return _reports(shared(counts.hits_by_key_and_day(flagged, "is_ci")), registry, output, as_of)


def stored_reports(
    spark: SparkSession,
    store: str,
    prefixes: DataFrame,
    registry: DataFrame,
    output: str,
    as_of: datetime,
    key_file: str | None = None,
) -> Reports:
    """The same for the recent files of a store, from its summaries: only runs that no earlier
    report has counted are read."""
    summaries.update(spark, store, prefixes, _secret(spark, key_file))
    hits = summaries.current_hits(spark, store, prefixes, summaries.oldest_day(as_of))
    return _reports(shared(hits), registry, output, as_of)


def stored_clients(spark: SparkSession, store: str, prefixes: DataFrame, key_file: str | None = None) -> DataFrame:
    """(day, clients): distinct clients a day, estimated from the registers of the store's summaries."""
    summaries.update(spark, store, prefixes, _secret(spark, key_file))
    return registers.estimated(summaries.current_registers(spark, store, prefixes), ["day"])


def _reports(hits: DataFrame, registry: DataFrame, output: str, as_of: datetime) -> Reports:
    totals = counts.split_totals(hits)
    others = hits.where(~F.col("is_ci") & F.col("day").isNotNull()).drop("is_ci")
    daily = counts.DailyHits.of(others)
    return Reports(
        totals,
        daily,
        exports.write_package_report(daily, registry, output, as_of),
        exports.write_artifact_report(daily, output, as_of),
    )


def anonymize_file(
    spark: SparkSession,
    source: str,
    output: str,
    key: str,
    seed: str | None = None,
    random_share: float = P.MASK_RANDOM_SHARE,
) -> None:
    """Masks the resource lines of log files. Without a seed every run draws afresh.

    A line's identity is its file and its place in the scan, so equal lines draw differently.
    """
    lines = text_lines(spark, source).select(
        "value", "src_path", F.monotonically_increasing_id().alias("place")
    )
    exports.write_anonymized(
        lines,
        output,
        key,
        identity=["src_path", "place"],
        seed=secrets.token_hex(16) if seed is None else seed,
        random_share=random_share,
    )


def mirror_traffic(
    spark: SparkSession, logs: str, cache: str, as_of: datetime
) -> tuple[DataFrame, DataFrame]:
    """(bytes per day, total) of the mirror logs of the last 30 days."""
    exports.cache_mirror_lines(spark, logs, cache, as_of)
    per_day = exports.mirror_bytes(spark, cache).where(in_mirror_window(F.col("day"), as_of))
    return per_day, mirror.total_bytes(per_day)


def quick_look(spark: SparkSession, path: str) -> DataFrame:
    """Distinct clients and packages of one log file."""
    rows = parse_lines(text_lines(spark, path), only=["remote_addr", "package_uuid"])
    return rows.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("remote_addr").alias("clients"),
        F.count_distinct("package_uuid").alias("packages"),
    )
