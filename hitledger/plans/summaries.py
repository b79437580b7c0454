"""Report aggregates kept by run, so that a report reads no row it has counted before.

For every run of the store there are two small tables below ``summaries/<prefixes>/``: hits by source
file, kind, key, day and CI flag, and client registers by source file and day. They are made once, from
the rows of that run alone. A report adds up those of the runs that the manifest names for their
files; what a superseded run counted for a file is thereby retracted, without being touched.

Hits depend on the CI prefixes, so each set of prefixes, told apart by a fingerprint of its rows, has
summaries of its own. ``done`` lists the summarised runs and is written last; summaries of a run
that a death left behind are replaced when they are made again.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitledger.functions import patterns as P
from hitledger.operators import counts, enrich, registers
from hitledger.plans import refresh
from hitledger.sources.tables import read_if_present

HITS = "src_id string, log_date date, is_ci boolean, kind string, key string, day date, n long, run_id string"
REGISTERS = "src_id string, log_date date, day date, bucket int, rank int, run_id string"
DONE = "run_id string"


def prefix_print(prefixes: DataFrame) -> str:
    """A fingerprint of (provider, cidr) rows, whatever their order."""
    row = F.xxhash64("provider", "cidr").cast("decimal(38,0)")
    total, n = prefixes.distinct().agg(F.coalesce(F.sum(row), F.lit(0)), F.count("*")).first()
    return f"{int(total) & (1 << 64) - 1:016x}-{n}"


def _folder(root: str, prefixes: DataFrame) -> str:
    return f"{root}/summaries/{prefix_print(prefixes)}"


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    found = read_if_present(spark, path, schema)
    return spark.createDataFrame([], T.StructType.fromDDL(schema)) if found is None else found


def missing_runs(spark: SparkSession, root: str, prefixes: DataFrame) -> list[str]:
    """Runs that hold a file's newest rows and have no summary; one short row per run."""
    current = refresh.manifest(spark, root).where("n_rows > 0").select("run_id").distinct()
    done = _table(spark, f"{_folder(root, prefixes)}/done", DONE)
    return sorted(r.run_id for r in current.join(done, "run_id", "left_anti").collect())


def rows_of_runs(spark: SparkSession, root: str, runs: list[str]) -> DataFrame:
    """The rows that count of some runs; other runs' folders are not opened."""
    return refresh.current_rows(spark, root).where(F.col("run_id").isin(*runs))


def update(spark: SparkSession, root: str, prefixes: DataFrame, secret: bytes = b"", verify: str | None = "digest") -> int:
    """Makes the summaries that are missing; of how many runs. Damaged parts of those are healed first."""
    runs = missing_runs(spark, root, prefixes)
    if runs and verify is not None and refresh.heal(spark, root, secret, chosen=F.col("run_id").isin(*runs), verify=verify):
        runs = missing_runs(spark, root, prefixes)
    if not runs:
        return 0
    folder = _folder(root, prefixes)
    rows = rows_of_runs(spark, root, runs)
    flagged = enrich.with_ci_flag(rows, enrich.PrefixTable.build(prefixes))
    own = ["run_id", "src_id", "log_date"]
    _write(counts.hits_by_key_and_day(flagged, *own, "is_ci"), f"{folder}/hits")
    daily = rows.withColumn("day", F.to_date("time_utc"))
    _write(registers.registers(daily, [*own, "day"]), f"{folder}/registers")
    spark.createDataFrame([(r,) for r in runs], DONE).coalesce(1).write.mode("append").parquet(f"{folder}/done")
    return len(runs)


def _write(summary: DataFrame, path: str) -> None:
    writer = summary.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.option("compression", "zstd").partitionBy("run_id").parquet(path)


def _counting(spark: SparkSession, root: str, path: str, schema: str, newer_than: date | None) -> DataFrame:
    """The summary rows of the runs that the manifest names for their files."""
    current = refresh.manifest(spark, root).select("src_id", "run_id")
    found = _table(spark, path, schema).join(current, ["src_id", "run_id"], "left_semi")
    return found if newer_than is None else found.where(F.col("log_date") > newer_than)


def current_hits(spark: SparkSession, root: str, prefixes: DataFrame, newer_than: date | None = None) -> DataFrame:
    """(is_ci, kind, key, day, n): what ``counts.hits_by_key_and_day`` gives for all current rows."""
    found = _counting(spark, root, f"{_folder(root, prefixes)}/hits", HITS, newer_than)
    return found.groupBy("is_ci", "kind", "key", "day").agg(F.sum("n").alias("n"))


def current_registers(spark: SparkSession, root: str, prefixes: DataFrame, newer_than: date | None = None) -> DataFrame:
    """(day, bucket, rank) of all current rows."""
    found = _counting(spark, root, f"{_folder(root, prefixes)}/registers", REGISTERS, newer_than)
    return registers.merged(found, ["day"])


def oldest_day(as_of: datetime, days: int = P.DEFAULT_WINDOW_DAYS) -> date:
    """Files of later days than this are recent."""
    return (as_of - timedelta(days=days)).date()
