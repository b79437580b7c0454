"""New log files as a stream: parse into the store or a Parquet folder, and daily counts.

A file stream sees each file once. Files that are rewritten in place belong to the batch
refresh, which compares modification times; it knows the files a stream brought into the store.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitledger.operators.parse import parse_or_reject, with_hll_hash
from hitledger.plans import refresh
from hitledger.sources.listing import is_access_log
from hitledger.sources.tables import read_if_present
from hitledger.sources.textscan import without_carriage_return
from hitledger.stages import new_folder

LATE = "2 days"


def stream_lines(
    spark: SparkSession,
    directory: str,
    files_per_batch: int | None = None,
    criteria: Column | None = None,
    names: str = "access_*",
    state: bool = False,
) -> DataFrame:
    """(value, src_path, src_file) of the log files that land in ``directory`` or below.

    With ``state`` also src_mtime and src_bytes, what the file was when it was read. Files whose name does not match the glob ``names`` are not opened; ``criteria`` on src_file
    (default: the name of an access log) decides about the others.
    """
    reader = spark.readStream.option("lineSep", "\n").option("recursiveFileLookup", True)
    reader = reader.option("pathGlobFilter", names)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    seen = {"src_mtime": "file_modification_time", "src_bytes": "file_size"} if state else {}
    lines = reader.text(directory).select(
        without_carriage_return(F.col("value")).alias("value"),
        # the form that listings give
        F.regexp_replace("_metadata.file_path", "^file:/+", "file:///").alias("src_path"),
        F.col("_metadata.file_name").alias("src_file"),
        *[F.col(f"_metadata.{field}").alias(name) for name, field in seen.items()],
    )
    return lines.where(is_access_log(F.col("src_file")) if criteria is None else criteria)


def parsed_stream(lines: DataFrame, secret: bytes = b"") -> DataFrame:
    """Every line once: rows, and rejects with their reason, told apart by ``record``."""
    rows = parse_or_reject(lines, "value", ["src_path", "src_file"], F.col("src_file"))
    return with_hll_hash(rows, secret)


def ingest_available(rows: DataFrame, table: str, checkpoint: str) -> None:
    """Appends everything that has arrived to ``table``, by record kind and request day."""
    query = (
        rows.withColumn("log_date", F.to_date("time_utc"))
        .writeStream.format("parquet")
        .option("path", table)
        .option("checkpointLocation", checkpoint)
        .option("compression", "zstd")
        .partitionBy("record", "log_date")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def ingest_into_store(
    spark: SparkSession,
    root: str,
    directory: str,
    checkpoint: str,
    secret: bytes = b"",
    files_per_batch: int | None = None,
    criteria: Column | None = None,
    names: str = "access_*",
) -> None:
    """Brings everything that has arrived into the store of ``refresh``, one run per batch.

    A batch is published by its manifest rows. One that is repeated after a failure writes another
    run, whose newer manifest rows supersede those of the first, so every file counts once; so does a
    file that is rewritten later and parsed by ``refresh``.
    """
    lines = stream_lines(spark, directory, files_per_batch, criteria, names, state=True)

    def store(batch: DataFrame, number: int) -> None:
        run_id = f"stream-{number}-{uuid.uuid4().hex}"
        refresh.store_lines(root, batch.select("value", "src_path", "src_file"), run_id, secret)
        files = batch.select("src_path", "src_file", "src_mtime", "src_bytes").distinct()
        files = files.withColumn("status", F.lit(refresh.OK))
        refresh.record_run(batch.sparkSession, root, files, run_id, refresh.key_fingerprint(secret))

    query = (
        lines.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def with_event_time(rows: DataFrame, late: str = LATE) -> DataFrame:
    """Adds ``event_time``, the instant of ``time_utc``, watermarked on a stream.

    Watermarks need an instant; the detour over zones keeps it right in any session zone.
    """
    here = F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("time_utc"))
    timed = rows.where(F.col("time_utc").isNotNull()).withColumn("event_time", here.cast("timestamp"))
    return timed.withWatermark("event_time", late) if rows.isStreaming else timed


def daily_counts(rows: DataFrame, late: str = LATE) -> DataFrame:
    """(day, n) by event time; one plan for tables and streams.

    In update and append mode the watermark bounds a stream's state to the days that may still
    receive lines.
    """
    start = F.col("w.start").cast("timestamp_ntz")
    day = F.to_date(F.convert_timezone(F.current_timezone(), F.lit("UTC"), start))
    return (
        with_event_time(rows, late)
        .groupBy(F.window("event_time", "1 day").alias("w"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(day.alias("day"), "n")
    )


def run_to_folder(stream: DataFrame, mode: str, keys: Sequence[str] = ()) -> DataFrame:
    """Runs a stream over all present input; what its batches gave, from the shared folder.

    Each batch has a folder named by its number, so a repeated batch replaces itself alone. In
    update mode ``keys`` name the rows: of each, the newest batch counts. In append mode all rows
    do. Without input the result is empty.
    """
    spark = stream.sparkSession
    base = new_folder(spark, "stream")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/out/batch={number}")

    query = (
        stream.writeStream.foreachBatch(write)
        .outputMode(mode)
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    schema = T.StructType([*stream.schema.fields, T.StructField("batch", T.LongType())])
    found = read_if_present(spark, f"{base}/out", schema)
    if found is None:
        return spark.createDataFrame([], stream.schema)
    if keys:
        others = [c for c in stream.columns if c not in keys]
        newest = found.groupBy(*keys).agg(F.max_by(F.struct(*others), "batch").alias("_newest"))
        found = newest.select(*keys, *[F.col("_newest")[c].alias(c) for c in others])
    return found.select(*stream.columns)
