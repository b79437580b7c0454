"""What the Parquet files of the store must be: length, digest and whose rows they hold.

Every run records its parts before its manifest rows. A part that is missing, shorter, longer or
has other bytes is damaged, and the source files with rows in it are known, so they can be parsed
again. Checking streams the bytes of the parts through tasks; nothing is decoded. Where only Spark's
own file systems reach the store, lengths alone are compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitledger.sources.listing import list_files, qualified
from hitledger.sources.ranges import open_uri
from hitledger.sources.tables import read_if_present

#: One row per part and source file.
PARTS = T.StructType(
    [
        T.StructField(name, kind, True)
        for name, kind in {
            "run_id": T.StringType(),
            "part": T.StringType(),
            "part_bytes": T.LongType(),
            "part_digest": T.StringType(),
            "src_id": T.StringType(),
            "n_rows": T.LongType(),
            "n_rejects": T.LongType(),
        }.items()
    ]
)
_FOUND = "part_uri string, bytes_now long, digest_now string, seen boolean"
_BLOCK = 4 << 20


def part_of(file_path: Column) -> Column:
    """A part's path below the folder of its run."""
    return F.regexp_extract(file_path, r"run_id=[^/]+/(.+)$", 1)


def with_uri(spark: SparkSession, root: str, parts: DataFrame) -> DataFrame:
    base = qualified(spark, f"{root}/table")
    return parts.withColumn("part_uri", F.concat(F.lit(f"{base}/run_id="), "run_id", F.lit("/"), "part"))


def _state(uri: str, digests: bool) -> tuple[int | None, str | None, bool]:
    """(bytes, digest, whether the store could be asked); no bytes if the part is missing."""
    try:
        store, path = open_uri(uri)
    except (ValueError, ImportError, OSError):
        return None, None, False
    try:
        with store.open_input_stream(path, compression=None) as stream:
            if not digests:
                return store.get_file_info([path])[0].size, None, True
            digest, size = hashlib.blake2b(digest_size=16), 0
            while block := stream.read(_BLOCK):
                digest.update(block)
                size += len(block)
            return size, digest.hexdigest(), True
    except FileNotFoundError:
        return None, None, True


def inspected(parts: DataFrame, digests: bool = True) -> DataFrame:
    """(part_uri, bytes_now, digest_now, seen) of the parts at ``part_uri``."""
    spark = parts.sparkSession

    def inspect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("part_uri").to_pylist():
                size, digest, seen = _state(uri, digests)
                yield pa.RecordBatch.from_pydict(
                    {
                        "part_uri": [uri],
                        "bytes_now": pa.array([size], pa.int64()),
                        "digest_now": pa.array([digest], pa.string()),
                        "seen": [seen],
                    }
                )

    cores = spark.sparkContext.defaultParallelism
    return parts.select("part_uri").distinct().repartition(4 * cores, "part_uri").mapInArrow(inspect, _FOUND)


def record_parts(spark: SparkSession, root: str, run_id: str, stored: DataFrame) -> DataFrame:
    """Appends what a run wrote (``stored``: its rows as read back); its recorded rows."""
    counted = stored.groupBy(part_of(F.col("_metadata.file_path")).alias("part"), "src_id").agg(
        F.count_if(F.col("record") == "row").alias("n_rows"),
        F.count_if(F.col("record") == "reject").alias("n_rejects"),
    )
    named = with_uri(spark, root, counted.withColumn("run_id", F.lit(run_id)))
    states = inspected(named).withColumnsRenamed({"bytes_now": "part_bytes", "digest_now": "part_digest"})
    # one list of parts per run, however many tasks counted them; an exchange, for what is coalesced
    # runs its joins and aggregates in the one task too
    rows = named.join(states, "part_uri").select(*PARTS.names)
    rows.repartition(1).write.mode("append").parquet(f"{root}/parts")
    return recorded(spark, root).where(F.col("run_id") == run_id)


def recorded(spark: SparkSession, root: str) -> DataFrame:
    found = read_if_present(spark, f"{root}/parts", PARTS)
    return spark.createDataFrame([], PARTS) if found is None else found


def damaged_parts(
    spark: SparkSession, root: str, current: DataFrame, chosen: Column | None = None, digests: bool = True
) -> DataFrame:
    """(run_id, part, part_uri, src_id, counts) of damaged parts.

    ``counts`` says whether the part holds rows of ``current`` (src_id, run_id); parts that are there
    but hold none are listed too, since readers would stumble over them. ``chosen`` is a condition on
    ``part``, whose path begins with the record kind and the day.
    """
    now = current.select("src_id", "run_id", F.lit(True).alias("counts"))
    parts = recorded(spark, root).join(now, ["src_id", "run_id"], "left")
    parts = with_uri(spark, root, parts if chosen is None else parts.where(chosen))
    states = inspected(parts, digests)
    if not states_all_seen(states):
        listed = list_files(spark, f"{root}/table").select(F.col("src_path").alias("part_uri"), "src_bytes")
        states = states.join(listed, "part_uri", "left").withColumn("bytes_now", F.coalesce("bytes_now", "src_bytes")).drop("src_bytes")
    found = parts.join(states, "part_uri", "left")
    other_bytes = ~F.col("bytes_now").eqNullSafe(F.col("part_bytes"))
    other_digest = F.coalesce(F.col("digest_now") != F.col("part_digest"), F.lit(False))
    counts = F.coalesce("counts", F.lit(False))
    harmful = counts | F.col("bytes_now").isNotNull()
    return found.where(harmful & (other_bytes | other_digest)).select(
        "run_id", "part", "part_uri", "src_id", counts.alias("counts")
    )


def states_all_seen(states: DataFrame) -> bool:
    """Whether every store could be asked by the tasks; one row is looked for."""
    return states.where("not seen").isEmpty()


def delete_parts(parts: DataFrame) -> None:
    """Deletes the files at ``part_uri``, by tasks where they reach them, else by the driver."""
    spark = parts.sparkSession

    def delete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left = []
            for uri in batch.column("part_uri").to_pylist():
                try:
                    store, path = open_uri(uri)
                except (ValueError, ImportError, OSError):
                    left.append(uri)
                    continue
                try:
                    store.delete_file(path)
                except FileNotFoundError:
                    pass
            yield pa.RecordBatch.from_pydict({"part_uri": pa.array(left, pa.string())})

    left = parts.select("part_uri").distinct().mapInArrow(delete, "part_uri string")
    for row in left.toLocalIterator():
        file = spark._jvm.org.apache.hadoop.fs.Path(row.part_uri)
        file.getFileSystem(spark._jsc.hadoopConfiguration()).delete(file, False)
