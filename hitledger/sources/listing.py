"""File listings as DataFrames, and predicates that pick files before any is opened."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitledger.functions import patterns as P
from hitledger.sources.ranges import open_uri


LISTING = "src_path string, src_file string, src_mtime timestamp, src_bytes long"
_SCHEMA = pa.schema(
    [("src_path", pa.string()), ("src_file", pa.string()), ("src_mtime", pa.timestamp("us", "UTC")), ("src_bytes", pa.int64())]
)
_PAGE = 10_000


def list_files(spark: SparkSession, *paths: str, folders: Column | None = None) -> DataFrame:
    """(src_path, src_file, src_mtime, src_bytes) of files and of all files below folders.

    Tasks look into the folders, each level of the given ones by one task and every subfolder by
    another, so no list of files passes the driver; every use of the DataFrame looks again. The
    contents are never read. Names that begin with ``_`` or ``.`` are left out, as in Spark's own
    readers; empty files are listed. Globs, and stores that only Spark can open, are listed by
    Spark, in the driver and without empty files. ``folders``, a condition on ``src_file``, says
    which folders directly below the given ones are looked into; the others are not listed.
    """
    uris = [qualified(spark, path) for path in paths]
    if any(set(path) & set("*?[{") for path in paths) or not all(map(_opens, uris)):
        return _listed_by_spark(spark, paths)
    given = spark.createDataFrame([(uri,) for uri in uris], "src_path string")
    top = given.repartition(max(1, min(len(uris), spark.sparkContext.defaultParallelism)), "src_path").mapInArrow(
        _entries(recursive=False), LISTING
    )
    # a folder has no length
    below = top.where("src_bytes is null")
    below = (below if folders is None else below.where(folders)).select("src_path")
    spread = below.repartition(spark.sparkContext.defaultParallelism, "src_path")
    return top.where("src_bytes is not null").unionByName(spread.mapInArrow(_entries(recursive=True), LISTING))


def qualified(spark: SparkSession, path: str) -> str:
    """The path as a URI, resolved as Spark would."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = found.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(found).toUri().toString()
    return "file://" + uri[5:] if uri.startswith("file:/") and not uri.startswith("file://") else uri


def _opens(uri: str) -> bool:
    try:
        open_uri(uri)
    except (ValueError, ImportError, OSError):
        return False
    return True


def _entries(recursive: bool):
    """Arrow function: URIs to their listing; folders, if not looked into, have no length."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for uri in batch.column("src_path").to_pylist():
                store, path = open_uri(uri)
                [given] = store.get_file_info([path])
                if given.type == fs.FileType.NotFound:
                    raise FileNotFoundError(uri)
                # what stands before the path: scheme and authority
                lead = uri[: len(uri) - len(quoted(path))] if uri.endswith(quoted(path)) else "file://"
                found = [given]
                if given.type == fs.FileType.Directory:
                    found = store.get_file_info(fs.FileSelector(path, recursive=recursive))
                skip = len(path.rstrip("/")) + 1
                kept = [
                    f
                    for f in found
                    if f is given or not any(x[:1] in "._" and "=" not in x for x in f.path[skip:].split("/"))
                ]
                if recursive:
                    kept = [f for f in kept if f.type == fs.FileType.File]
                for low in range(0, len(kept), _PAGE):
                    page = kept[low : low + _PAGE]
                    whole = [f.type == fs.FileType.File for f in page]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lead + quoted(f.path) for f in page], pa.string()),
                            pa.array([f.base_name for f in page], pa.string()),
                            # whole milliseconds, as Spark gives them
                            pa.array([f.mtime_ns // 1_000_000 * 1000 if f.mtime_ns else 0 for f in page], pa.int64()).cast(_SCHEMA.field(2).type),
                            pa.array([f.size if w else None for f, w in zip(page, whole)], pa.int64()),
                        ],
                        schema=_SCHEMA,
                    )

    return entries


def quoted(path: str) -> str:
    """A path as it stands in a URI."""
    return re.sub(r"[\x00-\x20%\"<>\\^`{|}?#\[\]\x7f]", lambda m: f"%{ord(m.group()):02X}", path)


def _listed_by_spark(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    files = reader.load(list(paths))
    # without this every large file would be a task of its own, for four values
    files = files.coalesce(spark.sparkContext.defaultParallelism)
    return files.select(
        F.col("_metadata.file_path").alias("src_path"),
        F.col("_metadata.file_name").alias("src_file"),
        F.col("modificationTime").alias("src_mtime"),
        F.col("length").alias("src_bytes"),
    )


def present_files(files: DataFrame) -> DataFrame:
    """The listing rows of the files of a listing that are there now, with what they are now."""
    cores = files.sparkSession.sparkContext.defaultParallelism

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                if _opens(row["src_path"]):
                    store, path = open_uri(row["src_path"])
                    [now] = store.get_file_info([path])
                    if now.type != fs.FileType.File:
                        continue
                    row |= {"src_bytes": now.size}
                    if now.mtime_ns:
                        row |= {"src_mtime": datetime.fromtimestamp(now.mtime_ns // 1_000_000 / 1000, UTC)}
                rows.append(row)
            yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)

    return files.select(*_SCHEMA.names).repartition(cores, "src_path").mapInArrow(look, LISTING)


def is_access_log(name: Column) -> Column:
    return name.rlike(P.ACCESS_LOG_NAME)


def file_date(name: Column) -> Column:
    """Rotation day (midnight) from a ``...-yyyymmdd.gz`` name; NULL if it is no date."""
    digits = F.regexp_extract(name, P.DATED_NAME, 1)
    return F.when(
        F.length(digits) == 8,
        F.try_make_timestamp_ntz(
            F.substring(digits, 1, 4).try_cast("int"),
            F.substring(digits, 5, 2).try_cast("int"),
            F.substring(digits, 7, 2).try_cast("int"),
            F.lit(0),
            F.lit(0),
            F.lit(0),
        ),
    )


def is_recent(name: Column, days: int, as_of: datetime) -> Column:
    """Fewer than ``days`` whole days between the file's day and ``as_of``."""
    age = F.lit(as_of).cast("timestamp_ntz") - file_date(name)
    return F.coalesce(F.extract(F.lit("DAY"), age) < days, F.lit(False))


def default_selection(name: Column, as_of: datetime) -> Column:
    return is_access_log(name) & is_recent(name, P.DEFAULT_WINDOW_DAYS, as_of)


def undated_files(files: DataFrame) -> DataFrame:
    """Access logs whose name holds digits that are no date: selected by no window."""
    name = F.col("src_file")
    return files.where(
        is_access_log(name) & (F.regexp_extract(name, P.DATED_NAME, 1) != "") & file_date(name).isNull()
    )
