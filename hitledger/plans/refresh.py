"""Incremental refresh of the parsed table.

Layout below one root folder:

* ``table/run_id=<run>/record=<row|reject>/log_date=<day>/`` zstd Parquet. Every run writes a
  folder of its own and never touches another's; ``src_id`` tells the source files apart;
* ``parts/`` one appended row per Parquet file and source file: length and digest of the Parquet
  file, rows and rejects of the source file in it;
* ``manifest/`` one appended row per file and run: what was read (path, modification time,
  length), how (key fingerprint, parser version), what came out (status, row and reject counts).

A file is stale when the manifest's newest entry for its path does not match what is on
disk now. Rows count only if the manifest names their run for their file. So a run that dies
before its manifest rows are written changes nothing: the rows of earlier runs stay published, and
its files are parsed again. ``remove_superseded`` deletes runs that no file needs any more.

Readers heal: before rows are read, the parts that hold them are compared with their recorded
lengths and digests, and the source files of damaged ones are parsed again at once. What cannot be
parsed again (a source file that is gone or unreadable, another key) raises ``DamagedStore``, so a
reader never gets fewer rows than the manifest promises.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitledger.functions import patterns as P
from hitledger.functions.layout import ACCESS_LOG, Layout
from hitledger.operators.parse import parse_or_reject, with_hll_hash
from hitledger.plans.parts import PARTS, damaged_parts, delete_parts, record_parts
from hitledger.sources.codecs import damaged_files, with_codec
from hitledger.sources.listing import file_date, list_files, present_files
from hitledger.sources.ranges import broken_files
from hitledger.sources.tables import read_if_present
from hitledger.sources.textscan import heavy_bytes, lines_of_files
from hitledger.stages import shared

PARSER_VERSION = 2
# Manifest entries that may be broadcast to check rows against: 16 bytes each.
BROADCAST_FILES = 1_000_000


def _struct(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in kinds.items()])


_TEXT, _LONG = T.StringType(), T.LongType()
MANIFEST = _struct(
    src_path=_TEXT,
    src_id=_TEXT,
    src_mtime=T.TimestampType(),
    src_bytes=_LONG,
    key_print=_TEXT,
    parser_version=T.IntegerType(),
    run_id=_TEXT,
    run_at=T.TimestampType(),
    status=_TEXT,
    n_rows=_LONG,
    n_rejects=_LONG,
)
_SOURCE = _struct(src_path=_TEXT, src_file=_TEXT, src_id=_TEXT)
_REASONS = _struct(line=_TEXT, reject_field=_TEXT, reject_class=_TEXT)
_PARTITIONS = _struct(run_id=_TEXT, record=_TEXT, log_date=T.DateType())
#: Files with these entries are not looked at again until they change.
OK, UNREADABLE, DROPPED = "ok", "unreadable", "dropped"


def table_schema(layout: Layout = ACCESS_LOG) -> T.StructType:
    columns = [*_SOURCE, *layout.schema, *_REASONS, *_PARTITIONS]
    return T.StructType(columns)


def key_fingerprint(secret: bytes) -> str:
    return hashlib.sha256(b"fingerprint" + secret).hexdigest()[:16]


def source_id(path: Column) -> Column:
    return F.sha1(path)


def manifest_entries(spark: SparkSession, root: str) -> DataFrame:
    """The newest entry per file, whatever its status."""
    entries = read_if_present(spark, f"{root}/manifest", MANIFEST)
    if entries is None:
        return spark.createDataFrame([], MANIFEST)
    names = [n for n in MANIFEST.names if n != "src_path"]
    newest = entries.groupBy("src_path").agg(
        F.max_by(F.struct(*names), F.struct("run_at", "run_id")).alias("e")
    )
    return newest.select("src_path", "e.*")


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """The newest entry per file; files that are unreadable or were dropped are left out."""
    return manifest_entries(spark, root).where(F.col("status") == OK)


def unreadable_files(spark: SparkSession, root: str) -> DataFrame:
    """Files the last look could not decode: (src_path, src_mtime, src_bytes)."""
    found = manifest_entries(spark, root).where(F.col("status") == UNREADABLE)
    return found.select("src_path", "src_mtime", "src_bytes")


def stale_files(
    files: DataFrame, known: DataFrame, key_print: str, version: int = PARSER_VERSION
) -> DataFrame:
    """Listed files without an up-to-date manifest entry (``known``: the newest ones)."""
    current = known.where(
        (F.col("key_print") == key_print)
        & (F.col("parser_version") == version)
        & (F.col("status") != DROPPED)
    )
    return files.join(current, ["src_path", "src_mtime", "src_bytes"], "left_anti")


def refresh(
    spark: SparkSession,
    root: str,
    directory: str,
    criteria: Column,
    secret: bytes = b"",
    transform: Callable[[DataFrame], DataFrame] | None = None,
    layout: Layout = ACCESS_LOG,
) -> int:
    """Parses the stale files of ``directory`` that meet ``criteria``; how many there were.

    ``transform`` may rewrite the parsed rows before they are stored; it must keep their
    columns.
    """
    found = list_files(spark, directory).where(criteria)
    return refresh_files(spark, root, found, secret, transform, layout)


def refresh_files(
    spark: SparkSession,
    root: str,
    files: DataFrame,
    secret: bytes = b"",
    transform: Callable[[DataFrame], DataFrame] | None = None,
    layout: Layout = ACCESS_LOG,
) -> int:
    """The same for a listing. A file that cannot be decoded gets an entry of its own and does
    not keep the others from being parsed; ``unreadable_files`` lists them.
    """
    key_print = key_fingerprint(secret)
    # The listing is fixed here, as a table: the manifest must record what this run saw, not
    # what a later look at the folder would show.
    chosen = shared(with_codec(stale_files(files, manifest_entries(spark, root), key_print)))
    if chosen.isEmpty():
        return 0
    return _parse(spark, root, chosen, secret, transform, layout)


def _parse(spark, root, chosen, secret, transform, layout) -> int:
    """Parses a fixed listing with codecs into a run of its own; how many files it could read."""
    readable, odd = chosen.where("decodable"), chosen.where("not decodable")
    # decoding alone costs little; a run that meets the end of a cut file has parsed the others for nothing
    cut_off = shared(broken_files(readable.where("reachable"), heavy_bytes(spark, readable)))
    if not cut_off.isEmpty():
        odd = odd.unionByName(readable.join(cut_off, "src_path", "left_semi"))
        readable = readable.join(cut_off, "src_path", "left_anti")
    run_id = uuid.uuid4().hex
    try:
        written = _write(spark, root, readable, run_id, secret, transform, layout)
    except Exception:
        # what decoding alone did not meet: files that changed or went since, and stores that fail
        broken = shared(damaged_files(readable))
        if broken.isEmpty():
            raise
        odd = odd.unionByName(readable.join(broken, "src_path", "left_semi"))
        readable = readable.join(broken, "src_path", "left_anti")
        run_id = uuid.uuid4().hex
        written = _write(spark, root, readable, run_id, secret, transform, layout)
    files = readable.withColumn("status", F.lit(OK)).unionByName(odd.withColumn("status", F.lit(UNREADABLE)))
    record_run(spark, root, files, run_id, key_fingerprint(secret), written)
    return readable.count()


def run_folder(root: str, run_id: str) -> str:
    return f"{root}/table/run_id={run_id}"


def _write(spark, root, files, run_id, secret, transform, layout) -> bool:
    lines = lines_of_files(spark, files)
    if lines is None:
        return False
    store_lines(root, lines, run_id, secret, transform, layout)
    return True


def store_lines(
    root: str,
    lines: DataFrame,
    run_id: str,
    secret: bytes = b"",
    transform: Callable[[DataFrame], DataFrame] | None = None,
    layout: Layout = ACCESS_LOG,
) -> None:
    """Parses (value, src_path, src_file) into the folder of a run; ``record_run`` publishes it."""
    rows = parse_or_reject(lines, "value", ["src_path", "src_file"], F.col("src_file"), layout)
    rows = with_hll_hash(rows, secret)
    if transform is not None:
        rows = transform(rows)
    stored = rows.withColumns(
        {
            "log_date": F.to_date(file_date(F.col("src_file"))),
            "src_id": source_id(F.col("src_path")),
        }
    ).select(*[n for n in table_schema(layout).names if n != "run_id"])
    (
        stored.write.mode("errorifexists")
        .option("compression", "zstd")
        .partitionBy("record", "log_date")
        .parquet(run_folder(root, run_id))
    )


def record_run(
    spark: SparkSession, root: str, files: DataFrame, run_id: str, key_print: str, written: bool = True
) -> None:
    """Publishes a run: its parts, then the manifest rows of its files (a listing with ``status``)."""
    own = T.StructType([f for f in table_schema() if f.name in ("src_id", "record")])
    rows = None
    if written:
        # the run's own folder alone; footers and one short column
        rows = read_if_present(spark, run_folder(root, run_id), own)
    counts = spark.createDataFrame([], PARTS) if rows is None else record_parts(spark, root, run_id, rows)
    counts = counts.groupBy("src_id").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_rejects").alias("n_rejects"))
    entries = files.withColumn("src_id", source_id(F.col("src_path"))).join(counts, "src_id", "left")
    entries.select(
        "src_path",
        "src_id",
        "src_mtime",
        "src_bytes",
        F.lit(key_print).alias("key_print"),
        F.lit(PARSER_VERSION).alias("parser_version"),
        F.lit(run_id).alias("run_id"),
        F.current_timestamp().alias("run_at"),
        "status",
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
        F.coalesce("n_rejects", F.lit(0)).alias("n_rejects"),
    ).repartition(1).write.mode("append").parquet(f"{root}/manifest")


def remove_superseded(spark: SparkSession, root: str) -> list[str]:
    """Deletes the folders of recorded runs that are no file's newest; their ids.

    Runs without manifest rows are left alone: they may be under way. Call it when no reader
    that started before the last refresh is still at work.
    """
    entries = read_if_present(spark, f"{root}/manifest", MANIFEST)
    if entries is None:
        return []
    current = manifest(spark, root).select("run_id").distinct()
    old = entries.select("run_id").distinct().join(current, "run_id", "left_anti")
    gone = []
    for row in old.orderBy("run_id").toLocalIterator():
        path = spark._jvm.org.apache.hadoop.fs.Path(run_folder(root, row.run_id))
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True):
            gone.append(row.run_id)
    return gone


def _stored(spark: SparkSession, root: str, layout: Layout = ACCESS_LOG, **options) -> DataFrame:
    schema = table_schema(layout)
    found = read_if_present(spark, f"{root}/table", schema, **options)
    return spark.createDataFrame([], schema) if found is None else found


class DamagedStore(ValueError):
    """Rows that the manifest promises are lost and cannot be parsed again."""


def heal(
    spark: SparkSession,
    root: str,
    secret: bytes = b"",
    transform: Callable[[DataFrame], DataFrame] | None = None,
    layout: Layout = ACCESS_LOG,
    chosen: Column | None = None,
    verify: str = "digest",
) -> int:
    """Parses the source files of damaged parts again; how many there were.

    ``chosen`` limits the look to parts (a condition on ``part``), ``verify`` is ``digest`` or
    ``length``. The damaged parts are deleted once the new run is published.
    """
    known = manifest(spark, root)
    damaged = shared(damaged_parts(spark, root, known, chosen, verify == "digest"))
    if damaged.isEmpty():
        return 0
    lost = shared(known.join(damaged.where("counts").select("src_id").distinct(), "src_id", "left_semi"))
    if lost.isEmpty():
        delete_parts(damaged)
        return 0
    for row in lost.where(F.col("key_print") != key_fingerprint(secret)).take(1):
        raise DamagedStore(f"parsing {row.src_path} again needs the key it was parsed with")
    name = F.substring_index("src_path", "/", -1)
    there = present_files(lost.withColumn("src_file", F.try_url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))))
    again = shared(with_codec(there))
    for row in lost.join(again, "src_path", "left_anti").take(1):
        raise DamagedStore(f"{row.src_path} is gone, and so are stored rows of it")
    _parse(spark, root, again, secret, transform, layout)
    for row in unreadable_files(spark, root).join(lost, "src_path", "left_semi").take(1):
        raise DamagedStore(f"{row.src_path} cannot be read any more, and stored rows of it are lost")
    delete_parts(damaged)
    return lost.count()


def _current(spark, root, record: str, layout: Layout, files: DataFrame | None) -> DataFrame:
    stored = _stored(spark, root, layout).where(F.col("record") == record)
    known = manifest(spark, root)
    if files is not None:
        known = known.join(files.select("src_path"), "src_path", "left_semi")
    known = known.select("src_id", "run_id")
    if known.count() <= BROADCAST_FILES:
        known = F.broadcast(known)
    return stored.join(known, ["src_id", "run_id"], "left_semi").drop("record")


def current_rows(spark: SparkSession, root: str, layout: Layout = ACCESS_LOG) -> DataFrame:
    """The rows that count, unchecked, with ``run_id`` and ``src_id``."""
    return _current(spark, root, "row", layout, None)


def _parts_of(record: str, oldest: date | None = None) -> Column:
    """The parts of a record kind, of days after ``oldest``."""
    chosen = F.col("part").startswith(f"record={record}/")
    if oldest is not None:
        chosen = chosen & (F.regexp_extract("part", "log_date=([0-9-]+)", 1) > oldest.isoformat())
    return chosen


def read_rows(
    spark: SparkSession,
    root: str,
    layout: Layout = ACCESS_LOG,
    files: DataFrame | None = None,
    secret: bytes = b"",
    transform: Callable[[DataFrame], DataFrame] | None = None,
    verify: str | None = "digest",
    newer_than: date | None = None,
) -> DataFrame:
    """Parsed rows, with ``src_path``, ``src_file`` and ``log_date``.

    Of all files the manifest knows, or of those in a listing (``files``), which leaves out
    files that are gone by now; of days after ``newer_than``. Damaged parts are healed first, with
    ``secret`` and ``transform`` as in ``refresh``; ``verify`` says how they are found: by ``digest``
    (the bytes are read once more), by ``length``, or not at all (None).
    """
    if verify is not None:
        heal(spark, root, secret, transform, layout, _parts_of("row", newer_than), verify)
    rows = _current(spark, root, "row", layout, files).drop(*_REASONS.names)
    return rows if newer_than is None else rows.where(F.col("log_date") > newer_than)


def read_recent(
    spark: SparkSession, root: str, as_of: datetime, days: int = P.DEFAULT_WINDOW_DAYS, **reading
) -> DataFrame:
    """Rows of the files that ``is_recent`` selects; other partitions are neither checked nor opened."""
    return read_rows(spark, root, newer_than=(as_of - timedelta(days=days)).date(), **reading)


def read_rejects(
    spark: SparkSession,
    root: str,
    layout: Layout = ACCESS_LOG,
    files: DataFrame | None = None,
    secret: bytes = b"",
    verify: str | None = "digest",
) -> DataFrame:
    if verify is not None:
        heal(spark, root, secret, None, layout, _parts_of("reject"), verify)
    rejects = _current(spark, root, "reject", layout, files)
    return rejects.select("src_path", "src_file", "log_date", *_REASONS.names)


def drop_damaged(spark: SparkSession, root: str) -> DataFrame:
    """Marks the source files of damaged parts, so that the next refresh parses them; their paths.

    For stores whose source files or key are not at hand; otherwise reading heals by itself. Each
    file gets a ``dropped`` entry, then the damaged parts are deleted, also those nobody needs.
    """
    known = manifest(spark, root)
    damaged = shared(damaged_parts(spark, root, known))
    lost = shared(known.join(damaged.where("counts").select("src_id").distinct(), "src_id", "left_semi"))
    if not lost.isEmpty():
        dropped = lost.withColumns({"status": F.lit(DROPPED), "run_at": F.current_timestamp()})
        dropped.select(*MANIFEST.names).repartition(1).write.mode("append").parquet(f"{root}/manifest")
    delete_parts(damaged)
    return lost.select("src_path")
