"""The derived log as files, packed in every way that log files come.

Tasks write one file per name, in the order of the events, line by line. Which packing a file gets
follows from the day in its name: gzip in one member, gzip in many, zstd and plain text under a
name that says gzip. Files of the server ``broken`` repeat some of another's but are cut off.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitledger.plans import sample_log
from hitledger.sources.ranges import open_uri
from hitledger.stages import new_folder, shared

MEMBER_LINES = 50
BROKEN = "access_broken"


def packing(name: Column) -> Column:
    """By the day in a name: gzip (also 4), members, zstd, plain for remainders of five; no day: plain."""
    day = F.regexp_extract(name, r"(\d\d)\.gz$", 1).try_cast("int")
    kinds = F.array(*[F.lit(k) for k in ("gzip", "members", "zstd", "plain", "gzip")])
    kind = F.when(day.isNull(), "plain").otherwise(F.get(kinds, day % 5))
    return F.when(name.startswith(BROKEN), "broken").otherwise(kind)


def with_broken_copies(lines: DataFrame) -> DataFrame:
    """Adds the lines of the files to be cut off: those of one server on days with remainder 4 of nine."""
    name = F.col("src_file")
    day = F.regexp_extract(name, r"(\d\d)\.gz$", 1).try_cast("int")
    copy = F.replace(name, F.lit("access_kr"), F.lit(BROKEN))
    # both names at once, so that no line is made twice
    names = F.when(name.startswith("access_kr.") & (day % 9 == 4), F.array(name, copy)).otherwise(F.array(name))
    return lines.withColumn("src_file", F.explode(names))


class _Writer:
    """One file being written."""

    def __init__(self, uri: str, kind: str):
        store, path = open_uri(uri)
        store.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.out, self.kind, self.lines = store.open_output_stream(path, compression=None), kind, 0
        self._open()

    def _open(self) -> None:
        if self.kind == "zstd":
            import zstandard

            self.packer = zstandard.ZstdCompressor().compressobj()
        else:
            self.packer = zlib.compressobj(6, zlib.DEFLATED, 31)

    def write(self, line: str) -> None:
        data = line.encode() + b"\n"
        if self.kind == "members" and self.lines and self.lines % MEMBER_LINES == 0:
            self.out.write(self.packer.flush())
            self._open()
        self.out.write(data if self.kind == "plain" else self.packer.compress(data))
        self.lines += 1

    def close(self) -> None:
        if self.kind == "broken":
            # some of the stream, without its end
            self.out.write(self.packer.flush()[:-20])
        elif self.kind != "plain":
            self.out.write(self.packer.flush())
        self.out.close()


def write_files(lines: DataFrame, folder: str) -> DataFrame:
    """Writes (event_id, src_file, line) as files below ``folder``; (src_file, n) of what was written."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, writer, done = None, None, []
        for batch in batches:
            for new, kind, line in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if new != name:
                    if writer is not None:
                        writer.close()
                        done.append((name, writer.lines))
                    name, writer = new, _Writer(f"{folder}/{new}", kind)
                writer.write(line)
        if writer is not None:
            writer.close()
            done.append((name, writer.lines))
        yield pa.RecordBatch.from_pydict(
            {"src_file": pa.array([d[0] for d in done], pa.string()), "n": pa.array([d[1] for d in done], pa.int64())}
        )

    named = lines.select("src_file", packing(F.col("src_file")).alias("kind"), "line", "event_id")
    cores = lines.sparkSession.sparkContext.defaultParallelism
    ordered = named.repartition(4 * cores, "src_file").sortWithinPartitions("src_file", "event_id")
    return shared(ordered.select("src_file", "kind", "line").mapInArrow(write, "src_file string, n long"))


_folders: dict[tuple[str, str, str], str] = {}


def made_once(spark: SparkSession, sf_dir: str, kind: str, make) -> str:
    """A folder that ``make(path)`` fills, kept for the session's other queries on the same tables."""
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _folders:
        path = new_folder(spark, kind)
        make(path)
        _folders[key] = path
    return _folders[key]


def log_folder(spark: SparkSession, sf_dir: str) -> str:
    """The derived log as files, with the broken ones."""

    def make(path: str) -> None:
        lines = sample_log.log_lines(spark, sf_dir).select("event_id", "src_file", "line")
        write_files(with_broken_copies(lines), path)

    return made_once(spark, sf_dir, "logs", make)


def mirror_folder(spark: SparkSession, sf_dir: str) -> str:
    """Daily logs of a mirror: the same lines with the paths a mirror has, in a folder per day."""

    def make(path: str) -> None:
        lines = sample_log.log_lines(spark, sf_dir)
        day = F.date_format("ts", "yyyyMMdd")
        name = F.concat(F.lit("day="), day, F.lit("/mirrors.log-"), day, F.lit(".gz"))
        line = F.replace("line", F.lit("GET /"), F.lit("GET /julia/"))
        write_files(lines.select("event_id", name.alias("src_file"), line.alias("line")), path)

    return made_once(spark, sf_dir, "mirror", make)
