"""Lines of log files read by byte ranges, by the tasks that parse them.

Neither paths nor lines pass the driver: a listing is a DataFrame, each of its rows becomes one
range or several, and a task opens the files of its ranges itself. Plain files are cut anywhere.
Large gzip and zstd files are cut where a member or frame starts: a task looks for the magic in its
range, takes a candidate if its first bytes decode, and owns the members that start inside. Files
of a single member cannot be cut; their lines are spread over tasks instead.

Lines may run across ranges and members. A range other than the first leaves out everything up to
its first line end, and every range reads on behind its end until one more line is complete; so each
line belongs to exactly one range, whatever the ranges are.

Defined results: empty files have no lines; a last line needs no line end; bytes that are not UTF-8
become the replacement character; a truncated or damaged member raises; zeros behind the last
member are padding, anything else there raises.
"""

from __future__ import annotations

import bz2
import math
import zlib
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitledger.stages import shared

#: Bytes on disk per range; bytes of text per task.
SPLIT_BYTES = 64 << 20
TASK_BYTES = 128 << 20
#: Text per byte of a compressed file, as estimated.
_EXPANSION = 8
_READ, _LOOK, _PROOF = 256 << 10, 1 << 20, 64 << 10
_MAGIC = {"gzip": b"\x1f\x8b\x08", "zstd": b"\x28\xb5\x2f\xfd", "bzip2": b"BZh"}
#: zstd frames that hold no data: the last three bytes of the magic, the first is 0x50 to 0x5f.
_SKIPPABLE = b"\x2a\x4d\x18"
LINES = "value string, src_path string, src_file string"
_SCHEMA = pa.schema([("value", pa.string()), ("src_path", pa.string()), ("src_file", pa.string())])


def open_uri(uri: str):
    """(pyarrow file system, path) of a URI; raises for stores that only Spark can open."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), unquote(uri.removeprefix("file:").removeprefix("//"))
    if uri.startswith("s3a://"):
        uri = "s3://" + uri[len("s3a://") :]
    return fs.FileSystem.from_uri(uri)


def _decoder(codec: str):
    if codec == "gzip":
        return zlib.decompressobj(31)
    if codec == "bzip2":
        return bz2.BZ2Decompressor()
    import zstandard

    return zstandard.ZstdDecompressor().decompressobj()


def _decoding_errors() -> tuple[type[Exception], ...]:
    try:
        import zstandard
    except ImportError:
        return (zlib.error, OSError, EOFError, ValueError)
    return (zlib.error, OSError, EOFError, ValueError, zstandard.ZstdError)


def _decodes(file, codec: str, at: int) -> bool:
    """Whether a member starts at an offset: its first bytes decode, with what checksums they reach."""
    decoder = _decoder(codec)
    try:
        return bool(decoder.decompress(file.read_at(_PROOF, at))) or decoder.eof
    except _decoding_errors():
        return False


def first_member(file, codec: str, start: int, stop: int) -> int | None:
    """Offset of the first member that starts in a range; None if there is none."""
    if start == 0:
        return 0
    magic = _MAGIC[codec]
    while start < stop:
        window = file.read_at(_LOOK + len(magic) - 1, start)
        found = window.find(magic)
        while 0 <= found < min(_LOOK, stop - start):
            if _decodes(file, codec, start + found):
                return start + found
            found = window.find(magic, found + 1)
        start += _LOOK
    return None


def _behind(file, codec: str, at: int, size: int) -> int | None:
    """Where the next member starts if one ended at ``at``; None at the end of the file."""
    while at < size:
        head = file.read_at(8, at)
        if head.startswith(_MAGIC[codec]):
            return at
        if codec == "zstd" and head[1:4] == _SKIPPABLE and head[0] >> 4 == 5 and len(head) == 8:
            at += 8 + int.from_bytes(head[4:], "little")
            continue
        if file.read_at(_READ, at).strip(b"\0"):
            raise ValueError(f"no {codec} member at byte {at}")
        at += _READ
    return None


def _decoded(file, codec: str, start: int, stop: int) -> Iterator[tuple[bytes, bool]]:
    """(bytes, whether they belong to a member that starts in the range), on to the file's end."""
    size = file.size()
    if codec == "plain":
        while start < size:
            inside = start < stop
            data = file.read_at(min(_READ, stop - start) if inside else _READ, start)
            yield data, inside
            start += len(data)
        return
    at = first_member(file, codec, start, stop)
    while at is not None:
        decoder, pos = _decoder(codec), at
        while not decoder.eof:
            data = file.read_at(_READ, pos)
            if not data:
                raise EOFError(f"the {codec} member at byte {at} is cut off")
            pos += len(data)
            found = decoder.decompress(data)
            if found:
                yield found, at < stop
        at = _behind(file, codec, pos - len(decoder.unused_data), size)


def whole_lines(pieces: Iterator[tuple[bytes, bool]], first: bool) -> Iterator[bytes]:
    """Blocks of the lines a range owns, each without its last line end."""
    skipping, rest = not first, bytearray()
    for data, inside in pieces:
        if skipping:
            if not inside:
                return
            end = data.find(b"\n")
            if end < 0:
                continue
            skipping, data = False, data[end + 1 :]
        end = data.rfind(b"\n") if inside else data.find(b"\n")
        if end < 0:
            rest += data
            continue
        rest += data[:end]
        yield bytes(rest)
        if not inside:
            return
        rest = bytearray(data[end + 1 :])
    if rest:
        yield bytes(rest)


def _strings(block: bytes) -> pa.Array:
    lines = pc.split_pattern(pa.array([block], pa.binary()), b"\n").flatten()
    try:
        return lines.cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([x.decode("utf-8", "replace") for x in lines.to_pylist()], pa.string())


def read_range(uri: str, name: str, codec: str, start: int, stop: int) -> Iterator[pa.RecordBatch]:
    """(value, src_path, src_file) of the lines of one range."""
    store, path = open_uri(uri)
    with store.open_input_file(path) as file:
        for block in whole_lines(_decoded(file, codec, start, stop), start == 0):
            values = _strings(block)
            n = len(values)
            yield pa.RecordBatch.from_arrays(
                [values, pa.repeat(pa.scalar(uri), n), pa.repeat(pa.scalar(name), n)], schema=_SCHEMA
            )


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            yield from read_range(row["src_path"], row["src_file"], row["codec"], row["start"], row["stop"])


def cut(files: DataFrame, split_bytes: int) -> DataFrame:
    """Ranges (src_path, src_file, codec, start, stop) of listed files with a ``codec``."""
    size = F.col("src_bytes")
    starts = F.explode(F.sequence(F.lit(0).cast("long"), size - 1, F.lit(split_bytes).cast("long")))
    ranges = files.where(size > 0).select("src_path", "src_file", "codec", size.alias("size"), starts.alias("start"))
    return ranges.withColumn("stop", F.least(F.col("start") + split_bytes, "size")).drop("size")


def divisible(files: DataFrame, split_bytes: int) -> DataFrame:
    """(src_path) of the compressed files in which members start in more than one range."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = []
            for row in batch.to_pylist():
                store, path = open_uri(row["src_path"])
                with store.open_input_file(path) as file:
                    if first_member(file, row["codec"], row["start"], row["stop"]) is not None:
                        paths.append(row["src_path"])
            yield pa.RecordBatch.from_pydict({"src_path": paths}, schema=pa.schema([("src_path", pa.string())]))

    ranges = cut(files, split_bytes)
    spread = ranges.repartition(files.sparkSession.sparkContext.defaultParallelism, "src_path", "start")
    found = spread.mapInArrow(look, "src_path string").groupBy("src_path").agg(F.count("*").alias("n"))
    return found.where("n > 1").select("src_path")


def ranges_of(files: DataFrame, heavy_bytes: int, split_bytes: int) -> tuple[DataFrame, DataFrame | None]:
    """Ranges of listed files, and of the large files of one member, which are a range each."""
    # bzip2 streams have no byte-aligned inside, so they are taken whole at any size
    heavy = (F.col("src_bytes") > heavy_bytes) & F.col("codec").isin("gzip", "zstd")
    packed = F.col("codec") != "plain"
    ranges = cut(files.where(~packed), split_bytes).unionByName(_whole(files.where(packed & ~heavy)))
    large = files.where(heavy)
    if large.isEmpty():
        return ranges, None
    members = shared(divisible(large, split_bytes))
    ranges = ranges.unionByName(cut(large.join(members, "src_path", "left_semi"), split_bytes))
    return ranges, _whole(large.join(members, "src_path", "left_anti"))


def _whole(files: DataFrame) -> DataFrame:
    start = F.lit(0).cast("long").alias("start")
    return files.select("src_path", "src_file", "codec", start, F.col("src_bytes").alias("stop"))


def _breaks(uri: str, codec: str, start: int, stop: int) -> bool:
    """Whether a member that starts in a range cannot be decoded to its end."""
    store, path = open_uri(uri)
    try:
        with store.open_input_file(path) as file:
            for _, inside in _decoded(file, codec, start, stop):
                if not inside:
                    break
    except OSError:
        # the store's, not the member's (but bzip2 says it of both): whoever reads the lines meets it
        return False
    except _decoding_errors():
        return True
    return False


def broken_files(files: DataFrame, heavy_bytes: int, split_bytes: int | None = None) -> DataFrame:
    """(src_path) of listed compressed files that cannot be decoded to their end.

    Decodes them by the ranges of ``lines_by_range`` and makes no lines, a small part of what parsing costs.
    """

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                if _breaks(row["src_path"], row["codec"], row["start"], row["stop"]):
                    yield pa.RecordBatch.from_pydict({"src_path": [row["src_path"]]})

    packed = files.where((F.col("src_bytes") > 0) & (F.col("codec") != "plain"))
    ranges, stuck = ranges_of(packed, heavy_bytes, split_bytes or SPLIT_BYTES)
    spread = (ranges if stuck is None else ranges.unionByName(stuck)).repartition(4 * files.sparkSession.sparkContext.defaultParallelism)
    return spread.mapInArrow(look, "src_path string").distinct()


def lines_by_range(
    files: DataFrame, heavy_bytes: int, split_bytes: int | None = None, task_bytes: int | None = None
) -> DataFrame | None:
    """Lines of listed files (src_path, src_file, src_bytes, codec); None if there are none.

    Compressed files up to ``heavy_bytes`` are one range. The listing is read several times, so it
    should be a written table; what comes to the driver is one row of totals.
    """
    split_bytes, task_bytes = split_bytes or SPLIT_BYTES, task_bytes or TASK_BYTES
    files = files.where("src_bytes > 0")
    if files.isEmpty():
        return None
    ranges, stuck = ranges_of(files, heavy_bytes, split_bytes)
    # writers sort what a task reads by day, so it is the text that has to be bounded
    text_bytes = (F.col("stop") - F.col("start")) * F.when(F.col("codec") == "plain", 1).otherwise(_EXPANSION)
    total, n_ranges = ranges.agg(F.coalesce(F.sum(text_bytes), F.lit(0)), F.count("*")).first()
    cores = files.sparkSession.sparkContext.defaultParallelism
    parts = []
    if n_ranges:
        tasks = min(n_ranges, max(cores, math.ceil(total / task_bytes)))
        parts.append(ranges.repartition(tasks).mapInArrow(_read, LINES))
    if stuck is not None:
        held, n_stuck = stuck.agg(F.coalesce(F.sum("stop"), F.lit(0)), F.count("*")).first()
        if n_stuck:
            lines = stuck.repartition(n_stuck, "src_path").mapInArrow(_read, LINES)
            # a task decodes the only member; its lines go to as many as their text would fill
            parts.append(lines.repartition(max(4 * cores, math.ceil(_EXPANSION * held / task_bytes))))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
