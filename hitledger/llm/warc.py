"""Gzipped WARC archives: a writer with revisit records and a splittable reader.

Writer: every task writes one archive, each record a gzip member of its own, under a name no other
attempt uses. Tasks return (path, bytes, records) of what they closed; only files in that manifest
count, so what a lost or repeated attempt left behind is never read. Of records with equal payloads
of ``LEAST_BYTES`` or more, the one with the smallest id is a response; the others are revisits that
name it and carry digest and length of the payload.

Reader: the archives are cut into byte ranges. A task looks for the gzip magic in its range, takes a
candidate as a member if it decodes to the version line of a WARC header, whatever the header's length,
and owns the records that start inside; the last one may end beyond. Behind a member the next is expected at once; if it isn't there, the task
searches again. So any range can be read alone, and no index is needed. (A member that holds
another archive uncompressed could mislead a range that starts inside it; text payloads can't, as
the magic isn't valid UTF-8.)

Defined results: null payload is empty; empty payloads are responses; rows with equal ids and equal
payloads are all responses; rows without id come last and refer to the smallest id; null URLs get
a name from the id; an empty table gives no archive and no records. A damaged member raises, and so does ``complete`` if
the records read from an archive are not as many as its manifest says.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitledger.joins import join_by_hot_key
from hitledger.stages import new_folder, shared

LEAST_BYTES = 100
LEVEL = 3
SPLIT_BYTES = 8 << 20
READ_BYTES = 256 << 10
MAGIC = b"\x1f\x8b\x08"
#: A candidate must decode to a whole line like this; how long the header goes on doesn't matter.
VERSION = re.compile(rb"WARC/\d{1,9}\.\d{1,9}\r\n")
VERSION_BYTES, LOOK_BYTES = 32, 4096
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = (
    "path string, offset long, record_type string, record_id string, target_uri string, "
    "refers_to string, digest string, content_length long, payload binary"
)


def _name(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def _member(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields)
    data = head.encode() + b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def record_bytes(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """One gzip member: a response, or a revisit if ``refers_to`` is given."""
    uri = quote(url, safe=":/?#[]@!$&'()*+,;=%-._~") if url else f"urn:x-page:{page_id}"
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _name(page_id)),
        ("WARC-Date", date),
        ("WARC-Target-URI", uri),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http;msgtype=response"),
    ]
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _name(refers_to))]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    return _member(fields, http if refers_to is not None else http + payload)


def with_references(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """Adds ``digest`` and, for repeated payloads, ``refers_to`` to (page_id, url, payload)."""
    hashed = pages.withColumn("digest", F.sha2("payload", 256))
    large = F.when(F.octet_length("payload") >= least, F.col("digest"))
    firsts = (
        pages.select("page_id", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").alias("size"))
        .where(F.col("size") >= least)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1 and first is not null")
        .withColumnRenamed("digest", "__digest")
    )
    joined = join_by_hot_key(hashed.withColumn("__digest", large), shared(firsts), "__digest", "n", "left")
    refers = F.when(F.col("page_id").isNull() | (F.col("page_id") > F.col("first")), F.col("first"))
    return joined.withColumn("refers_to", refers).select("page_id", "url", "payload", "digest", "refers_to")


def write_archives(pages: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Writes (page_id, url, payload, digest, refers_to); the manifest (path, bytes, records)."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, count = None, f"{folder}/{uuid.uuid4().hex}.warc.gz", 0
        for batch in batches:
            columns = [batch.column(i) for i in range(5)]
            for i in range(batch.num_rows):
                if out is None:
                    store, name = fs.FileSystem.from_uri(path)
                    store.create_dir(name.rsplit("/", 1)[0], recursive=True)
                    out = store.open_output_stream(name, compression=None)  # members are packed here
                    info = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date)]
                    out.write(_member([*info, ("Content-Type", "application/warc-fields")], b"software: hitledger\r\n"))
                page, url, payload, digest, refers = (c[i].as_py() for c in columns)
                out.write(record_bytes(page, url, payload, digest, refers, date))
                count += 1
        if out is not None:
            size = out.tell()
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "bytes": [size], "records": [count]})

    return shared(pages.mapInArrow(write, "path string, bytes long, records long"))


class _Range:
    """The gzip members that start between two offsets of an open file."""

    def __init__(self, file, start: int, stop: int):
        self.file, self.start, self.stop, self.size = file, start, stop, file.size()

    def decoded(self, at: int) -> tuple[bytes, int] | None:
        """What the member at an offset decodes to, and its end; None if it doesn't decode."""
        packed, parts, pos = zlib.decompressobj(31), [], at
        try:
            while not packed.eof and pos < self.size:
                data = self.file.read_at(min(READ_BYTES, self.size - pos), pos)
                pos += len(data)
                parts.append(packed.decompress(data))
        except zlib.error:
            return None
        return (b"".join(parts), pos - len(packed.unused_data)) if packed.eof else None

    def is_record(self, at: int) -> bool:
        """Whether the bytes at an offset decode to the version line of a record; no more is decoded."""
        packed, head, pos = zlib.decompressobj(31), b"", at
        try:
            while len(head) < VERSION_BYTES and not packed.eof and pos < self.size:
                data = self.file.read_at(min(LOOK_BYTES, self.size - pos), pos)
                pos += len(data)
                head += packed.decompress(data, VERSION_BYTES)
        except zlib.error:
            return False
        return VERSION.match(head) is not None

    def candidate(self, at: int) -> int | None:
        """The first offset from ``at`` on, before the range's end, where a record starts."""
        while at < self.stop:
            window = self.file.read_at(min(READ_BYTES, self.size - at), at)
            found = window.find(MAGIC)
            while found >= 0 and at + found < self.stop:
                if self.is_record(at + found):
                    return at + found
                found = window.find(MAGIC, found + 1)
            if len(window) < READ_BYTES:
                return None
            at += len(window) - len(MAGIC) + 1
        return None

    def records(self) -> Iterator[tuple[int, bytes]]:
        at = self.candidate(self.start)
        while at is not None:
            found = self.decoded(at)
            if found is None:
                raise ValueError(f"the gzip member at byte {at} is damaged")
            yield at, found[0]
            end = found[1]
            if end >= self.stop:
                return
            at = end if self.file.read_at(len(MAGIC), end) == MAGIC and self.is_record(end) else self.candidate(end)


def parse_record(data: bytes) -> tuple[dict[str, str], int | None, bytes]:
    """Named fields (lower case), the HTTP content length if there is one, and the payload."""
    head, ended, rest = data.partition(b"\r\n\r\n")
    if not ended:
        raise ValueError("a record's header has no end")
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    block = rest[: int(fields.get("content-length", len(rest)))]
    if len(block) < int(fields.get("content-length", 0)):
        raise ValueError("a record's block is shorter than its header says")
    if not fields.get("content-type", "").startswith("application/http"):
        return fields, None, block
    http, _, payload = block.partition(b"\r\n\r\n")
    lengths = [v for k, _, v in (x.partition(b":") for x in http.split(b"\r\n")) if k.strip().lower() == b"content-length"]
    return fields, int(lengths[0]) if lengths else None, payload


def read_archives(files: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Records of gzipped archives, given (path, bytes), by byte ranges of ``split_bytes``."""
    ranges = files.where("bytes > 0").select(
        "path", F.explode(F.sequence(F.lit(0), F.col("bytes") - 1, F.lit(split_bytes))).alias("start"), "bytes"
    )
    ranges = ranges.withColumn("stop", F.least(F.col("start") + split_bytes, "bytes")).drop("bytes")
    tasks = max(1, ranges.count())
    schema = pa.schema([
        ("path", pa.string()), ("offset", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string()),
        ("target_uri", pa.string()), ("refers_to", pa.string()), ("digest", pa.string()),
        ("content_length", pa.int64()), ("payload", pa.binary()),
    ])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for part in batch.to_pylist():
                store, name = fs.FileSystem.from_uri(part["path"])
                with store.open_input_file(name) as file:
                    for offset, data in _Range(file, part["start"], part["stop"]).records():
                        fields, length, payload = parse_record(data)
                        names = ("warc-type", "warc-record-id", "warc-target-uri", "warc-refers-to", "warc-payload-digest")
                        rows.append((part["path"], offset, *map(fields.get, names), length, payload))
                        held += len(payload)
                        if held > SPLIT_BYTES:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                            rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    spread = ranges.repartition(tasks, F.xxhash64("path", "start"))
    return spread.mapInArrow(read, RECORD)


def archive_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, bytes) of the archives below a folder, listed by Spark."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.warc.gz")
    return listed.load(folder).select("path", F.col("length").alias("bytes"))


def complete(records: DataFrame, manifest: DataFrame) -> DataFrame:
    """``records`` (path and more, a written table), once each archive is known to have given all of them."""
    read = records.groupBy("path").agg(F.count("*").alias("found"))
    found = F.coalesce("found", F.lit(0))
    short = manifest.join(read, "path", "left").where(found != F.col("records")).select("path", "records", found.alias("found"))
    for path, records_written, records_read in short.take(1):
        raise ValueError(f"{path} holds {records_written} records, {records_read} were read")
    return records


def op6_warc(spark, sf_dir: str) -> DataFrame:
    """Writes all pages to archives and reads them back."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select(
        "page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload")
    )
    manifest = write_archives(with_references(pages), new_folder(spark, "warc"))
    records = read_archives(manifest.select("path", "bytes")).where("record_type in ('response', 'revisit')")

    def page(name: str) -> Column:
        return F.nullif(F.regexp_extract(name, r"^<urn:x-page:(-?\d*)>$", 1), F.lit("")).cast("long")

    is_response = F.col("record_type") == "response"
    slim = records.select(
        "path",
        page("record_id").alias("page_id"),
        F.when(is_response, F.octet_length("payload")).otherwise(F.col("content_length")).cast("long").alias("payload_bytes"),
        F.when(is_response, F.sha2("payload", 256)).otherwise(F.substring_index("digest", ":", -1)).alias("payload_digest"),
        "record_type",
        page("refers_to").alias("refers_to"),
    )
    return complete(shared(slim), manifest).drop("path")


OP6_SQL = f"""
with hashed as (
  select page_id, strlen(coalesce(html, '')) as n, sha256(coalesce(html, '')) as d from pages),
firsts as (select *, min(page_id) over (partition by d) as first from hashed),
typed as (
  select *, n >= {LEAST_BYTES} and first is not null and (page_id is null or page_id > first) as again from firsts)
select page_id, cast(n as bigint) as payload_bytes, d as payload_digest,
  case when again then 'revisit' else 'response' end as record_type,
  case when again then first end as refers_to
from typed
"""
