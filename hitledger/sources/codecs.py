"""Compression by content, for files whose name does not tell the truth.

Spark picks a decompressor by file extension. ``with_codec`` reads the first six bytes of
every listed file on the executors; ``ranges`` reads the files by that codec, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitledger.functions import patterns as P
from hitledger.sources.ranges import open_uri

_BLOCK = 4 << 20
DECODABLE = ["plain", "gzip", "zstd", "bzip2"]


def _leading_bytes(uri: str) -> str | None:
    """Hex of the first bytes; None for stores that only Spark can open."""
    try:
        system, path = open_uri(uri)
    except (ValueError, ImportError, OSError):
        return None
    with system.open_input_stream(path, compression=None) as stream:
        return stream.read(6).hex()


@F.pandas_udf(T.StringType())
def _head_of(uris: pd.Series) -> pd.Series:
    return uris.map(_leading_bytes)


def codec_of_head(head: Column) -> Column:
    """Codec name for the hex of a file's first bytes."""
    out = None
    for name, magic in P.MAGIC.items():
        test = head.startswith(magic)
        out = F.when(test, name) if out is None else out.when(test, name)
    return out.otherwise("plain")


def codec_of_name(name: Column) -> Column:
    return (
        F.when(name.endswith(".gz"), "gzip")
        .when(name.endswith(".zst"), "zstd")
        .when(name.endswith(".bz2"), "bzip2")
        .otherwise("plain")
    )


def with_codec(files: DataFrame) -> DataFrame:
    """Adds ``codec`` (by content), ``as_named`` (text source can read it), ``decodable``, ``reachable``.

    Files that cannot be opened beside Spark are not reachable; their codec is that of the name.
    """
    # an explicit number: adaptive execution would open all these files in one task
    spread = files.repartition(files.sparkSession.sparkContext.defaultParallelism, "src_path")
    # where only the session's own file systems reach, the name has to be trusted
    head = _head_of(F.col("src_path"))
    looked = spread.withColumn("_head", head)
    codec = F.when(F.col("_head").isNull(), codec_of_name(F.col("src_file"))).otherwise(codec_of_head(F.col("_head")))
    sniffed = looked.withColumns({"codec": codec, "reachable": F.col("_head").isNotNull()}).drop("_head")
    return sniffed.withColumns(
        {
            "as_named": F.col("codec") == codec_of_name(F.col("src_file")),
            "decodable": F.col("codec").isin(*DECODABLE),
        }
    )


def undecodable_files(files: DataFrame) -> DataFrame:
    """Files no job reads, for the report on rejected files."""
    return files.where(~F.col("decodable"))


def damaged_files(files: DataFrame) -> DataFrame:
    """(src_path) of files that cannot be decoded to their end. Reads all of them."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bad = []
            for uri, codec in zip(batch["src_path"], batch["codec"]):
                try:
                    for _ in _lines_of(uri, codec):
                        pass
                except (OSError, EOFError, ValueError):
                    bad.append(uri)
            yield pd.DataFrame({"src_path": pd.Series(bad, dtype="object")})

    tasks = max(1, files.sparkSession.sparkContext.defaultParallelism)
    return files.select("src_path", "codec").repartition(tasks, "src_path").mapInPandas(check, "src_path string")


def _lines_of(uri: str, codec: str) -> Iterator[list[str]]:
    system, path = open_uri(uri)
    compression = {"plain": None, "bzip2": "bz2"}.get(codec, codec)
    rest = b""
    with system.open_input_stream(path, compression=compression) as stream:
        while block := stream.read(_BLOCK):
            *whole, rest = (rest + block).split(b"\n")
            yield [w.decode("utf-8", "replace") for w in whole]
    if rest:
        yield [rest.decode("utf-8", "replace")]
