"""Log files cut into byte ranges give the lines that the whole files hold, wherever the cuts are."""

import bz2
import gzip
import pathlib
import random

import pytest
import zstandard
from pyspark.sql import functions as F

from hitledger.sources import ranges, textscan
from hitledger.sources.codecs import with_codec
from hitledger.sources.listing import list_files
from hitledger.stages import shared


def members(codec, data, size):
    """``data`` in members of ``size`` bytes, whatever lines that cuts."""
    parts = [data[i : i + size] for i in range(0, len(data), size)] or [b""]
    if codec == "gzip":
        return b"".join(gzip.compress(p) for p in parts)
    if codec == "bzip2":
        return b"".join(bz2.compress(p) for p in parts)
    frames = [zstandard.ZstdCompressor().compress(p) for p in parts]
    skippable = b"\x53\x2a\x4d\x18" + (5).to_bytes(4, "little") + b"notes"
    return skippable.join(frames)


def text(seed, n):
    rng = random.Random(seed)
    lines = ["x" * rng.choice([0, 1, 5, 80, 3000]) + f" {rng.random()} é" for _ in range(n)]
    return lines, "\n".join(lines).encode()


def read(path, codec, size, split):
    out = []
    for start in range(0, size, split):
        for batch in ranges.read_range(path.as_uri(), path.name, codec, start, min(start + split, size)):
            out += batch.column("value").to_pylist()
    return out


@pytest.mark.parametrize("codec", ["plain", "gzip", "zstd"])
def test_every_cut_gives_every_line_once(tmp_path, codec):
    for seed, (n, member) in enumerate([(60, 700), (60, 20_000), (7, 50), (1, 3), (40, 1 << 30)]):
        lines, data = text(seed, n)
        for tail in (b"", b"\n", b"\n\nlast"):
            want = lines + {b"": [], b"\n": [], b"\n\nlast": ["", "last"]}[tail]
            packed = data + tail if codec == "plain" else members(codec, data + tail, member)
            path = tmp_path / f"{codec}-{seed}-{len(tail)}"
            path.write_bytes(packed)
            for split in {101, 997, 8192, len(packed)}:
                assert read(path, codec, len(packed), split) == want, (codec, seed, tail, split)


def test_lookalikes_padding_and_damage(tmp_path):
    noise = random.Random(1).randbytes(3000)
    lines = [noise[i : i + 30].hex() for i in range(0, 3000, 30)]
    stored = gzip.compress("\n".join(lines[:50]).encode() + b"\n", 0) + gzip.compress(b"\x1f\x8b\x08" * 300 + b"\n", 0)
    whole = stored + gzip.compress("\n".join(lines[50:]).encode())
    path = tmp_path / "a.gz"
    path.write_bytes(whole + b"\0" * 700)
    want = [*lines[:50], (b"\x1f\x8b\x08" * 300).decode("utf-8", "replace"), *lines[50:]]
    for split in (37, 500, 10_000):
        assert read(path, "gzip", len(whole) + 700, split) == want
    path.write_bytes(whole + b"rubbish")
    with pytest.raises(ValueError, match="no gzip member"):
        read(path, "gzip", len(whole) + 7, 10_000)
    path.write_bytes(whole[:-9])
    with pytest.raises(EOFError, match="cut off"):
        read(path, "gzip", len(whole) - 9, 500)


def listed(spark, folder):
    return shared(with_codec(list_files(spark, str(folder))))


def test_large_files_are_read_by_their_members_without_moving_lines(spark, tmp_path):
    everything = []
    for k, codec in enumerate(("gzip", "zstd", "bzip2", "plain")):
        lines, data = text(k, 400)
        lines = [f"{k} {x}" for x in lines]
        data = "\n".join(lines).encode() + b"\n"
        name = {"gzip": "g.gz", "zstd": "misnamed.gz", "bzip2": "b.bz2", "plain": "p.log"}[codec]
        (tmp_path / name).write_bytes(data if codec == "plain" else members(codec, data, 9000))
        everything += lines
    for heavy, split in ((1 << 30, 1 << 20), (1000, 2000), (1000, 50_000)):
        got = ranges.lines_by_range(listed(spark, tmp_path), heavy, split, 4000)
        assert sorted(r.value for r in got.collect()) == sorted(everything)
        # only listings and ranges are exchanged: no exchange has the lines
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert not any("value#" in x for x in plan.splitlines() if "Exchange" in x)
    parts = ranges.lines_by_range(listed(spark, tmp_path), 1000, 2000, 4000).select(F.spark_partition_id().alias("p"), "src_file")
    assert parts.where("src_file = 'g.gz'").distinct().count() >= 3


def test_a_single_member_is_spread(spark, tmp_path):
    lines, data = text(9, 500)
    (tmp_path / "one.gz").write_bytes(gzip.compress(data))
    (tmp_path / "many.gz").write_bytes(members("gzip", data, 5000))
    files = listed(spark, tmp_path)
    assert [r.src_path.rsplit("/", 1)[1] for r in ranges.divisible(files, 2000).collect()] == ["many.gz"]
    got = ranges.lines_by_range(files, 1000, 2000)
    assert sorted(r.value for r in got.collect()) == sorted(lines * 2)
    spread = got.where("src_file = 'one.gz'").select(F.spark_partition_id()).distinct().count()
    assert spread >= 4


def test_listings_of_any_size_stay_out_of_the_driver(spark, tmp_path, monkeypatch):
    """Rows of 100,000 files; what reaches the driver are rows of totals."""
    (tmp_path / "a.log").write_bytes(b"one\ntwo\n")
    uri = (tmp_path / "a.log").as_uri()
    files = spark.range(100_000).select(
        F.lit(uri).alias("src_path"),
        F.concat(F.lit("f"), "id").alias("src_file"),
        F.lit(8).cast("long").alias("src_bytes"),
        F.lit("plain").alias("codec"),
        F.lit(True).alias("as_named"),
        F.lit(True).alias("decodable"),
        F.lit(True).alias("reachable"),
    )
    files = shared(files)
    seen = []
    plain = type(files).collect
    monkeypatch.setattr(type(files), "collect", lambda self: seen.append(found := plain(self)) or found)
    monkeypatch.setattr(type(files), "toArrow", lambda self: pytest.fail("a table came to the driver"))
    lines = textscan.lines_of_files(spark, files)
    assert all(len(found) <= 1 for found in seen)
    monkeypatch.undo()
    few = lines.where("src_file < 'f10'")
    assert few.count() == 2 * files.where("src_file < 'f10'").count()


def test_nothing_to_read(spark, tmp_path):
    (tmp_path / "empty.gz").write_bytes(b"")
    files = listed(spark, tmp_path)
    assert ranges.lines_by_range(files, 1000) is None and textscan.lines_of_files(spark, files) is None
    assert pathlib.Path(tmp_path, "empty.gz").exists()


def test_tasks_are_counted_by_text(spark, tmp_path):
    """Compressed files become as many tasks as their text would fill."""
    lines, data = text(5, 400)
    for k in range(24):
        (tmp_path / f"{k}.gz").write_bytes(gzip.compress(data))
    files, size = listed(spark, tmp_path), len(gzip.compress(data))
    got = ranges.lines_by_range(files, 1 << 30, 1 << 20, 8 * size)
    assert got.count() == 24 * len(lines)
    assert got.rdd.getNumPartitions() == 24
    assert ranges.lines_by_range(files, 1 << 30, 1 << 20, 1 << 30).rdd.getNumPartitions() == 4


def test_broken_members_are_found_in_any_range(spark, tmp_path):
    _, data = text(6, 500)
    for codec in ("gzip", "zstd", "bzip2"):
        whole = members(codec, data, 9000)
        (tmp_path / f"{codec}-whole").write_bytes(whole + (b"\0" * 600 if codec == "gzip" else b""))
        (tmp_path / f"{codec}-cut").write_bytes(whole[:-9])
    (tmp_path / "one-whole").write_bytes(gzip.compress(data))
    (tmp_path / "one-cut").write_bytes(gzip.compress(data)[:-9])
    (tmp_path / "garbage").write_bytes(gzip.compress(data) + b"more")
    (tmp_path / "plain").write_bytes(data)
    files = listed(spark, tmp_path)
    for heavy, split in ((1 << 30, 1 << 20), (1000, 2000)):
        found = ranges.broken_files(files, heavy, split).collect()
        assert sorted(r.src_path.rsplit("/", 1)[1] for r in found) == ["bzip2-cut", "garbage", "gzip-cut", "one-cut", "zstd-cut"]
