"""Reading heals damaged parts; streams and refresh share one store."""

import os
import pathlib
import time

import pytest
from pyspark.sql import functions as F

from hitledger.plans import refresh
from hitledger.plans.parts import recorded
from hitledger.streaming import ingest
from test_sources_and_refresh import AS_OF, LINES, name_of, put

GOOD = [x for x in LINES if x.startswith("1")]


@pytest.fixture
def store(spark, tmp_path):
    logs, root = tmp_path / "logs", str(tmp_path / "store")
    logs.mkdir()
    put(logs, name_of("kr", 20240110), GOOD[:3])
    put(logs, name_of("us-east", 20240111, "zst"), [*GOOD[3:], "garbage"])
    assert refresh.refresh(spark, root, str(logs), F.lit(True), b"k") == 2
    return logs, root


def parts(root, day, record="row"):
    return sorted(pathlib.Path(root, "table").glob(f"run_id=*/record={record}/log_date={day}/*.parquet"))


def damage(path, how):
    data = path.read_bytes()
    for crc in path.parent.glob(".*.crc"):
        crc.unlink()
    if how == "missing":
        path.unlink()
    elif how == "cut":
        path.write_bytes(data[:-5])
    elif how == "other":
        path.write_bytes(b"not parquet at all")
    else:
        # one bit, in the middle of the pages
        path.write_bytes(data[:40] + bytes([data[40] ^ 1]) + data[41:])


def values(df):
    return sorted(map(str, df.drop("run_id").collect()))


@pytest.mark.parametrize("how", ["missing", "cut", "other", "flipped"])
def test_reading_heals(spark, store, how):
    logs, root = store
    rows, rejects = values(refresh.read_rows(spark, root, secret=b"k")), values(refresh.read_rejects(spark, root, secret=b"k"))
    assert len(rows) == len(GOOD)
    before = {r.run_id for r in recorded(spark, root).collect()}
    damage(parts(root, "2024-01-10")[0], how)
    assert values(refresh.read_rows(spark, root, secret=b"k")) == rows
    # only the file with rows in the damaged part was parsed again
    healed = recorded(spark, root).where(~F.col("run_id").isin(*before))
    assert healed.select("src_id").distinct().count() == 1
    assert values(refresh.read_rejects(spark, root, secret=b"k")) == rejects
    assert refresh.refresh(spark, root, str(logs), F.lit(True), b"k") == 0
    assert refresh.heal(spark, root, b"k") == 0
    damage(parts(root, "2024-01-11", "reject")[0], how)
    assert values(refresh.read_rejects(spark, root, secret=b"k")) == rejects


def test_only_what_is_read_is_checked(spark, store):
    logs, root = store
    damage(parts(root, "2024-01-10")[0], "cut")
    known = recorded(spark, root).count()
    recent = refresh.read_recent(spark, root, AS_OF, 10, secret=b"k")
    assert {r.src_file for r in recent.collect()} == {name_of("us-east", 20240111, "zst")}
    assert recorded(spark, root).count() == known
    assert refresh.read_recent(spark, root, AS_OF, 11, secret=b"k").count() == len(GOOD)
    assert recorded(spark, root).count() > known


def test_lengths_find_cuts_but_not_flips(spark, store):
    logs, root = store
    damage(parts(root, "2024-01-10")[0], "cut")
    assert refresh.heal(spark, root, b"k", verify="length") == 1
    [part] = [p for p in parts(root, "2024-01-10")]
    damage(part, "flipped")
    assert refresh.heal(spark, root, b"k", verify="length") == 0
    assert refresh.heal(spark, root, b"k") == 1


def test_what_cannot_be_parsed_again_raises(spark, store):
    logs, root = store
    damage(parts(root, "2024-01-10")[0], "other")
    with pytest.raises(refresh.DamagedStore, match="needs the key"):
        refresh.read_rows(spark, root, secret=b"another")
    source = logs / name_of("kr", 20240110)
    data = source.read_bytes()
    source.write_bytes(data[:-6])
    with pytest.raises(refresh.DamagedStore, match="cannot be read any more"):
        refresh.read_rows(spark, root, secret=b"k")
    source.write_bytes(data)
    os.utime(source, (time.time() + 5, time.time() + 5))
    assert refresh.refresh(spark, root, str(logs), F.lit(True), b"k") == 1
    # rows of the file come from the new run alone; the damaged part is nobody's
    assert refresh.read_rows(spark, root, secret=b"k").count() == len(GOOD)


def test_a_source_that_is_gone_raises(spark, store):
    logs, root = store
    (logs / name_of("kr", 20240110)).unlink()
    assert refresh.read_rows(spark, root, secret=b"k").count() == len(GOOD)
    damage(parts(root, "2024-01-10")[0], "missing")
    with pytest.raises(refresh.DamagedStore, match="is gone"):
        refresh.read_rows(spark, root, secret=b"k")


def test_an_emptied_file_loses_its_rows(spark, store):
    logs, root = store
    path = logs / name_of("kr", 20240110)
    path.write_bytes(b"")
    os.utime(path, (time.time() + 5, time.time() + 5))
    assert refresh.refresh(spark, root, str(logs), F.lit(True), b"k") == 1
    assert refresh.read_rows(spark, root, secret=b"k").count() == len(GOOD) - 3


def test_a_streamed_file_counts_once_after_it_is_rewritten(spark, tmp_path):
    logs, root, checkpoint = tmp_path / "logs", str(tmp_path / "store"), str(tmp_path / "checkpoint")
    logs.mkdir()
    run = lambda: ingest.ingest_into_store(spark, root, str(logs), checkpoint, b"k", files_per_batch=1)
    put(logs, name_of("kr", 20240110), GOOD[:3])
    put(logs, name_of("kr", 20240111), GOOD[3:])
    run()
    assert refresh.read_rows(spark, root, secret=b"k").count() == len(GOOD)
    assert len({r.run_id for r in refresh.manifest(spark, root).collect()}) == 2
    # the batch job finds nothing to do, then only the rewritten file
    batch = lambda: refresh.refresh(spark, root, str(logs), F.lit(True), b"k")
    assert batch() == 0
    path = put(logs, name_of("kr", 20240110), GOOD[:2])
    os.utime(path, (time.time() + 5, time.time() + 5))
    assert batch() == 1
    assert refresh.read_rows(spark, root, secret=b"k").count() == len(GOOD) - 1
    put(logs, name_of("kr", 20240112), [*GOOD[:1], "garbage"])
    run()
    assert refresh.read_rows(spark, root, secret=b"k").count() == len(GOOD)
    assert refresh.read_rejects(spark, root, secret=b"k").count() == 1
    assert batch() == 0
    # streamed parts heal like any other
    damage(parts(root, "2024-01-12")[0], "cut")
    assert refresh.read_rows(spark, root, secret=b"k").count() == len(GOOD)


def test_a_repeated_batch_counts_once(spark, tmp_path):
    logs, root = tmp_path / "logs", str(tmp_path / "store")
    logs.mkdir()
    put(logs, name_of("kr", 20240110), GOOD)
    for attempt in ("a", "b"):
        ingest.ingest_into_store(spark, root, str(logs), str(tmp_path / attempt), b"k")
    assert refresh.read_rows(spark, root, secret=b"k").count() == len(GOOD)
    assert len(refresh.remove_superseded(spark, root)) == 1
    assert refresh.read_rows(spark, root, secret=b"k").count() == len(GOOD)


def test_lists_of_a_run_are_joined_by_many_tasks(spark, store, monkeypatch):
    """One task writes each list, but no join or aggregate runs in that task."""
    logs, root = store
    put(logs, name_of("kr", 20240112), GOOD[:2])
    plans, frame = [], type(spark.range(1))
    write = frame.write

    def watched(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write.fget(df)

    monkeypatch.setattr(frame, "write", property(watched))
    assert refresh.refresh(spark, root, str(logs), F.lit(True), b"k") == 1
    monkeypatch.undo()
    assert sum(p.startswith("Repartition 1, true") for p in plans) == 2
    assert not any("Repartition 1, false" in p for p in plans)
    for kind in ("parts", "manifest"):
        assert len(list(pathlib.Path(root, kind).glob("*.parquet"))) == 2
