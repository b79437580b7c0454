"""Reports from per-run summaries equal recounts, and read new runs alone."""

import os
import time

import pytest
from pyspark.sql import functions as F

from hitledger.operators import counts, enrich, registers
from hitledger.plans import jobs, refresh, summaries
from test_healing import GOOD, damage, parts
from test_sources_and_refresh import AS_OF, name_of, put


@pytest.fixture
def prefixes(spark):
    return spark.sql("select 'ci' as provider, '192.168.0.0/16' as cidr")


def recount(spark, root, prefixes):
    rows = enrich.with_ci_flag(refresh.current_rows(spark, root), enrich.PrefixTable.build(prefixes))
    return sorted(map(str, counts.hits_by_key_and_day(rows, "is_ci").collect()))


def recounted_clients(spark, root):
    rows = refresh.current_rows(spark, root).withColumn("day", F.to_date("time_utc"))
    return sorted(map(str, registers.registers(rows, ["day"]).collect()))


def summed(spark, root, prefixes):
    return sorted(map(str, summaries.current_hits(spark, root, prefixes).collect()))


def summed_clients(spark, root, prefixes):
    return sorted(map(str, summaries.current_registers(spark, root, prefixes).collect()))


def test_summaries_follow_the_store(spark, tmp_path, prefixes, monkeypatch):
    logs, root = tmp_path / "logs", str(tmp_path / "store")
    logs.mkdir()
    names = [name_of("kr", 20240110), name_of("us-east", 20240110), name_of("kr", 20240111)]
    for name, chosen in zip(names, (GOOD[:3], GOOD[2:5], [*GOOD[4:], "garbage"])):
        put(logs, name, chosen)
    run = lambda: refresh.refresh(spark, root, str(logs), F.lit(True), b"k")
    read = []
    plain = summaries.rows_of_runs
    monkeypatch.setattr(summaries, "rows_of_runs", lambda *a: read.append(found := plain(*a)) or found)

    assert run() == 3 and summaries.update(spark, root, prefixes, b"k") == 1
    assert summed(spark, root, prefixes) == recount(spark, root, prefixes) != []
    assert summed_clients(spark, root, prefixes) == recounted_clients(spark, root) != []
    assert summaries.update(spark, root, prefixes, b"k") == 0

    # one file rewritten: its old counts go, its new ones come, nothing else is read
    path = put(logs, names[0], GOOD[:1])
    os.utime(path, (time.time() + 5, time.time() + 5))
    assert run() == 1 and summaries.update(spark, root, prefixes, b"k") == 1
    assert summed(spark, root, prefixes) == recount(spark, root, prefixes)
    assert summed_clients(spark, root, prefixes) == recounted_clients(spark, root)
    assert {r.src_file for r in read[-1].select("src_file").collect()} == {names[0]}
    plan = read[-1]._jdf.queryExecution().executedPlan().toString()
    assert "run_id" in plan.split("PartitionFilters")[1][:300]

    # rewritten to nothing that parses
    path = put(logs, names[0], ["garbage"])
    os.utime(path, (time.time() + 9, time.time() + 9))
    assert run() == 1 and summaries.update(spark, root, prefixes, b"k") == 0
    assert summed(spark, root, prefixes) == recount(spark, root, prefixes)

    # a damaged part of a run that is not summarised yet is healed, then counted once
    put(logs, name_of("kr", 20240112), GOOD[:4])
    assert run() == 1
    damage(parts(root, "2024-01-12")[0], "cut")
    assert summaries.update(spark, root, prefixes, b"k") == 1
    assert summed(spark, root, prefixes) == recount(spark, root, prefixes)

    # other prefixes have summaries of their own
    others = spark.sql("select 'ci' as provider, '10.0.0.0/8' as cidr")
    assert summaries.update(spark, root, others, b"k") >= 2
    assert summed(spark, root, others) == recount(spark, root, others)
    assert summaries.prefix_print(prefixes) != summaries.prefix_print(others)


def test_a_death_before_the_end_counts_once(spark, tmp_path, prefixes, monkeypatch):
    logs, root = tmp_path / "logs", str(tmp_path / "store")
    logs.mkdir()
    put(logs, name_of("kr", 20240110), GOOD)
    refresh.refresh(spark, root, str(logs), F.lit(True))
    plain = summaries._write

    def dies(summary, path):
        plain(summary, path)
        if path.endswith("registers"):
            raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(summaries, "_write", dies)
        with pytest.raises(RuntimeError, match="lost"):
            summaries.update(spark, root, prefixes)
    assert summaries.update(spark, root, prefixes) == 1
    assert summed(spark, root, prefixes) == recount(spark, root, prefixes)


def test_stored_reports_equal_those_of_the_rows(spark, tmp_path, prefixes):
    logs, root = tmp_path / "logs", str(tmp_path / "store")
    logs.mkdir()
    put(logs, name_of("kr", 20240110), GOOD)
    put(logs, name_of("kr", 20231110), GOOD)
    refresh.refresh(spark, root, str(logs), F.lit(True))
    registry = spark.sql("select '00000000-0000-0000-0000-000000000001' as package_uuid, 'One' as name, 'R' as registry, 1 as priority")
    mine = jobs.stored_reports(spark, root, prefixes, registry, str(tmp_path / "a"), AS_OF)
    rows = refresh.read_recent(spark, root, AS_OF)
    want = jobs.download_reports(rows, prefixes, registry, str(tmp_path / "b"), AS_OF)
    assert sorted(mine.totals.collect()) == sorted(want.totals.collect())
    for a, b in ((mine.package_csv, want.package_csv), (mine.artifact_csv, want.artifact_csv)):
        assert spark.read.text(a).collect() == spark.read.text(b).collect()
    days = {r.day: r.clients for r in jobs.stored_clients(spark, root, prefixes).collect()}
    everything = refresh.read_rows(spark, root).withColumn("day", F.to_date("time_utc"))
    assert days == {r.day: r.clients for r in registers.estimate_clients(everything, ["day"]).collect()}


def test_an_empty_store(spark, tmp_path, prefixes):
    root = str(tmp_path / "none")
    assert summaries.update(spark, root, prefixes) == 0
    assert summaries.current_hits(spark, root, prefixes).count() == 0
    assert summaries.current_registers(spark, root, prefixes).count() == 0
