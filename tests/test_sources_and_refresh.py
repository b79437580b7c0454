import bz2
import gzip
import lzma
import os
import pathlib
import time
from datetime import datetime

import pytest
import zstandard
from pyspark.sql import functions as F

from hitledger.functions.layout import ACCESS_LOG as P_LAYOUT
from hitledger.operators import counts
from hitledger.operators.parse import parse_lines, with_hll_hash
from hitledger.plans import exports, refresh
from hitledger.sources import textscan
from hitledger.sources.codecs import with_codec
from hitledger.sources.dimensions import ci_prefixes, legacy_csv, read_secret, registries
from hitledger.sources.listing import (
    default_selection,
    is_access_log,
    is_recent,
    list_files,
    undated_files,
)
from tests_lines import LINES

AS_OF = datetime(2024, 1, 20, 12)
PACK = {
    "gz": gzip.compress,
    "zst": zstandard.ZstdCompressor().compress,
    "bz2": bz2.compress,
    "xz": lzma.compress,
    "log": bytes,
}


def put(folder, name, lines, codec=None, newline="\n"):
    codec = codec or name.rsplit(".", 1)[-1]
    path = pathlib.Path(folder) / name
    path.write_bytes(PACK[codec]("".join(x + newline for x in lines).encode()))
    return path


def name_of(server, day, ext="gz"):
    return f"access_{server}.pkg.julialang.org.log-{day}.{ext}"


@pytest.fixture
def logs(tmp_path):
    folder = tmp_path / "logs"
    folder.mkdir()
    put(folder, name_of("kr", 20240110), LINES[:3])
    put(folder, name_of("us-east", 20240110, "zst"), LINES[3:6])
    put(folder, name_of("us-east", 20240111), LINES[6:])
    return folder


def selected(spark, folder):
    return default_selection(F.col("src_file"), AS_OF)


def test_name_predicates(spark):
    names = {
        "access_eu.pkg.julialang.org.log-20240110.gz": (True, True),
        "access_eu.pkg.julialang.org.log-20240110.zst.part": (True, True),
        "access_eu.pkg.julialang.org.log": (False, False),
        "error_eu.pkg.julialang.org.log-20240110.gz": (False, True),
        "access_eu.example.org.log-20240110.gz": (False, True),
        "access_eu.pkg.julialang.org.log-20240117.gz": (True, True),
        "access_eu.pkg.julialang.org.log-20231201.gz": (True, False),
        "access_eu.pkg.julialang.org.log-20991231.gz": (True, True),
        "access_eu.pkg.julialang.org.log-20241350.gz": (True, False),
        "access_eu.pkg.julialang.org.log-202401.gz": (True, False),
    }
    df = spark.createDataFrame([(n,) for n in names], "src_file string")
    name = F.col("src_file")
    got = df.select("src_file", is_access_log(name), is_recent(name, 33, AS_OF)).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == names
    undated = {r.src_file for r in undated_files(df).collect()}
    assert undated == {n for n in names if "1350" in n or "-202401." in n}


def test_recency_boundary_is_in_whole_days(spark):
    df = spark.createDataFrame([("x-20240110.gz",)], "n string")
    at = lambda d, h, days: df.select(is_recent(F.col("n"), days, datetime(2024, 1, d, h))).collect()[0][0]
    assert at(12, 23, 3) and not at(13, 0, 3)
    assert at(10, 0, 1) and not at(10, 0, 0)


def test_scan_of_a_directory(spark, logs):
    put(logs, "notes.log", ["no log"])
    put(logs, name_of("old", 20230101), LINES)
    lines = textscan.scan_directory(spark, str(logs), AS_OF)
    got = sorted((r.value, r.src_file) for r in lines.collect())
    assert [g[0] for g in got] == sorted(LINES)
    rows = parse_lines(lines, "value", ["src_file"], F.col("src_file"))
    assert {r.pkgserver for r in rows.select("pkgserver").collect()} == {"kr", "us-east"}
    for sub in ("older", "day=1"):
        (logs / sub).mkdir()
        put(logs / sub, name_of("sub", 20240109), LINES[:1])
    assert textscan.scan_directory(spark, str(logs), AS_OF).count() == len(LINES) + 2
    only = textscan.scan_directory(spark, str(logs), AS_OF, F.col("src_bytes") < 0)
    assert only is None


def test_line_ends(spark, tmp_path):
    put(tmp_path, "a.log", ["one", "two\rhalf"], newline="\r\n")
    got = textscan.text_lines(spark, str(tmp_path)).select("value").collect()
    assert [r.value for r in got] == ["one", "two\rhalf"]


def test_content_decides_the_codec(spark, tmp_path):
    put(tmp_path, "plain.log", LINES[:1])
    put(tmp_path, "zipped.log", LINES[1:2], "gz")
    put(tmp_path, "really-zstd.gz", LINES[2:3], "zst")
    put(tmp_path, "fine.bz2", LINES[3:4])
    put(tmp_path, "wrong.zst", LINES[4:5], "bz2")
    put(tmp_path, "bare.gz", LINES[5:6], "log")
    put(tmp_path, "hopeless.gz", LINES[6:7], "xz")
    (tmp_path / "empty.gz").write_bytes(b"")
    files = with_codec(list_files(spark, str(tmp_path)))
    codecs = {r.src_file: (r.codec, r.as_named) for r in files.collect()}
    assert codecs == {
        "plain.log": ("plain", True), "zipped.log": ("gzip", False), "really-zstd.gz": ("zstd", False),
        "fine.bz2": ("bzip2", True), "wrong.zst": ("bzip2", False), "bare.gz": ("plain", False),
        "hopeless.gz": ("xz", False), "empty.gz": ("plain", False),
    }
    lines = textscan.lines_of_files(spark, list_files(spark, str(tmp_path)))
    assert sorted(r.value for r in lines.collect()) == sorted(LINES[:6])
    assert [r.src_file for r in textscan.rejected_files(spark, str(tmp_path)).collect()] == ["hopeless.gz"]


def test_heavy_files_are_spread_and_complete(spark, logs, monkeypatch):
    monkeypatch.setattr(textscan, "HEAVY_BYTES", 1 << 16)
    big = put(logs, name_of("big", 20240110), [x for x in LINES if x.startswith("1")] * 2000, "log")
    big.write_bytes(gzip.compress(big.read_bytes(), compresslevel=0))
    lines = textscan.lines_of_files(spark, list_files(spark, str(logs)).where("src_file not like '%big%'"))
    light = lines.rdd.getNumPartitions()
    lines = textscan.lines_of_files(spark, list_files(spark, str(logs)))
    assert lines.rdd.getNumPartitions() >= light + 12
    assert lines.where("src_file like '%big%'").count() == 7 * 2000
    lines = lines.where("src_file not like '%big%'")
    assert sorted(r.value for r in lines.collect()) == sorted(LINES)


def test_refresh_cycle(spark, logs, tmp_path):
    root = str(tmp_path / "store")
    run = lambda secret=b"k": refresh.refresh(spark, root, str(logs), selected(spark, logs), secret)
    good = [x for x in LINES if x.startswith("1")]
    assert run() == 3
    rows = refresh.read_rows(spark, root)
    assert rows.count() == len(good)
    assert refresh.read_rejects(spark, root).count() == len(LINES) - len(good)
    assert rows.where("hll_hash is null").count() == 0
    want = with_hll_hash(
        parse_lines(textscan.scan_directory(spark, str(logs), AS_OF), "value", ["src_file"], F.col("src_file")), b"k"
    )
    columns = want.columns
    assert sorted(map(str, rows.select(columns).collect())) == sorted(map(str, want.select(columns).collect()))

    assert run() == 0
    # one file rewritten: exactly that file is parsed again, its old rows are gone
    path = put(logs, name_of("kr", 20240110), good[:1])
    later = time.time() + 5
    os.utime(path, (later, later))
    assert run() == 1
    kr = refresh.read_rows(spark, root).where("pkgserver = 'kr'")
    assert kr.count() == 1
    # rewritten to nothing that parses
    path = put(logs, name_of("kr", 20240110), ["garbage"])
    os.utime(path, (later + 5, later + 5))
    assert run() == 1
    assert refresh.read_rows(spark, root).where("pkgserver = 'kr'").count() == 0
    assert refresh.read_rejects(spark, root).where("line = 'garbage'").count() == 1
    # reading can be limited to the files present now
    listed = list_files(spark, str(logs)).where("src_file like '%us-east%'")
    assert refresh.read_rejects(spark, root, files=listed).where("line = 'garbage'").count() == 0
    assert refresh.read_rows(spark, root, files=listed).count() == len(good) - 2
    # another key concerns every file
    assert run(b"other") == 3
    assert run(b"other") == 0


def test_same_name_in_two_folders(spark, tmp_path):
    for sub in "ab":
        (tmp_path / sub).mkdir()
        put(tmp_path / sub, name_of("kr", 20240110), [x for x in LINES if x.startswith("1")][:2])
    root = str(tmp_path / "store")
    files = list_files(spark, str(tmp_path / "a"), str(tmp_path / "b"))
    assert refresh.refresh_files(spark, root, files) == 2
    assert refresh.read_rows(spark, root).count() == 4


def test_failed_run_leaves_nothing_visible(spark, logs, tmp_path):
    root = str(tmp_path / "store")

    def broken(rows):
        return rows.withColumn("status", F.raise_error(F.lit("boom")).cast("bigint"))

    with pytest.raises(Exception, match="boom"):
        refresh.refresh(spark, root, str(logs), selected(spark, logs), transform=broken)
    assert refresh.manifest(spark, root).count() == 0
    assert refresh.refresh(spark, root, str(logs), selected(spark, logs)) == 3


def test_transform_is_applied(spark, logs, tmp_path):
    root = str(tmp_path / "store")
    refresh.refresh(spark, root, str(logs), selected(spark, logs), transform=lambda r: r.withColumn("request_id", F.lit("x")))
    assert {r.request_id for r in refresh.read_rows(spark, root).collect()} == {"x"}


def test_damaged_file_is_parsed_again(spark, logs, tmp_path):
    root = str(tmp_path / "store")
    refresh.refresh(spark, root, str(logs), selected(spark, logs))
    before = refresh.read_rows(spark, root).count()
    assert refresh.drop_damaged(spark, root).count() == 0
    [victim] = pathlib.Path(root, "table").glob("run_id=*/record=row/log_date=2024-01-11/*.parquet")
    victim.write_bytes(b"not parquet at all")
    for crc in victim.parent.glob(".*.crc"):
        crc.write_bytes(b"")
    spark.catalog.clearCache()
    assert refresh.drop_damaged(spark, root).count() == 1
    assert refresh.refresh(spark, root, str(logs), selected(spark, logs)) == 1
    assert refresh.read_rows(spark, root).count() == before


def test_damage_in_any_column_is_found(spark, logs, tmp_path):
    root = str(tmp_path / "store")
    refresh.refresh(spark, root, str(logs), selected(spark, logs))
    before = refresh.read_rows(spark, root).count()
    import pyarrow.parquet as pq

    [victim] = pathlib.Path(root, "table").glob("run_id=*/record=row/log_date=2024-01-11/*.parquet")
    group = pq.ParquetFile(victim).metadata.row_group(0)
    [column] = [group.column(i) for i in range(group.num_columns) if group.column(i).path_in_schema == "request"]
    data = bytearray(victim.read_bytes())
    start = column.dictionary_page_offset or column.data_page_offset
    data[start : start + column.total_compressed_size] = b"\xff" * column.total_compressed_size
    victim.write_bytes(bytes(data))
    for crc in victim.parent.glob(".*.crc"):
        crc.write_bytes(b"")
        crc.unlink()
    assert refresh.drop_damaged(spark, root).count() == 1
    assert refresh.refresh(spark, root, str(logs), selected(spark, logs)) == 1
    assert refresh.read_rows(spark, root).count() == before


def misnamed(tmp_path):
    folder = tmp_path / "odd"
    folder.mkdir()
    put(folder, name_of("a", 20240110), LINES[:2], "log")
    put(folder, name_of("b", 20240110, "zst"), LINES[2:4], "gz")
    put(folder, "access_c.pkg.julialang.org.log-20240110.gz.log", LINES[4:6], "gz")
    put(folder, name_of("d", 20240110), LINES[6:], "gz")
    return folder


def test_refresh_honours_content(spark, tmp_path):
    from hitledger.plans import jobs

    folder = misnamed(tmp_path)
    put(folder, name_of("x", 20240110), LINES[:2], "xz")
    want = sorted(r.value for r in textscan.scan_directory(spark, str(folder), AS_OF).collect())
    assert want == sorted(LINES)
    files = [str(p) for p in sorted(folder.iterdir())]
    for k, run in enumerate((
        lambda store: jobs.parse_directory(spark, str(folder), store, AS_OF),
        lambda store: jobs.parse_files(spark, files, store),
    )):
        store = str(tmp_path / f"store{k}")
        assert run(store) == 4
        good = [x for x in LINES if x.startswith("1")]
        assert refresh.read_rows(spark, store).count() == len(good)
        assert refresh.read_rejects(spark, store).count() == len(LINES) - len(good)
        [odd] = refresh.unreadable_files(spark, store).collect()
        assert odd.src_path.endswith(name_of("x", 20240110))
        assert run(store) == 0


def test_a_truncated_file_does_not_stop_the_others(spark, logs, tmp_path):
    broken = put(logs, name_of("bad", 20240112), LINES * 50)
    broken.write_bytes(broken.read_bytes()[:-20])
    root = str(tmp_path / "store")
    assert refresh.refresh(spark, root, str(logs), selected(spark, logs)) == 3
    assert [r.src_path.rsplit("/", 1)[1] for r in refresh.unreadable_files(spark, root).collect()] == [broken.name]
    assert refresh.read_rows(spark, root).where("src_file like '%bad%'").count() == 0
    mended = put(logs, broken.name, LINES)
    os.utime(mended, (time.time() + 9, time.time() + 9))
    assert refresh.refresh(spark, root, str(logs), selected(spark, logs)) == 1
    assert refresh.unreadable_files(spark, root).count() == 0


def test_a_death_before_the_manifest_keeps_the_old_rows(spark, logs, tmp_path, monkeypatch):
    root = str(tmp_path / "store")
    run = lambda: refresh.refresh(spark, root, str(logs), selected(spark, logs))
    run()
    before = refresh.read_rows(spark, root).count()
    path = put(logs, name_of("kr", 20240110), [x for x in LINES if x.startswith("1")][:1])
    os.utime(path, (time.time() + 9, time.time() + 9))

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(refresh, "record_run", dies)
        with pytest.raises(RuntimeError, match="lost"):
            run()
    assert refresh.read_rows(spark, root).count() == before
    assert run() == 1
    assert refresh.read_rows(spark, root).where("pkgserver = 'kr'").count() == 1
    # the first run still holds the two other files
    assert refresh.remove_superseded(spark, root) == []
    for name in (name_of("us-east", 20240110, "zst"), name_of("us-east", 20240111)):
        os.utime(logs / name, (time.time() + 9, time.time() + 9))
    assert run() == 2
    after = refresh.read_rows(spark, root).count()
    assert len(refresh.remove_superseded(spark, root)) == 1
    assert refresh.read_rows(spark, root).count() == after


def test_counting_reads_the_new_run_alone(spark, logs, tmp_path, monkeypatch):
    root, read = str(tmp_path / "store"), []
    plain = refresh.read_if_present
    monkeypatch.setattr(refresh, "read_if_present", lambda s, path, *a, **k: read.append(path) or plain(s, path, *a, **k))
    refresh.refresh(spark, root, str(logs), selected(spark, logs))
    assert all("/table/run_id=" in p for p in read if "/table" in p) and any("/table" in p for p in read)


def test_parse_report(spark, logs, tmp_path):
    from hitledger.plans import jobs

    put(logs, name_of("kr", 20241399), LINES[:1])
    store = str(tmp_path / "store")
    jobs.parse_directory(spark, str(logs), store, AS_OF)
    report = jobs.parse_report(spark, store, str(logs))
    assert [r.src_path.rsplit("/", 1)[1] for r in report.undated.collect()] == [name_of("kr", 20241399)]
    assert sum(r.n for r in report.rejects.collect()) == refresh.read_rejects(spark, store).count()
    assert jobs.tidy(spark, store) == (0, 0)


def test_empty_directory(spark, tmp_path):
    (tmp_path / "logs").mkdir()
    assert refresh.refresh(spark, str(tmp_path / "s"), str(tmp_path / "logs"), F.lit(True)) == 0


def test_reports_and_sanitized_export(spark, logs, tmp_path):
    root = str(tmp_path / "store")
    refresh.refresh(spark, root, str(logs), selected(spark, logs))
    rows = refresh.read_rows(spark, root)
    (tmp_path / "names.csv").write_text(
        "package_uuid,name,registry,priority\n"
        "00000000-0000-0000-0000-000000000001,Second,Private,2\n"
        "00000000-0000-0000-0000-000000000001,First,General,1\n"
    )
    daily = counts.DailyHits.of(counts.daily_hits(rows))
    assert [d.isoformat() for d in daily.days] == ["2024-01-09", "2024-01-10"]
    out = exports.write_package_report(daily, registries(spark, str(tmp_path / "names.csv")), str(tmp_path), AS_OF)
    assert out.endswith("package_downloads_by_day_1-20.csv")
    got = spark.read.option("header", True).csv(out).collect()
    assert [tuple(r) for r in got] == [
        ("00000000-0000-0000-0000-000000000001", "First", "2", "1", "1"),
        ("00000000-0000-0000-0000-000000000002", None, "1", "0", "1"),
    ]
    assert got[0].asDict().keys() == {"uuid", "name", "total_downloads", "01/09", "01/10"}
    art = spark.read.option("header", True).csv(exports.write_artifact_report(daily, str(tmp_path), AS_OF))
    assert art.columns == ["hash", "total_downloads", "01/09", "01/10"] and art.count() == 1

    for fmt in ("parquet", "csv"):
        target = str(tmp_path / f"clean-{fmt}")
        exports.write_sanitized(rows, target, fmt)
        again = spark.read.option("header", True).format(fmt).load(target)
        assert "remote_addr" not in again.columns and again.count() == rows.count()
        assert {r.src_file for r in again.select("src_file").collect()} == {
            r.src_file for r in rows.select("src_file").collect()
        }
        assert again.columns == [f.name for f in P_LAYOUT.schema if f.name != "remote_addr"] + ["src_file"]
    typed = legacy_csv(spark, str(tmp_path / "clean-csv"), without=("remote_addr",))
    assert typed.count() == rows.count() and typed.where("status is not null").count() > 0


def test_legacy_csv_keeps_types_and_leading_zeros(spark, tmp_path):
    names = [f.name for f in P_LAYOUT.schema]
    values = dict.fromkeys(names, "") | {
        "remote_addr": "1.2.3.4", "time_utc": "2020-11-06T20:00:14", "status": "200", "request_time": "0.027",
        "julia_interactive": "true", "hll_hash": "030201",
    }
    text = ",".join(names) + "\n" + ",".join(values[n] for n in names) + "\n"
    for ext in ("csv", "csv.gz", "csv.zst"):
        codec = ext.rsplit(".", 1)[-1]
        data = text.encode() if codec == "csv" else PACK[codec](text.encode())
        (tmp_path / f"x.{ext}").write_bytes(data)
        [row] = legacy_csv(spark, str(tmp_path / f"x.{ext}")).collect()
        assert row.hll_hash == "030201" and row.time_utc == datetime(2020, 11, 6, 20, 0, 14)
        assert row.status == 200 and row.julia_interactive is True and row.request_time == 0.027
        assert row.package is None


def test_small_inputs(spark, tmp_path):
    (tmp_path / "key").write_bytes(b"\x00k\n")
    assert read_secret(spark, str(tmp_path / "key")) == b"\x00k\n"
    (tmp_path / "ci.csv").write_text("provider,cidr\nalpha,10.0.0.0/8\n")
    assert ci_prefixes(spark, str(tmp_path / "ci.csv")).collect()[0].cidr == "10.0.0.0/8"


def test_mirror_cache(spark, tmp_path):
    logs, cache = tmp_path / "mirror", str(tmp_path / "cache")
    logs.mkdir()
    hit = '1.2.3.4 - - [x] "GET /julia/package/a HTTP/1.1" 200 1000 "-"'
    put(logs, "mirrors.log-20240119.gz", [hit, hit.replace("200", "404"), hit.replace("/julia/", "/other/")])
    put(logs, "mirrors.log-20240118.gz", [hit.replace("1000", "9" * 30), hit])
    put(logs, "mirrors.log-20240120.gz", [hit])  # today: not complete yet
    put(logs, "mirrors.log-20231220.gz", [hit])  # 31 days back
    put(logs, "mirrors.log-20231221.gz", [hit])  # 30 days back
    from hitledger.operators import mirror
    from hitledger.plans.jobs import mirror_traffic

    put(logs, "mirrors.log-20240117.gz", ["nothing of ours"])
    assert exports.cache_mirror_lines(spark, str(logs), cache, AS_OF) == 4
    per_day, total = mirror_traffic(spark, str(logs), cache, AS_OF)
    assert {r.day.isoformat(): int(r.bytes) for r in per_day.collect()} == {
        "2024-01-19": 1000, "2024-01-18": 1000, "2024-01-17": 0, "2023-12-21": 1000,
    }
    [total] = total.collect()
    assert (int(total.bytes), total.human) == (3000, "2.9 KB")
    n = exports.mirror_cache(spark, cache).count()
    assert n == 5
    assert exports.cache_mirror_lines(spark, str(logs), cache, AS_OF) == 0
    later, _ = mirror_traffic(spark, str(logs), cache, AS_OF.replace(day=21))
    assert {r.day.isoformat() for r in later.collect()} == {f"2024-01-{d}" for d in (17, 18, 19, 20)}
    earlier, _ = mirror_traffic(spark, str(logs), cache, AS_OF.replace(day=10))
    assert {r.day.isoformat() for r in earlier.collect()} == {"2023-12-20", "2023-12-21"}
    assert exports.mirror_cache(spark, cache).count() == n + 2
    empty = str(tmp_path / "none")
    assert mirror.total_bytes(exports.mirror_bytes(spark, empty)).collect()[0].human == "0.0 B"
    whole = textscan.mirror_scan(spark, str(logs), AS_OF)
    assert mirror.bytes_by_day(whole.withColumn("line", F.lit("nothing"))).where("bytes = 0").count() == 4


def test_whole_jobs(spark, logs, tmp_path):
    from hitledger.plans import jobs

    store, key = str(tmp_path / "store"), tmp_path / "key"
    key.write_bytes(b"k")
    assert jobs.parse_directory(spark, str(logs), store, AS_OF, str(key)) == 3
    files = [str(p) for p in sorted(logs.iterdir())]
    assert jobs.parse_files(spark, files, store, str(key)) == 0
    assert jobs.parse_files(spark, files[:1], str(tmp_path / "other")) == 1

    prefixes = spark.sql("select 'ci' as provider, '192.168.0.0/16' as cidr")
    registry = spark.sql("select '00000000-0000-0000-0000-000000000001' as package_uuid, 'One' as name, 'R' as registry, 1 as priority")
    rows = refresh.read_recent(spark, store, AS_OF)
    reports = jobs.download_reports(rows, prefixes, registry, str(tmp_path), AS_OF)
    assert {(r.kind, r.is_ci): r.n for r in reports.totals.collect()} == {
        ("package", False): 4, ("package", True): 1, ("artifact", False): 1, ("artifact", True): 0,
    }
    assert {(r.name, r.day.day, r.n) for r in reports.top_packages(registry).collect()} == {("One", 9, 1), ("One", 10, 1)}
    assert refresh.read_recent(spark, store, AS_OF, 10).select("src_file").distinct().count() == 1
    plan = refresh.read_recent(spark, store, AS_OF, 10)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(record" in plan and "log_date" in plan.split("PartitionFilters")[1][:200]

    jobs.anonymize_file(spark, files[0], str(tmp_path / "anon"), "k")
    assert spark.read.text(str(tmp_path / "anon")).count() == 2
    [look] = jobs.quick_look(spark, str(logs)).collect()
    assert tuple(look) == (7, 3, 2)


def test_recent_rows_follow_the_file_predicate(spark, logs, tmp_path):
    from datetime import timedelta

    store = str(tmp_path / "store")
    refresh.refresh(spark, store, str(logs), F.lit(True))
    rows = refresh.read_rows(spark, store)
    for days in (1, 9, 10, 11):
        for hours in (0, 12, 24):
            as_of = AS_OF.replace(hour=0) + timedelta(hours=hours)
            want = rows.where(is_recent(F.col("src_file"), days, as_of)).count()
            assert refresh.read_recent(spark, store, as_of, days).count() == want


def test_cut_off_files_are_found_before_anything_is_parsed(spark, logs, tmp_path, monkeypatch):
    broken = put(logs, name_of("bad", 20240112), LINES * 50)
    broken.write_bytes(broken.read_bytes()[:-20])
    root, runs, store_lines = str(tmp_path / "store"), [], refresh.store_lines
    monkeypatch.setattr(refresh, "store_lines", lambda *given: runs.append(given) or store_lines(*given))
    assert refresh.refresh(spark, root, str(logs), selected(spark, logs)) == 3
    assert len(runs) == 1
    assert [r.src_path.rsplit("/", 1)[1] for r in refresh.unreadable_files(spark, root).collect()] == [broken.name]
