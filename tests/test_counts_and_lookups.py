import ipaddress
import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from hitledger import joins
from hitledger.functions.values import human_bytes
from hitledger.operators import counts, enrich


def rows(spark, data):
    schema = "request_url string, package_uuid string, artifact_hash string, time_utc timestamp_ntz, is_ci boolean"
    return spark.createDataFrame(data, schema)


def hit(uuid, day, kind="package", ci=False, month=1, year=2024):
    url = f"/{kind}/{uuid}"
    key = (uuid, None) if kind == "package" else (None, uuid)
    return (url, *key, datetime(year, month, day, 10) if day else None, ci)


@pytest.mark.parametrize("size,text", [
    (0, "0.0 B"), (999, "999.0 B"), (1000, "1.0 KB"), (1024, "1.0 KB"), (1536, "1.5 KB"), (1280, "1.2 KB"),
    (1792, "1.8 KB"), (999 * 1024, "999.0 KB"), (999 * 1024 + 1, "1.0 MB"), (37132763, "35.4 MB"),
    (5 * 1024**6, "5.0 EB"), (2**63 - 1, "8.0 EB"),
])
def test_human_bytes(spark, size, text):
    assert spark.range(1).select(human_bytes(F.lit(size))).collect()[0][0] == text


def test_human_bytes_of_larger_units(spark):
    df = spark.sql("select cast(1024 as decimal(38,0)) as k")
    for steps, unit in ((7, "ZB"), (8, "YB")):
        value = F.lit(str(3 * 1024**steps)).cast("decimal(38,0)")
        assert df.select(human_bytes(value)).collect()[0][0] == f"3.0 {unit}"


def test_day_trim(spark):
    data = [hit("a", 1), hit("a", 2), hit("b", 2), hit("a", 3), hit("b", 5), hit("x", 4, "artifact"), hit("x", 2, "artifact")]
    hits = counts.daily_hits(rows(spark, data))
    daily = counts.DailyHits.of(hits)
    assert daily.days == sorted(r.day for r in counts.plotted_days(hits).collect())
    # day 4 has artifact hits only, so it is not plotted
    assert daily.days == [date(2024, 1, 2), date(2024, 1, 3)]
    assert sorted(daily.trimmed("artifact").collect()) == [("x", date(2024, 1, 2), 1)]
    assert sorted(map(tuple, daily.by_day("package", "uuid").collect())) == [
        ("a", date(2024, 1, 2), 1), ("a", date(2024, 1, 3), 1), ("b", date(2024, 1, 2), 1), ("b", date(2024, 1, 3), 0),
    ]


def test_fewer_than_three_days_leave_nothing(spark):
    daily = counts.DailyHits.of(counts.daily_hits(rows(spark, [hit("a", 1), hit("a", 2)])))
    assert daily.days == []
    assert daily.trimmed("package").count() == 0
    assert daily.by_day("package", "uuid").count() == 0
    assert daily.wide("package", "uuid").columns == ["uuid", "total_downloads"]
    assert daily.top_series().count() == 0


def test_labels_and_dates_differ_only_over_new_year(spark):
    data = [hit("a", d, month=12, year=2023) for d in (30, 31)] + [hit("a", d) for d in (1, 2)]
    daily = counts.daily_hits(rows(spark, data))
    assert sorted(r.day for r in counts.plotted_days(daily).collect()) == [date(2023, 12, 31), date(2024, 1, 1)]
    assert sorted(r.label for r in counts.plotted_day_labels(daily).collect()) == ["01/02", "12/30"]


def test_top_series_keeps_the_missing_key_and_orders_ties(spark):
    data = [hit("a", d) for d in (1, 2, 3, 4)] + [hit("b", 2), hit("b", 3), hit("c", 2)]
    data += [("/package/bad", None, None, datetime(2024, 1, 2, 1), False)] * 3
    daily = counts.DailyHits.of(counts.daily_hits(rows(spark, data)))
    series = daily.top_series(k=2)
    assert sorted((str(r.key), r.day.day, r.n) for r in series.collect()) == [
        ("None", 2, 3), ("None", 3, 0), ("a", 2, 1), ("a", 3, 1),
    ]
    assert {r.key for r in daily.top_series(k=2, keep_missing=False).collect()} == {"a", "b"}
    assert {r.key for r in daily.top_series(k=10).collect()} == {"a", "b", "c", None}


def test_wide_report(spark):
    data = [hit("a", d) for d in (1, 2, 3, 4)] + [hit("a", 2), hit("b", 3)]
    data += [("/package/bad", None, None, datetime(2024, 1, 2, 1), False)]
    daily = counts.DailyHits.of(counts.daily_hits(rows(spark, data)))
    report = counts.ranked(daily.wide("package", "uuid"), "uuid", "total_downloads")
    assert report.columns == ["uuid", "total_downloads", "01/02", "01/03"]
    assert [tuple(r) for r in report.collect()] == [("a", 3, 2, 1), ("b", 1, 0, 1)]


def test_rows_without_time_count_in_totals_only(spark):
    df = rows(spark, [hit("a", None), hit("a", 1)])
    assert counts.daily_hits(df).agg(F.sum("n")).collect()[0][0] == 1
    assert counts.hits_by_package(df).collect()[0].n == 2


def test_split_totals_lists_all_four(spark):
    df = rows(spark, [hit("a", 1), hit("a", 1, ci=True), hit("b", None), hit("a", 2)])
    for hits in (counts.single_requests(df), counts.hits_by_key_and_day(df, "is_ci")):
        assert sorted(map(tuple, counts.split_totals(hits).collect())) == [
            ("artifact", False, 0), ("artifact", True, 0), ("package", False, 3), ("package", True, 1),
        ]
    assert counts.split_totals(counts.single_requests(rows(spark, []))).count() == 4


def test_group_by_any_key_function(spark):
    df = rows(spark, [hit("a", 1), hit("bb", 1), hit("cc", 2)])
    got = counts.count_by(df, size=F.length("package_uuid"), odd=F.day("time_utc") % 2 == 1).collect()
    assert sorted(map(tuple, got)) == [(1, True, 1), (2, False, 1), (2, True, 1)]

    @F.pandas_udf("string")
    def last(s):
        return s.str[-1]

    assert {(r.k, r.n) for r in counts.count_by(df, k=last("package_uuid")).collect()} == {("a", 1), ("b", 1), ("c", 1)}


# --- prefixes -------------------------------------------------------------------------


def longest_match(prefixes, text):
    try:
        address = ipaddress.ip_address(text)
    except ValueError:
        return "<unknown>"
    owners = [(-net.prefixlen, name) for name, net in prefixes if net.version == address.version and address in net]
    return min(owners)[1] if owners else "<unknown>"


@pytest.mark.parametrize("most_rows,hot", [(enrich.BROADCAST_ROWS, 0), (0, 0), (0, 30), (0, 10_000)])
def test_longest_prefix_against_brute_force(spark, monkeypatch, most_rows, hot):
    monkeypatch.setattr(joins, "HOT_SHARE", hot)
    rng = random.Random(11)
    prefixes = [("all4", "0.0.0.0/0"), ("dup2", "10.1.0.0/16"), ("dup1", "10.1.0.0/16"), ("one", "10.1.2.3/32"), ("self6", "::1/128")]
    if most_rows == 0:
        prefixes = prefixes[1:] + [("wide6", "2000::/3")]
    for i in range(60):
        base = ipaddress.IPv4Address((10 << 24) | rng.getrandbits(12) << 12)
        prefixes.append((f"v4-{i}", str(ipaddress.ip_network(f"{base}/{rng.randint(9, 28)}", strict=False))))
        base6 = ipaddress.IPv6Address((0x2001 << 112) | rng.getrandbits(10) << 96)
        prefixes.append((f"v6-{i}", str(ipaddress.ip_network(f"{base6}/{rng.randint(17, 45)}", strict=False))))
    nets = [(n, ipaddress.ip_network(c)) for n, c in prefixes]
    ips = [str(ipaddress.IPv4Address((10 << 24) | rng.getrandbits(24))) for _ in range(400)]
    ips += [str(ipaddress.IPv6Address((0x2001 << 112) | rng.getrandbits(112))) for _ in range(400)]
    ips += ["10.1.2.3", "10.1.2.4", "192.168.0.1", "::1", "::2", "bogus", "10.1.2.3"]
    ips += ["10.1.2.3"] * 50 + ["bogus"] * 20 + ["2001:1::1"] * 30
    df = spark.createDataFrame([(i, ip) for i, ip in enumerate(ips)] + [(-1, None)], "id int, remote_addr string")
    dim = spark.createDataFrame([*prefixes, ("junk", "nonsense"), ("junk", "1.2.3.4/99"), ("junk", None)], "provider string, cidr string")
    table = enrich.PrefixTable.build(dim, most_rows)
    assert (table.small is None) == (most_rows == 0)
    found = enrich.with_provider(df, table)
    assert found.columns == ["id", "remote_addr", "provider"]
    got = {r.id: r.provider for r in found.collect()}
    want = {i: longest_match(nets, ip) for i, ip in enumerate(ips)} | {-1: "<unknown>"}
    assert got == want


def test_empty_prefix_table(spark):
    df = spark.createDataFrame([("1.2.3.4",)], "remote_addr string")
    table = enrich.PrefixTable.build(spark.createDataFrame([], "provider string, cidr string"))
    assert enrich.with_provider(df, table).collect()[0].provider == "<unknown>"


def test_small_tables_join_without_a_shuffle(spark):
    df = spark.range(10).select(F.concat(F.lit("10.0.0."), "id").alias("remote_addr"))
    table = enrich.PrefixTable.build(spark.sql("select 'a' as provider, '10.0.0.0/30' as cidr"))
    plan = enrich.with_provider(df, table)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "NestedLoop" not in plan


def test_long_prefixes_stay_on_the_broadcast_plan(spark):
    odd = spark.range(25_000).select(
        F.concat(F.lit("n"), "id").alias("provider"),
        F.concat_ws(".", F.lit("10"), (F.col("id") / 256).cast("int") % 256, F.col("id") % 2 * 128, F.lit("0/17")).alias("cidr"),
    )
    odd6 = spark.range(25_000).select(
        F.concat(F.lit("s"), "id").alias("provider"), F.concat(F.lit("2001:"), F.hex("id"), F.lit(":8000::/33")).alias("cidr")
    )
    table = enrich.PrefixTable.build(odd.union(odd6))
    assert table.small is not None and set(table.small) == {5, 9}
    df = spark.createDataFrame([("2001:a:ffff::1",), ("2001:a:7fff::1",)], "remote_addr string")
    assert [r.provider for r in enrich.with_provider(df, table).collect()] == ["s10", "<unknown>"]


def test_large_tables_read_the_rows_once_more(spark):
    df = spark.range(10).select(F.concat(F.lit("10.0.0."), "id").alias("remote_addr"))
    table = enrich.PrefixTable.build(spark.sql("select 'a' as provider, '10.0.0.0/30' as cidr"), 0)
    found = enrich.with_provider(df, table)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (0, 10") == 1
    assert sorted(r.provider for r in found.collect()) == ["<unknown>"] * 6 + ["a"] * 4


def test_first_registry_names(spark):
    registry = spark.createDataFrame(
        [("u1", "late", "R2", 2), ("u1", "early", "R1", 1), ("u2", "tie-b", "B", 1), ("u2", "tie-a", "A", 1)],
        "package_uuid string, name string, registry string, priority int",
    )
    seen = spark.createDataFrame([("u1", 1), ("u2", 2), ("u3", 3), (None, 4)], "package_uuid string, n int")
    got = {r.package_uuid: r.name for r in enrich.with_package_name(seen, registry).collect()}
    assert got == {"u1": "early", "u2": "tie-a", "u3": None, None: None}


def test_ci_variables(spark):
    texts = ["CI=t;X=n", "CI=n;CI=t", "CI=n;X=n", "FLAG", "A=b=c", None]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = df.select("v", enrich.ci_variables(F.col("v")).alias("m"), enrich.is_ci_environment(F.col("v")).alias("ci")).collect()
    assert {r.v: (r.m, r.ci) for r in got} == {
        "CI=t;X=n": ({"CI": "t", "X": "n"}, True), "CI=n;CI=t": ({"CI": "t"}, True), "CI=n;X=n": ({"CI": "n", "X": "n"}, False),
        "FLAG": ({"FLAG": None}, None), "A=b=c": ({"A": "b=c"}, True), None: (None, None),
    }
