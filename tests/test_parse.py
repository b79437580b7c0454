from datetime import datetime

import pytest
from pyspark.sql import functions as F

from hitledger.functions.layout import ACCESS_LOG, Field, Layout
from hitledger.operators.parse import (
    parse_lines,
    parse_or_reject,
    reject_examples,
    rejected_lines,
    with_hll_hash,
)
from tests_lines import LINES

CI = (
    "APPVEYOR=n;CI=n;CI_SERVER=n;CIRCLECI=n;CONTINUOUS_INTEGRATION=n;GITHUB_ACTIONS=n;GITLAB_CI=n;"
    "JULIA_CI=n;JULIA_PKGEVAL=n;JULIA_REGISTRYCI_AUTOMERGE=n;TF_BUILD=n;TRAVIS=n"
)
UUID, TREE = "d8e11817-5142-5d16-987a-aa16d5891078", "b51f894272d996c9857577f3e8d3a8d69df22caa"
REG, REG_HASH = "23338594-aafe-5451-b93e-139f81909106", "b5230a91f1429fb5f11e589305d567f2756ad1b3"
ART = "2b4232945204cdceaa254c800d4027e3f011dca7"
AGENT_A = "libcurl/7.71.1 mbedTLS/2.16.8 zlib/1.2.11 libssh2/1.9.0 nghttp2/1.40.0 julia/1.6.0-DEV.1278"
AGENT_B = "Client (https://example.org/client)"
SYSTEM_A = "x86_64-apple-darwin18-libgfortran5-julia_version+1.6.0"
SERVER = "eu-central.pkg.julialang.org"

LINE_A = (
    f'14.176.79.196 [06/Nov/2020:20:00:14 +0000] "GET /package/{UUID}/{TREE} HTTP/1.1" 200 147755 '
    f'"{AGENT_A}" 0.027 1.6.0-DEV.1278 {SYSTEM_A} "{CI}" true "{SERVER}"'
)
LINE_B = (
    f'2001:db8::8a2e:370:7334 [28/Oct/2020:01:05:00 +0230] "GET /artifact/{ART} HTTP/1.1" 404 5 '
    f'"{AGENT_B}" 0.158 1.5.1 x86_64-w64-mingw32-libgfortran5-cxx11 "{CI}" false "-"'
)
LINE_C = (
    f'212.181.25.47 [2020-11-02T18:31:41+00:00] "GET /registry/{REG}/{REG_HASH} HTTP/1.1" 200 2319449 '
    f'"{AGENT_A}" 1.546 1.6.0-DEV.1284 x86_64-linux-gnu "{CI}" false "-"'
)
LINE_D = (
    '212.181.25.47 [2020-11-02T18:31:41-02:30] "GET /meta HTTP/1.1" 200 123 "Client" 1.546 1.5.2 '
    'x86_64-linux-gnu "APPVEYOR=n" false "-"'
)
TAIL = ' "rid-1" "miss"'


def line(addr="1.2.3.4", time="[06/Nov/2020:20:00:14 +0000]", method="GET", url="/x", http="HTTP/1.1",
         status="200", size="5", agent="Client", took="1.5", version="1.5.2", system="linux", ci="CI=n",
         flag="true", server="-", rest=' "r" "-"'):
    return (
        f'{addr} {time} "{method} {url} {http}" {status} {size} "{agent}" {took} {version} {system} '
        f'"{ci}" {flag} "{server}"{rest}'
    )


def parse_one(spark, text, file_name="", layout=ACCESS_LOG):
    df = spark.createDataFrame([(text, file_name)], "value string, src_file string")
    rows = parse_lines(df, "value", [], F.col("src_file"), layout).collect()
    return rows[0].asDict() if rows else None


def expected(**given):
    names = [f.name for f in ACCESS_LOG.captured] + ["pkgserver"]
    return dict.fromkeys(names) | given


def url_parts(url):
    return {"request": f"GET {url} HTTP/1.1", "request_method": "GET", "request_url": url, "request_http": "HTTP/1.1"}


A = expected(
    **url_parts(f"/package/{UUID}/{TREE}"), remote_addr="14.176.79.196", time_utc=datetime(2020, 11, 6, 20, 0, 14),
    package=f"/package/{UUID}/{TREE}", package_uuid=UUID, package_hash=TREE, status=200, body_bytes_sent=147755,
    http_user_agent=AGENT_A, request_time=0.027, julia_version="1.6.0-DEV.1278", julia_system=SYSTEM_A,
    julia_ci_variables=CI, julia_interactive=True, julia_pkg_server=SERVER, pkgserver="eu-central",
)
B = expected(
    **url_parts(f"/artifact/{ART}"), remote_addr="2001:db8::8a2e:370:7334", time_utc=datetime(2020, 10, 27, 22, 35),
    artifact=f"/artifact/{ART}", artifact_hash=ART, status=404, body_bytes_sent=5, http_user_agent=AGENT_B,
    request_time=0.158, julia_version="1.5.1", julia_system="x86_64-w64-mingw32-libgfortran5-cxx11",
    julia_ci_variables=CI, julia_interactive=False,
)
C = expected(
    **url_parts(f"/registry/{REG}/{REG_HASH}"), remote_addr="212.181.25.47", time_utc=datetime(2020, 11, 2, 18, 31, 41),
    registry=f"/registry/{REG}/{REG_HASH}", registry_uuid=REG, registry_hash=REG_HASH, status=200,
    body_bytes_sent=2319449, http_user_agent=AGENT_A, request_time=1.546, julia_version="1.6.0-DEV.1284",
    julia_system="x86_64-linux-gnu", julia_ci_variables=CI, julia_interactive=False,
)
D = expected(
    **url_parts("/meta"), remote_addr="212.181.25.47", time_utc=datetime(2020, 11, 2, 21, 1, 41), status=200,
    body_bytes_sent=123, http_user_agent="Client", request_time=1.546, julia_version="1.5.2",
    julia_system="x86_64-linux-gnu", julia_ci_variables="APPVEYOR=n", julia_interactive=False,
)
GOLDEN = [
    (LINE_A, "/logs/access_eu-central.pkg.julialang.org.log".rsplit("/", 1)[1], A),
    (LINE_B, "", B),
    (LINE_C, "", C),
    (LINE_D, "", D),
]


@pytest.mark.parametrize("text,file_name,want", GOLDEN)
def test_golden_lines(spark, text, file_name, want):
    assert parse_one(spark, text, file_name) == want
    tailed = want | {"request_id": "rid-1", "cache_miss": "miss"}
    assert parse_one(spark, text + TAIL, file_name) == tailed
    dashed = want | {"request_id": "rid-1"}
    assert parse_one(spark, text + ' "rid-1" "-"', file_name) == dashed


@pytest.mark.parametrize("text,file_name,want", GOLDEN)
def test_strict_layout_needs_the_tail(spark, text, file_name, want):
    strict = ACCESS_LOG.with_strict_tail()
    assert parse_one(spark, text, file_name, strict) is None
    tailed = want | {"request_id": "rid-1", "cache_miss": "miss"}
    assert parse_one(spark, text + TAIL, file_name, strict) == tailed


VALUES = [
    (dict(time="[nonsense]"), "time_utc", None),
    (dict(time="[06/Foo/2020:20:00:14 +0000]"), "time_utc", None),
    (dict(time="[31/Feb/2020:20:00:14 +0000]"), "time_utc", None),
    (dict(time="[2020-11-02T18:31:60+00:00]"), "time_utc", None),
    (dict(time="[2020-11-02T18:31:41Z]"), "time_utc", None),
    (dict(time="[2020-11-02T18:31:41.5+00:00]"), "time_utc", None),
    (dict(time="[2020-11-02T00:00:00-99:99]"), "time_utc", datetime(2020, 11, 6, 4, 39)),
    (dict(time="[02/nov/2020:00:00:00 +2000]"), "time_utc", datetime(2020, 11, 1, 4, 0)),
    (dict(took="1.2.3"), "request_time", None),
    (dict(took=".5"), "request_time", 0.5),
    (dict(status="9" * 25), "status", None),
    (dict(size="9" * 25), "body_bytes_sent", None),
    (dict(flag="True"), "julia_interactive", None),
    (dict(flag="yes"), "julia_interactive", None),
    (dict(flag="1"), "julia_interactive", True),
    (dict(flag="0"), "julia_interactive", False),
    (dict(agent="-"), "http_user_agent", None),
    (dict(method="-"), "request_method", None),
    (dict(url="-"), "request_url", None),
    (dict(agent='a "quoted" agent'), "http_user_agent", 'a "quoted" agent'),
    (dict(version="-"), "julia_version", None),
    (dict(url=f"/package/{UUID}/{TREE}.tar.gz"), "package_uuid", None),
    (dict(url=f"/package/{UUID}/{TREE}.tar.gz"), "request_url", f"/package/{UUID}/{TREE}.tar.gz"),
    (dict(addr="999.1.1.1"), "remote_addr", "999.1.1.1"),
]


@pytest.mark.parametrize("given,name,want", VALUES)
def test_values(spark, given, name, want):
    row = parse_one(spark, line(**given))
    assert row is not None and row[name] == want


REJECTED = [
    # the agent pattern then reaches for the next quote
    (line(agent=""), "request_time", "unknown"),
    (line(rest=' "r" "hit"'), "cache_miss", "unknown"),
    (line(rest=' "r"'), "cache_miss", "unknown"),
    (line(rest=' "r" "-" more'), "end_of_line", "unknown"),
    (line(rest=' "r 1" "-"'), "request_id", "unknown"),
    (line(version="next"), "julia_version", "unknown"),
    (line(url="/meta/x", version="next"), "julia_version", "known_noise"),
    (line(url="/", version="next"), "julia_version", "known_noise"),
    (line(url="/x/", version="next"), "julia_version", "unknown"),
    (line(url="/docs/a", status="x"), "status", "known_noise"),
    (line(agent="StatPing", took="x"), "request_time", "known_noise"),
    (line(time="06/Nov"), "time_utc", "unknown"),
    ("", "remote_addr", "unknown"),
    ("not a log line", "remote_addr", "unknown"),
]


def test_rejects(spark):
    df = spark.createDataFrame([(t,) for t, _, _ in REJECTED] + [(LINE_A,)], "value string")
    got = {(r.line, r.reject_field, r.reject_class) for r in rejected_lines(df).collect()}
    assert got == set(REJECTED)
    once = parse_or_reject(df).collect()
    assert {(r.line, r.reject_field, r.reject_class) for r in once if r.record == "reject"} == set(REJECTED)
    [row] = [r for r in once if r.record == "row"]
    assert row.package_uuid == UUID and row.line is None and row.reject_field is None


def test_reject_examples_are_bounded(spark):
    many = spark.range(1000).select(F.concat(F.lit("line "), "id").alias("value"))
    examples = reject_examples(rejected_lines(many)).collect()
    assert [r.example for r in sorted(examples, key=lambda r: r.example)] == [1, 2, 3, 4]


def test_next_token(spark):
    texts = [line(version="next"), line(rest=' "r 1" "-"'), line(rest=' "r" "-" more'), "not a log line", line(status="x")]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    got = {r.reject_field: r.next_token for r in reject_examples(rejected_lines(df)).collect()}
    assert got == {
        "julia_version": "next", "request_id": '"r', "end_of_line": "more", "remote_addr": "not", "status": "x",
    }


def test_full_schema_matches_the_contract(spark):
    df = spark.createDataFrame([(LINE_A + TAIL, "access_kr.pkg.julia.log")], "value string, src_file string")
    rows = with_hll_hash(parse_lines(df, "value", [], F.col("src_file")), b"k")
    assert rows.schema.simpleString() == ACCESS_LOG.schema.simpleString()
    assert len(rows.columns) == 27
    assert rows.collect()[0].hll_hash == "fd0b07"


def test_bad_address_keeps_the_row(spark):
    df = spark.createDataFrame([(line(addr="999.1.1.1"),)], "value string")
    [row] = with_hll_hash(parse_lines(df)).collect()
    assert row.remote_addr == "999.1.1.1" and row.hll_hash is None


def test_times_do_not_depend_on_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        # 02:30 does not exist there on this day
        row = parse_one(spark, line(time="[08/Mar/2020:02:30:00 +0000]"))
        assert row["time_utc"] == datetime(2020, 3, 8, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_another_layout(spark):
    short = Layout((Field("who", "[^ ]+"), Field("what", ("/", Field("leaf", r"\w+"))), Field("size", r"\d+", "long")))
    assert short.regex == r"^([^ ]+) (/(\w+)) (\d+)\z"
    assert parse_one(spark, "me /x 12", "", short) == {"who": "me", "what": "/x", "leaf": "x", "size": 12, "pkgserver": None}
    assert short.schema.simpleString() == "struct<who:string,what:string,leaf:string,size:bigint>"


def test_the_regular_expression_runs_once_per_line(spark):
    df = spark.createDataFrame([(LINE_A, "f")], "value string, src_file string")
    rows = parse_lines(df, "value", [], F.col("src_file"))
    query = rows.where(F.col("request_url").startswith("/package") & F.col("time_utc").isNotNull())
    plan = query.groupBy("package_uuid").count()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_replace(value") == 1


def test_only_checks_names_and_changes_no_line(spark):
    lines = spark.createDataFrame([(LINES[0],), ("garbage",), ("more",)], "value string")
    assert parse_lines(lines).count() == parse_lines(lines, only=[]).count() == 1
    assert parse_lines(lines, only=["status"]).columns == ["status"]
    with pytest.raises(ValueError, match="statsu"):
        parse_lines(lines, only=["statsu"])
