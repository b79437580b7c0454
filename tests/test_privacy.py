import re

import pytest
from pyspark.sql import functions as F

from hitledger.functions import patterns as P
from hitledger.operators import privacy
from tests_lines import LINES

H = "ab12" * 10
TEXTS = [
    f'10.1.2.3 [06/Nov/2020:20:00:14 +0000] "GET /package/u/{H} HTTP/1.1" "agent 1.2.3.4"',
    f'2001:db8::8a2e:370:7334 [2020-11-02T18:31:41+00:00] "GET /artifact/{H} HTTP/1.1" 200',
    '10.1.2.3 [07/Nov/2020:20:00:14 +0000] "GET /registry/x HTTP/1.1" 2001:db8:1:2:3:4:5:6 10.1.2.3',
]


def masked(spark, texts, **options):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, value string")
    out = privacy.mask_lines(df, "secret", identity=["id"], **options)
    assert out.columns == ["id", "value"]
    return [r.value for r in out.orderBy("id").collect()]


def found(pattern, text):
    return [m.group(0) for m in re.finditer(pattern, text)]


ALL = [privacy.IPV6.pattern, P.IPV4, P.HASH, P.LOCAL_TIME_IN_TEXT, P.ISO_TIME_IN_TEXT]


def test_nothing_survives_without_randomness(spark):
    for before, after in zip(TEXTS, masked(spark, TEXTS, random_share=0.0)):
        for pattern in ALL:
            old, new = found(pattern, before), found(pattern, after)
            if pattern not in ALL[:2]:
                assert len(old) == len(new)
            assert not set(old) & set(found(pattern, after))
        # what lies between the matches stays
        assert re.sub("|".join(f"(?:{p})" for p in ALL), "#", before) == re.sub("|".join(f"(?:{p})" for p in ALL), "#", after)


def test_masking_matches_a_plain_python_pass(spark):
    """Match positions equal those of four ordered replacements."""
    kinds = iter(range(10**6))
    marks = {}
    for text in TEXTS:
        for pattern in ALL:
            text = re.sub(pattern, lambda m: marks.setdefault(m.group(0), f"<{next(kinds)}>"), text)
    assert len(marks) == 8
    after = masked(spark, TEXTS, random_share=0.0)
    fakes = {f for text in after for p in ALL for f in found(p, text)}
    assert len(fakes) == len(marks)


def test_compressed_addresses_are_masked_to_their_end(spark):
    texts = ["fe80::1 x", "2001:db8::57 [", "::ffff:9.8.7.6 y", "::1, z", "a::b:c:d.", "64:ff9b::1.2.3.4"]
    out = masked(spark, texts, random_share=0.0)
    rest = [re.sub("^[0-9a-f]{1,4}(:[0-9a-f]{1,4}){7}", "#", text) for text in out]
    assert rest == ["# x", "# [", "# y", "#, z", "#.", "#"]


def test_equal_values_stay_linked_without_randomness(spark):
    one, _, three = masked(spark, TEXTS, random_share=0.0)
    assert one.split(" ")[0] == three.split(" ")[0]
    many = masked(spark, ["1.1.1.1 /package 1.1.1.1"] * 50, random_share=0.0)
    assert len(set(many)) == 1


def test_share_of_random_values(spark):
    texts = ["1.1.1.1"] * 4000
    out = masked(spark, texts, random_share=0.5)
    top = max(out.count(v) for v in set(out))
    assert 0.45 < top / len(out) < 0.55
    assert len(set(out)) > 1500
    assert len(set(masked(spark, texts, random_share=1.0))) > 3990


def test_same_output_for_any_partitioning_and_seed_dependence(spark):
    df = spark.range(400).select("id", F.concat(F.lit("10.0.0."), F.col("id") % 200, F.lit(" x")).alias("value"))
    run = lambda d, **o: sorted(map(tuple, privacy.mask_lines(d, "k", identity=["id"], **o).collect()))
    assert run(df.coalesce(1)) == run(df.repartition(7))
    assert run(df, seed="1") != run(df, seed="2")
    assert privacy.mask_lines(df, "k", random_share=0.0).collect() != privacy.mask_lines(df, "k2", random_share=0.0).collect()


def test_masked_times_lie_in_the_window(spark):
    texts = [f"[{d:02d}/Nov/2021:20:00:14] 2021-11-{d:02d}T10:00:00" for d in range(1, 29)] * 20
    for text in masked(spark, texts, random_share=1.0):
        [local] = found(P.LOCAL_TIME_IN_TEXT, text)
        [iso] = found(P.ISO_TIME_IN_TEXT, text)
        day, month, year = local.split(":")[0].split("/")
        assert year == "2020" and month in ("Sep", "Oct", "Nov") and 1 <= int(day) <= 31
        assert "2020-09-01" <= iso[:10] < "2020-12-01"


def test_line_filter(spark):
    df = spark.createDataFrame([(t,) for t in [*TEXTS, "GET /meta", "", "x/registry"]], "value string")
    assert privacy.resource_lines(df).count() == 4


def test_a_key_is_required(spark):
    with pytest.raises(ValueError):
        privacy.mask_lines(spark.createDataFrame([("x",)], "value string"), "")


def test_text_file_round_trip(spark, tmp_path):
    from hitledger.plans.exports import write_anonymized
    from hitledger.sources.textscan import text_lines

    (tmp_path / "in.log").write_text("\n".join(LINES) + "\n")
    write_anonymized(text_lines(spark, str(tmp_path / "in.log")), str(tmp_path / "out"), "k")
    out = [r.value for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert len(out) == 6 and not any("10.0.0.1 " in x for x in out)


def test_mask_columns(spark):
    url = f"/package/u/{H}"
    df = spark.createDataFrame(
        [("1.2.3.4", url, H, None), ("::1", "/meta", None, H), (None, None, None, None)],
        "remote_addr string, request_url string, package_hash string, artifact_hash string",
    )
    a, b, c = privacy.mask_columns(df, "k").collect()
    assert re.fullmatch(P.IPV4, a.remote_addr) and a.remote_addr != "1.2.3.4"
    assert ":" in b.remote_addr and b.request_url == "/meta"
    assert a.package_hash != H and a.request_url == f"/package/u/{a.package_hash}" and b.artifact_hash == a.package_hash
    assert tuple(c) == (None,) * 4


def test_the_key_is_in_no_plan(spark, capsys):
    df = spark.createDataFrame([(1, TEXTS[0])], "id int, value string")
    masked_rows = privacy.mask_lines(df, "very-secret-key", identity=["id"], seed="hidden-seed")
    columns = df.select(F.col("value").alias("request_url"), F.lit("1.2.3.4").alias("remote_addr"))
    for out in (masked_rows, privacy.mask_columns(columns, "very-secret-key")):
        out.explain(True)
        shown = capsys.readouterr().out
        assert "ArrowEvalPython" in shown and "secret" not in shown and "hidden-seed" not in shown


def test_forgetting_replacements_changes_nothing(spark, monkeypatch):
    want = masked(spark, TEXTS)
    monkeypatch.setattr(privacy, "REMEMBERED", 1)
    small = privacy._Masker("secret", privacy.PASSES, P.MASK_RANDOM_SHARE, "")
    ids = [__import__("hashlib").sha256(str(i).encode()).hexdigest() for i in range(len(TEXTS))]
    assert [small.masked(t, i) for t, i in zip(TEXTS, ids)] == want


def test_runs_over_a_file_differ_unless_seeded(spark, tmp_path):
    from hitledger.plans.jobs import anonymize_file

    (tmp_path / "in.log").write_text("9.9.9.9 GET /package\n" * 40)

    def run(name, **options):
        anonymize_file(spark, str(tmp_path / "in.log"), str(tmp_path / name), "k", **options)
        return [r.value for r in spark.read.text(str(tmp_path / name)).collect()]

    assert len(set(run("a"))) > 10
    assert sorted(run("b")) != sorted(run("c"))
    assert sorted(run("d", seed="1")) == sorted(run("e", seed="1"))
