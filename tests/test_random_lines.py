"""Random and damaged lines, compared with a field-by-field reading in plain Python."""

import calendar
import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hitledger.functions import patterns as P
from hitledger.functions.layout import ACCESS_LOG
from hitledger.operators.parse import parse_lines, parse_or_reject
from hitledger.stages import shared

MONTHS = {m.lower(): i for i, m in enumerate(calendar.month_abbr[1:], start=1)}


def plain_time(text):
    local = re.fullmatch(r"\[(\d\d)/(\w{3})/(\d{4}):(\d\d):(\d\d):(\d\d) ([+-])(\d\d)(\d\d)\]", text, re.A)
    iso = re.fullmatch(r"\[(\d{4})-(\d\d)-(\d\d)T(\d\d):(\d\d):(\d\d)([+-])(\d\d):(\d\d)\]", text, re.A)
    if local:
        day, month, year, *clock, sign, hours, minutes = local.groups()
        month = MONTHS.get(month.lower())
    elif iso:
        year, month, day, *clock, sign, hours, minutes = iso.groups()
    if not (local or iso) or month is None:
        return None
    try:
        ts = datetime(int(year), int(month), int(day), *map(int, clock))
    except ValueError:
        return None
    offset = timedelta(hours=int(hours), minutes=int(minutes))
    return ts - offset if sign == "+" else ts + offset


def plain_number(text, kind):
    try:
        value = kind(text)
    except ValueError:
        return None
    return value if kind is float or value < 2**63 else None


def plain_parse(text, pattern):
    match = re.search(pattern, text)
    if match is None:
        return None
    row = {}
    for spec in ACCESS_LOG.captured:
        raw = match.group(ACCESS_LOG.group_of[spec.name])
        value = None if raw in (None, "-") else raw
        if value is not None and spec.kind == "time":
            value = plain_time(value)
        elif value is not None and spec.kind in ("long", "double"):
            value = plain_number(value, int if spec.kind == "long" else float)
        elif value is not None and spec.kind == "flag":
            value = {"true": True, "1": True, "false": False, "0": False}.get(value)
        row[spec.name] = value
    return row


def hexes(rng, n):
    return "".join(rng.choice("0123456789abcdefABCDEF") for _ in range(n))


def uuid(rng):
    return "-".join(hexes(rng, n) for n in (8, 4, 4, 4, 12))


def random_line(rng):
    pick = rng.choice
    clock = f"{rng.randint(0, 25):02d}:{rng.randint(0, 61):02d}:{rng.randint(0, 61):02d}"
    offset = f"{pick('+-')}{rng.randint(0, 30):02d}"
    local = f"[{rng.randint(0, 32):02d}/{pick([*calendar.month_abbr[1:], 'Xyz', 'nov', 'MAY'])}/{rng.randint(1990, 2040)}:{clock} {offset}30]"
    iso = f"[{rng.randint(1990, 2040)}-{rng.randint(0, 13):02d}-{rng.randint(0, 32):02d}T{clock}{offset}:00]"
    url = pick([
        f"/package/{uuid(rng)}/{hexes(rng, 40)}", f"/package/{uuid(rng)}/{hexes(rng, 41)}", f"/registry/{uuid(rng)}/{hexes(rng, 40)}",
        f"/artifact/{hexes(rng, 40)}", f"/artifact/{hexes(rng, 39)}", "/meta", "/", "/a?b=\"c", "-", f"/package/{uuid(rng)}",
    ])
    pieces = [
        pick(["1.2.3.4", "::1", "2001:db8::1", "host", "1.2.3.4,5"]),
        pick([local, local, iso, iso, "[x]", "[a] b]", "none"]),
        f'"{pick(["GET", "HEAD", "-"])} {url} {pick(["HTTP/1.1", "HTTP/2.0", "HTTP/", "SPDY"])}"',
        pick(["200", "404", "9" * 20, "-", "2x"]),
        pick(["0", "123", "9" * 30]),
        '"' + pick(["a", "-", "two words", 'q"q', 'x" 1 2. y', "", "é ü", "u v\x85w"]) + '"',
        pick(["0.5", "1.2.3", ".", "12", "-"]),
        pick(["1.6.0", "-", "1.", "x.y"]),
        pick(["linux", "-", "a b"]),
        '"' + pick(["CI=n;X=t", "-", "", "a b", 'a"b']) + '"',
        pick(["true", "false", "1", "0", "-", "True"]),
        '"' + pick(["server", "-", ""]) + '"',
        '"' + pick(["rid", "-", "r d"]) + '"',
        '"' + pick(["miss", "-", "hit"]) + '"',
    ]
    # mostly well-formed: any single odd choice above already makes most lines fail
    sound = [
        "1.2.3.4", pick([local, iso]), f'"GET {url} HTTP/1.1"', "200", "5", '"agent"', "0.5", "1.6.0", "linux", '"CI=n"',
        pick(["true", "0"]), '"-"', '"r"', '"-"',
    ]
    odd = rng.sample(range(14), rng.choice([0, 1, 1, 2, 3]))
    line = [pieces[i] if i in odd else sound[i] for i in range(14)]
    end = rng.choice([14, 14, 14, 12, 12, 13])
    text = " ".join(line[:end])
    if rng.random() < 0.15:
        at = rng.randrange(len(text))
        text = text[:at] + rng.choice(['"', " ", "-", "", "\x1f", "\t"]) + text[at + 1 :]
    return text


@pytest.mark.parametrize("strict", [False, True])
def test_random_lines_against_plain_reading(spark, strict):
    rng = random.Random(17 + strict)
    texts = [random_line(rng) for _ in range(4000)]
    layout = ACCESS_LOG.with_strict_tail() if strict else ACCESS_LOG
    # ASCII digits and words, as the servers write them
    pattern = "(?a)" + layout.regex.replace("\\z", "\\Z")
    df = spark.createDataFrame(list(enumerate(texts)), "id int, value string").repartition(4)
    got = {r.id: r.asDict() for r in parse_lines(df, "value", ["id"], layout=layout).collect()}
    want = {i: plain_parse(t, pattern) for i, t in enumerate(texts)}
    parsed = {i for i, w in want.items() if w is not None}
    assert 800 < len(parsed) < 3200
    assert got.keys() == parsed
    for i in parsed:
        assert got[i] == {"id": i, **want[i]}, texts[i]
    few = ["status", "time_utc", "request_url"]
    part = parse_lines(df, "value", ["id"], layout=layout, only=few)
    assert part.columns == ["id", "time_utc", "request_url", "status"]
    assert {r.id: (r.time_utc, r.request_url, r.status) for r in part.collect()} == {
        i: (w["time_utc"], w["request_url"], w["status"]) for i, w in want.items() if w is not None
    }
    once = parse_or_reject(df, "value", ["id"], layout=layout).collect()
    assert len(once) == len(texts)
    assert {r.id for r in once if r.record == "row"} == parsed
    for r in once:
        names = [f.name for f in layout.captured]
        have = {n: r[n] for n in names}
        assert have == (want[r.id] or dict.fromkeys(names))


def test_shared_results_survive_empty_and_filtered_reads(spark):
    df = spark.range(10).select("id", F.to_date(F.lit("2024-01-01")).alias("day"))
    assert shared(df.where("id < 0")).count() == 0
    kept = shared(df)
    assert kept.schema == df.schema or kept.columns == df.columns
    assert kept.where("id > 7").count() == 2
