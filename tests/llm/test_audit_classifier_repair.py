"""Filter audit, quality classifier and conversation repair against SQL, brute force and odd inputs."""

import hashlib
import itertools
import math
import random
import re
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_texts import LONG, SF_DIR, words
from pyspark.sql import functions as F

from hitledger.llm import additive, conversations, filteraudit

sys.path.insert(0, __file__.rsplit("/", 2)[0])
from compare import differences, engine  # noqa: E402

# --- filter audit ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (6, 1, 0), (6, 0, 1), (None, 1, None), (5, None, None), (8, 0, 0), (10, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def failing(text):
    found = words(text)
    return {
        "A": len(found) < 200,
        "B": 100 * len(set(found)) < 50 * len(found),
        "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
        "D": bool(re.search(r"[#$%&*|]", text)),
    }


def audited(docs, marks):
    """The audit by running every order over (doc_id, text, part) one document at a time."""
    marked = []
    for i, text, part in docs:
        fails = failing(text or "")
        fails["E"] = i is not None and any(j is not None and j < i and (t or "") == (text or "") for j, t, _ in docs)
        marked.append((part or "", fails, any(m[0] == i and m[1] == 1 for m in marks), any(m[0] == i and m[2] == 1 for m in marks)))
    out, share = {}, {}
    for part in {m[0] for m in marked}:
        for order in map("".join, itertools.permutations("ABCDE")):
            left = [m[1:] for m in marked if m[0] == part]
            everyone = left
            for step, name in enumerate(order, 1):
                gone = [m for m in left if m[0][name]]
                left = [m for m in left if not m[0][name]]
                once = [m for m in everyone if m[0][name] and sum(m[0].values()) == 1]
                redundant = sum(m[0][name] for m in everyone) - len(gone)
                out[part, order, step] = [len(left), len(gone), redundant, len(once), sum(m[1] for m in gone), sum(m[2] for m in gone)]
                share[part, name] = share.get((part, name), 0) + len(gone)
    return {k: (*v, share[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def found(df):
    return {(r.part, r.filter_order, r.step): tuple(r[c] for c in filteraudit.RESULTS) for r in df.collect()}


def test_audit_matches_running_every_order(spark, labels):
    random.seed(5)
    letters = ["plain", "LOUD", "a#b", "word", "x"]
    texts = [" ".join(random.choice([*letters, f"w{random.randint(0, 999)}"]) for _ in range(random.choice([3, 150, 260]))) for _ in range(25)]
    docs = [(i, random.choice(texts), random.choice(["s", "t", None])) for i in range(1, 60)]
    docs += [(None, texts[0], "s"), (3, texts[1], "t"), (3, texts[1], "t"), (61, None, ""), (60, "", None)]
    marks = [tuple(r) for r in labels.where("doc_id is not null").collect()]
    table = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(3)
    assert found(filteraudit.audit_filters(table, labels)) == audited(docs, marks)


def test_audit_of_odd_inputs(spark, odd_documents, no_documents, labels):
    got = found(filteraudit.audit_filters(odd_documents, labels))
    docs = [(r.doc_id, r.text, r.source) for r in odd_documents.collect()]
    assert got == audited(docs, [(1, 1, 0), (6, 1, 1), (8, 0, 0)])
    assert filteraudit.audit_filters(no_documents, labels).count() == 0
    assert len(found(filteraudit.audit_filters(odd_documents, labels.limit(0)))) == 3 * 600


def test_many_copies_in_many_parts(spark, labels):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("the same").alias("text"), (F.col("id") % 300).cast("string").alias("source"))
    got = found(filteraudit.audit_filters(docs, labels))
    assert len(got) == 300 * 600
    assert sum(v[1] for (_, order, step), v in got.items() if order == "EABCD" and step == 1) == 2999
    assert got["0", "EABCD", 1][:2] == (1, 9) and got["7", "EABCD", 1][:2] == (0, 10)


# --- quality classifier ---------------------------------------------------------------


def test_features_by_hand():
    texts = ["", "One one two!\nA b, c#\nA b, c#", " \n\t", LONG, "ñ 漢字 ñ"]
    got = additive.features(pa.array(texts))
    for text, row in zip(texts, got):
        raw, low = text.encode(), words(re.sub("[A-Z]", lambda m: m.group().lower(), text))
        seen = re.sub(r"[\x20\x09-\x0D]", "", text).encode()
        lines = [x for x in text.split("\n") if x]
        letters = len(re.findall("[A-Za-z]", text))
        pairs = list(zip(low, low[1:])) or ([tuple(low)] if low else [])
        want = {
            "words": math.log1p(len(low)),
            "word_length": len(seen) / max(len(low), 1),
            "upper": len(re.findall("[A-Z]", text)) / max(letters, 1),
            "digits": len(re.findall("[0-9]", text)) / max(len(seen), 1),
            "beyond_ascii": sum(b > 127 for b in raw) / max(len(seen), 1),
            "sentences": len(re.findall("[.!?]", text)) / max(len(low), 1),
            "distinct_words": len(set(low)) / max(len(low), 1),
            "top_word": max(map(low.count, set(low)), default=0) / max(len(low), 1) if len(low) < 100 else None,
            "echoes": sum(a == b for a, b in zip(low, low[1:])) / max(len(low), 1),
            "distinct_pairs": len(set(pairs)) / max(len(pairs), 1),
            "line_words": math.log1p(len(low) / max(len(lines), 1)),
            "distinct_lines": len(set(lines)) / max(len(lines), 1),
        }
        for name, value in want.items():
            if value is not None:
                assert row[additive.FEATURES.index(name)] == pytest.approx(value, rel=1e-5), (name, text[:20])


def brute_line_cut(gradient, weight):
    """The best single cut by trying all, 0 where none is better than no cut."""

    def gain(low, high):
        return sum(gradient[low:high]) ** 2 / (sum(weight[low:high]) + additive.RIDGE)

    n = len(gradient)
    best = max(range(1, n), key=lambda c: gain(0, c) + gain(c, n))
    return best if gain(0, best) + gain(best, n) > gain(0, n) else 0


def test_trees_find_the_best_cuts():
    rng = np.random.default_rng(3)
    for _ in range(50):
        g, w = rng.normal(size=9), rng.random(9)
        cut = brute_line_cut(g, w)
        values = additive.line_tree(g, w, leaves=2)
        assert len(set(values)) == (2 if cut else 1) and (not cut or values[cut - 1] != values[cut])
        g2, w2 = rng.normal(size=(5, 4)), rng.random((5, 4))
        gain, values = additive.square_tree(g2, w2)

        def part(rows, columns):
            return g2[rows, columns].sum() ** 2 / (w2[rows, columns].sum() + additive.RIDGE)

        best = max(
            part(slice(0, a), slice(0, b)) + part(slice(0, a), slice(b, 4)) + part(slice(a, 5), slice(0, c)) + part(slice(a, 5), slice(c, 4))
            for a in range(1, 5)
            for b in range(1, 4)
            for c in range(1, 4)
        )
        assert gain == pytest.approx(best - part(slice(None), slice(None)))


def test_pairs_learn_what_single_features_cannot():
    rng = np.random.default_rng(4)
    x = rng.random((4000, 4))
    good = ((x[:, 1] > 0.5) ^ (x[:, 3] > 0.5)).astype(float)
    model = additive.fit_tables(x, good)
    assert (1, 3) in model.pairs
    fresh = rng.random((2000, 4))
    right = (model.scores(fresh) > 0.5) == ((fresh[:, 1] > 0.5) ^ (fresh[:, 3] > 0.5))
    assert right.mean() > 0.93


def test_batch_scores_are_sums_of_table_entries():
    rng = np.random.default_rng(6)
    x = rng.random((500, 3))
    model = additive.fit_tables(x, (x[:, 0] + x[:, 2] > 1).astype(float))
    for row, score in zip(x[:40], model.scores(x[:40])):
        at = [sum(cut <= v for cut in edges) for edges, v in zip(model.edges, row)]
        total = model.base + sum(t[b] for t, b in zip(model.tables, at))
        total += sum(t[at[a], at[b]] for (a, b), t in zip(model.pairs, model.pair_tables))
        assert score == pytest.approx(1 / (1 + math.exp(-total)))


def test_held_out_documents_are_told_apart(spark):
    rows = additive.op12_quality_classifier(spark, "/root/testdata/sf0.01").collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    assert len(held) > 50 and sum(p == q for p, q in held) / len(held) > 0.95


def test_labels_of_the_held_out_rows_change_nothing(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    turned = labels.withColumn("quality", F.when(additive.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    models = [additive.learn(docs.where(~additive.held_out()), t.where(~additive.held_out())) for t in (labels, turned)]
    assert all(np.array_equal(a, b) for a, b in zip(models[0].tables, models[1].tables)) and models[0].tables


def test_classifier_on_odd_inputs(spark, odd_documents, no_documents, labels):
    model = additive.learn(odd_documents, labels)
    got = additive.score(odd_documents, model)
    rows = {r.doc_id: r for r in got.collect()}
    assert got.count() == 11 and rows[2].score == rows[3].score and rows[6].doc == "mine"
    assert additive.score(no_documents, model).count() == 0
    assert additive.learn(no_documents, labels).edges == []
    unlearned = additive.score(odd_documents, additive.learn(odd_documents, labels.limit(0)))
    assert {(r.score, r.predicted) for r in unlearned.collect()} == {(0.5, 0)}


# --- conversation repair --------------------------------------------------------------


def cheapest_by_table(codes):
    """(cost, audit) by relaxing every (rows done, last role) in order."""
    start, final = conversations.START, conversations.FINAL

    def inserted(labels):
        labels = dict(labels)
        for _ in range(4):
            for state, (cost, audit) in list(labels.items()):
                role, label = conversations.written_role(state), (cost + 2, audit + "I")
                labels[role] = min(labels.get(role, label), label)
        return labels

    labels = {start: (0, "")}
    for code in codes:
        kind, fault = code >> 2, code & 3
        after = {}
        for state, (cost, audit) in inserted(labels).items():
            ways = [(state, cost + 3, audit + "D")]
            if fault < 2:
                ways.append((conversations.written_role(state), cost + 2 + fault, audit + "R"))
                if conversations.KEPT[state][kind] is not None:
                    ways.append((conversations.KEPT[state][kind], cost + fault, audit + "K"))
            for to, *label in ways:
                after[to] = min(after.get(to, tuple(label)), tuple(label))
        labels = after
    labels = inserted(labels)
    return min(labels[s] for s in final if s in labels)


def every_repair(roles, faults, most):
    """(cost, audit) by trying every string of edits up to ``most`` inserts."""
    best = None
    for inserts in range(most + 1):
        for places in itertools.combinations_with_replacement(range(len(roles) + 1), inserts):
            for edits in itertools.product("DKR", repeat=len(roles)):
                audit = "".join("I" * places.count(k) + e for k, e in enumerate((*edits, "")))
                cost, options, row = 0, [""], 0
                for edit in audit:
                    if edit == "I":
                        cost, options = cost + 2, [o + r for o in options for r in "ua"]
                        continue
                    fault = faults[row]
                    if edit == "D":
                        cost += 3
                    elif fault > 1:
                        options = []
                    else:
                        cost += fault + (2 if edit == "R" else 0)
                        options = [o + r for o in options for r in ("ua" if edit == "R" else roles[row])]
                    row += 1
                if any(re.fullmatch("(s?(ua)+)?", o) for o in options):
                    best = min(best or (cost, audit), (cost, audit))
    return best


def test_search_finds_the_cheapest_edits(monkeypatch):
    random.seed(7)
    for _ in range(60):
        roles, faults = "".join(random.choice("suax") for _ in range(3)), [random.choice([0, 0, 1, 2, 3]) for _ in range(3)]
        codes = bytes("suax".index(r) * 4 + f for r, f in zip(roles, faults))
        assert conversations.cheapest_edits(codes) == every_repair(roles, faults, 3) == cheapest_by_table(codes)
    for segment in (16, 3, 1):
        monkeypatch.setattr(conversations, "SEGMENT", segment)
        for _ in range(300):
            codes = bytes(random.randrange(4) * 4 + random.choice([0, 0, 0, 0, 1, 2, 3]) for _ in range(random.randint(1, 24)))
            assert conversations.cheapest_edits(codes) == cheapest_by_table(codes)
    assert conversations.cheapest_edits(b"") == (0, "")


def test_long_conversations_take_linear_work():
    random.seed(8)
    work = []
    for n in (2_000, 8_000):
        search = conversations.Search()
        search.feed(bytes(random.randrange(4) * 4 + random.choice([0, 0, 1, 2]) for _ in range(n)))
        cost, audit = search.result()
        assert len(audit.replace("I", "")) == n
        work.append(search.expanded / n)
    assert max(work) < 100 and work[1] < 1.5 * work[0]


SCHEMA = "conv_id long, turn long, role string, text string"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def digest(*lines):
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def test_repair_of_odd_rows(spark):
    rows = [
        (1, 0, "system", "Be brief."),
        (1, 1, "user", "Hello?"),
        (1, 2, "assistant", "Hi"),
        (1, 4, "assistant", " \t"),
        (2, None, None, None),
        (2, 3, "", "no role."),
        (3, 5, "user", "same."),
        (3, 5, "user", "same."),
        (3, 6, "user", "same."),
        (None, 0, "user", "x."),
        (None, 1, "assistant", "y.  \n"),
        (4, 1, "tool", "result!"),
        (4, 2, "assistant", LONG + "."),
    ]
    extra = table(spark, rows).withColumns({c: F.lit("mine") for c in ("audit", "cost", "head", "code", "digest", "again")})
    got = {r.conv_id: r for r in conversations.repair_digests(extra, every=extra.select("conv_id").union(spark.range(9, 10).toDF("conv_id"))).collect()}
    assert set(got) == {1, 2, 3, 4, 9, None}
    a = got[1]
    assert (a.gaps, a.blank, a.duplicate, a.truncated, a.illegal, a.cost, a.audit) == (1, 1, 0, 1, 1, 4, "KKKD")
    assert a.repaired_sha256 == digest("system:Be brief.", "user:Hello?", "assistant:Hi")
    b = got[2]
    assert (b.gaps, b.blank, b.truncated, b.cost, b.audit) == (0, 1, 0, 6, "DD") and b.repaired_sha256 == digest()
    assert (got[3].gaps, got[3].duplicate, got[3].audit) == (0, 2, "KDDI") and got[3].repaired_sha256 == digest("user:same.", "assistant:")
    assert got[None].audit == "KK" and got[None].repaired_sha256 == digest("user:x.", "assistant:y.  \n")
    assert got[4].audit == "RK" and got[4].repaired_sha256 == digest("user:result!", f"assistant:{LONG}.")
    assert tuple(got[9])[1:] == (0, 0, 0, 0, 0, 0, "", digest())
    assert conversations.repair_digests(extra.limit(0)).count() == 0


def test_repaired_rows_hold_the_texts(spark):
    rows = [(1, 0, "assistant", "a."), (1, 1, "user", "b."), (1, 2, "system", "c."), (2, 0, "user", " ")]
    got = conversations.repaired_rows(table(spark, rows)).sort("conv_id", "place").collect()
    for conv in (1, 2):
        mine = [r for r in got if r.conv_id == conv]
        assert [r.place for r in mine] == list(range(len(mine)))
    assert "".join(r.edit for r in got if r.conv_id == 1) == conversations.cheapest_edits(bytes([8, 4, 0]))[1]
    assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in got if r.role))
    assert [(r.edit, r.role, r.text) for r in got if r.conv_id == 2] == [("D", None, None)]


def test_one_conversation_with_most_rows(spark):
    n = 5_000
    big = spark.range(n).select(
        F.lit(1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") % 7 == 0, "assistant").otherwise("user").alias("role"),
        F.concat(F.lit("t"), F.col("id"), F.lit(".")).alias("text"),
    )
    rows = big.unionByName(big.where("turn < 8").withColumn("conv_id", F.lit(2).cast("long")))
    got = {r.conv_id: r for r in conversations.repair_digests(rows).collect()}
    codes = bytes((8 if i % 7 == 0 else 4) for i in range(n))
    assert (got[1].cost, got[1].audit) == cheapest_by_table(codes)
    assert (got[2].cost, got[2].audit) == cheapest_by_table(codes[:8])
    texts, state, row = [], conversations.START, 0
    for edit in got[1].audit:
        if edit != "D":
            state = conversations.written_role(state)
            texts.append(f"{conversations.NAMES[state]}:{'' if edit == 'I' else f't{row}.'}")
        row += edit != "I"
    assert got[1].repaired_sha256 == digest(*texts)


@pytest.mark.parametrize(
    ("query", "sql"),
    [(conversations.op13_conversation_repair, conversations.OP13_SQL), (filteraudit.op11_filter_audit, filteraudit.OP11_SQL)],
)
def test_queries_equal_their_sql(spark, query, sql):
    assert differences(query, sql, spark, engine(SF_DIR), SF_DIR) == []
