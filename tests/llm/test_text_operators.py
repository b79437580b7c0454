"""Encoding, language model, licences, language and near-duplicates against plain-Python rules."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from llm_texts import SF_DIR, lowered, near_components, shingles, words

import public_tokenizers
from hitledger.llm import bpe, brown, components, language, licenses, neardup
from hitledger.llm import textkeys as tk


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(*bpe.default_files())


@pytest.fixture(scope="module")
def library(vocabulary):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})


# --- keys -----------------------------------------------------------------------------


def test_word_keys_for_any_segment_length(monkeypatch):
    random.seed(0)
    for segment in (1 << 20, 8, 30):
        monkeypatch.setattr(tk, "SEGMENT", segment)
        for _ in range(60):
            texts = ["".join(random.choice("ab Cé \n\t漢x") for _ in range(random.randint(0, 50))) for _ in range(5)]
            found = tk.words(pa.array(texts, pa.string()).slice(1), forms=True)
            want = [words(lowered(t)) for t in texts[1:]]
            assert np.diff(found.offsets).tolist() == list(map(len, want))
            flat = [w for x in want for w in x]
            assert len(set(zip(flat, found.keys.tolist()))) == len(set(flat)) == len(set(found.keys.tolist()))
            assert [w.encode()[-1] for w in flat] == (found.endings & 255).tolist()
            offsets, keys = tk.distinct_by_row(*tk.shingles(found, 4))
            assert np.diff(offsets).tolist() == [len(shingles(t, 4)) for t in texts[1:]]


# --- byte-level BPE -------------------------------------------------------------------


def test_encoding_equals_the_library(spark, documents, library):
    got = bpe.op1_byte_bpe(spark, SF_DIR).collect()
    assert len(got) == len(documents)
    for r in got:
        text = documents[r.doc_id].text or ""
        ids = library.encode_ordinary(text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_random_texts_and_appends(vocabulary, library):
    random.seed(1)
    letters = "ab e'srt\n\t .,!12 éñ漢😀   thein"
    for _ in range(400):
        text, more = ("".join(random.choice(letters) for _ in range(random.randint(0, n))) for n in (60, 6))
        assert vocabulary.encode(text) == library.encode_ordinary(text)
        kept, rest = bpe.append_text(vocabulary, text, more)
        assert vocabulary.encode(text)[:kept] + rest == library.encode_ordinary(text + more)


def test_prefixes_and_edits(vocabulary):
    random.seed(2)
    for _ in range(100):
        piece = bytes(random.choice(b"abcthein  er") for _ in range(random.randint(0, 300)))
        table = bpe.PrefixTable(vocabulary, piece[: len(piece) // 2])
        table.append(piece[len(piece) // 2 :])
        at = random.randint(0, len(piece))
        assert table.ids(at) == vocabulary.merged(piece[:at])
        stop, by = min(len(piece), at + 3), bytes(random.choice(b"thein") for _ in range(random.randint(0, 5)))
        table.replace(at, stop, by)
        assert table.last == bpe.PrefixTable(vocabulary, piece[:at] + by + piece[stop:]).last


def test_an_edit_recomputes_its_surroundings_only(vocabulary):
    table = bpe.PrefixTable(vocabulary, b"the rain in spain " * 500)
    assert table.replace(100, 101, b"x") < 2 * vocabulary.longest + 10


def test_forgetting_changes_nothing(vocabulary, monkeypatch):
    text = "there is nothing like remembering the pieces of the words one has read"
    want = vocabulary.encode(text)
    monkeypatch.setattr(bpe, "REMEMBERED", 8)
    small = bpe.Vocabulary(*bpe.default_files())
    pieces = bpe._Pieces(small)
    packed = b"".join(map(pieces.__getitem__, small.pattern.findall(text)))
    assert list(memoryview(packed).cast("I")) == want and len(pieces) <= 4


def test_foreign_ids_are_refused(spark):
    df = spark.createDataFrame([(bytes(np.array([60_000], "<u4")),)], "ids binary")
    with pytest.raises(Exception, match="outside the vocabulary"):
        bpe.decode_column(df, bpe.default_files()).collect()


# --- class bigrams --------------------------------------------------------------------


def test_scores(spark, documents):
    got = {r.doc_id: r for r in brown.op2_brown_scores(spark, SF_DIR).collect()}
    tokens = {i: [*words(lowered(d.text)), "\n"] for i, d in documents.items()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in tokens}
    counts = Counter(w for i, t in tokens.items() if not held[i] for w in t)
    n, v = sum(counts.values()), len(counts)
    for i, t in tokens.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[i], len(t), n)
        assert r.n_known == sum(counts[w] > 0 for w in t)
        assert math.isclose(r.base_score, sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t), rel_tol=1e-9)
        assert r.score < 0
    unseen = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(0)
    classes = rng.integers(1, brown.CLASSES, brown.UNITS)
    classes[0] = 0
    counts, types = np.zeros(brown.UNITS, np.int64), np.zeros(brown.UNITS, np.int64)
    counts[: brown.OWN] = rng.integers(1, 50, brown.OWN)
    types[brown.OWN :] = rng.integers(0, 9, brown.GROUPS)
    counts[brown.OWN :] = types[brown.OWN :] * 3
    lex = brown.Lexicon(*[np.zeros(0)] * 3, counts, types, int(counts.sum()), 1, 0.4)
    model = brown.finished(lex, classes, rng.integers(0, 9, (brown.CLASSES, brown.CLASSES)))
    assert np.allclose((10**model.transitions).sum(axis=1), 1)
    # words of their own, discounted words of groups, the unseen event
    shown = np.bincount(classes, counts - 0.4 * types, brown.CLASSES)
    whole = (shown + 10**model.unseen) / 10**model.emission_sums
    assert np.allclose(whole[1:], 1)


def test_exchange_raises_the_likelihood():
    """The chosen class is the best one by recomputing the whole likelihood."""
    rng = np.random.default_rng(3)
    text = rng.integers(1, 12, 4000)
    classes = np.concatenate([[0], rng.integers(1, 5, 11)])

    def bigrams(c):
        out = np.zeros((brown.CLASSES, brown.CLASSES), np.int64)
        np.add.at(out, (c[text[:-1]], c[text[1:]]), 1)
        return out

    def likelihood(c):
        n = bigrams(c).astype(float)
        f = lambda x: (x * np.log(np.maximum(x, 1))).sum()
        return f(n) - f(n.sum(axis=0)) - f(n.sum(axis=1))

    for unit in range(1, 12):
        row = np.zeros((1, brown.WIDTH), np.int64)
        at = np.flatnonzero(text == unit)
        np.add.at(row[0], classes[text[at[at > 0] - 1]], 1)
        np.add.at(row[0], brown.CLASSES + classes[text[at[at < len(text) - 1] + 1]], 1)
        row[0, -1] = ((text[1:] == unit) & (text[:-1] == unit)).sum()
        [best] = brown.best_classes(row, classes[[unit]], bigrams(classes))
        scores = {}
        for c in range(1, 6):
            moved = classes.copy()
            moved[unit] = c
            scores[c] = likelihood(moved)
        assert scores[min(best, 5)] >= max(scores.values()) - 1e-6


# --- licences -------------------------------------------------------------------------


def found_licenses(text):
    table = pa.RecordBatch.from_pydict({"i": [0], "t": [text]})
    names = ["i", "license", "containment", "first_word", "end_word"]
    [out] = licenses._scanned(licenses.NOTICES, 1, names)(iter([table]))
    return {r["license"]: r for r in out.to_pylist()}


def test_every_notice_is_found_wherever_it_stands():
    random.seed(5)
    filler = [f"w{i}" for i in range(500)]
    for name, notice in licenses.NOTICES.items():
        for before in (0, 1, 7, 63, 300):
            text = " ".join([*random.choices(filler, k=before), notice.upper() if before == 7 else notice, *random.choices(filler, k=40)])
            match = found_licenses(text)[name]
            assert match["containment"] == 1.0 and match["first_word"] == before
        assert name in found_licenses(notice)


def test_changed_notices_need_four_fifths():
    notice = licenses.NOTICES["MIT grant"].split(" ")
    changed = [*notice[:12], "oddly", *notice[13:]]
    match = found_licenses("some words before " + " ".join(changed) + " and after")["MIT grant"]
    assert 0.8 <= match["containment"] < 1
    torn = [w for k, w in enumerate(notice) for w in ([w, "x"] if k % 4 == 3 else [w])]
    assert "MIT grant" not in found_licenses(" ".join(torn))
    assert found_licenses("MIT License and Apache License, Version 3") == {}


@pytest.mark.parametrize(
    ("text", "name"),
    [
        ("This project is licensed under the MIT license - see LICENSE.", "MIT notice"),
        ("# SPDX-License-Identifier: GPL-2.0-or-later\nimport os", "GPL-2.0-or-later SPDX"),
        ("/* SPDX-License-Identifier: Apache-2.0 */ int main", "Apache-2.0 SPDX"),
        ("Text is available under the Creative Commons Attribution-ShareAlike License; terms may apply.", "CC-BY-SA notice"),
        ("The code is licensed under the ISC License.", "ISC notice"),
        ("This is free and unencumbered software released into the public domain. Enjoy.", "Unlicense notice"),
        ("Our server is licensed under the GNU Affero General Public License, have fun", "AGPL notice: licensed"),
        ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
         "Public License as published by the Free Software Foundation; either version 2.1 of the License", "LGPL notice"),
        ("Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.", "BSD notice: style"),
        ("All photos are licensed under CC BY-SA 4.0 unless noted", "CC-BY-SA-4.0 notice"),
    ],
)
def test_usual_wordings(text, name):
    assert name in found_licenses(text) and name in found_licenses("filler " * 300 + text + " filler" * 300)


def test_versions_and_kinds_are_told_apart():
    assert not any(n.startswith("GPL-2") for n in found_licenses("This work is licensed under the GNU General Public License, version 3."))
    assert not any(n.startswith("GPL-3.0 notice") for n in found_licenses("under the GNU General Public License version 2 as published"))
    assert "LGPL notice: licensed" not in found_licenses("licensed under the GNU General Public License, version 3")
    assert set(found_licenses("A clean text about licenses, the public domain and free software in general.")) == set()


def test_whole_texts_are_found_among_others_and_with_changes():
    random.seed(6)
    filler = [f"w{i}" for i in range(500)]
    for name in [n for n in licenses.NOTICES if n.endswith(" text")]:
        own = licenses.NOTICES[name].split()
        changed = [f"x{k}" if k % 60 == 30 else w for k, w in enumerate(own)]
        text = " ".join([*random.choices(filler, k=137), *changed, *random.choices(filler, k=50)])
        match = found_licenses(text)[name]
        assert 0.8 <= match["containment"] < 1 and abs(match["first_word"] - 137) < 6
        # half of a licence is not the licence
        assert name not in found_licenses(" ".join(own[: len(own) // 2]))


def test_licenses_of_all_documents(spark, documents):
    got = {(r.doc_id, r.license) for r in licenses.op4_license_scan(spark, SF_DIR).collect()}
    rule = lambda t: "".join(c if c.isalnum() or ord(c) > 127 else " " for c in t or "")
    wanted = {name: shingles(rule(text), 5) for name, text in licenses.NOTICES.items()}
    own = {i: shingles(rule(d.text), 5) for i, d in documents.items()}
    assert got == {(i, n) for i, s in own.items() for n, t in wanted.items() if len(s & t) >= 0.8 * len(t)}


# --- language -------------------------------------------------------------------------


def test_backpropagation_equals_finite_differences():
    rng = np.random.default_rng(0)
    network = language.new_network(["a", "b"], 1)
    codes = rng.integers(0, 256, (9, 3))
    real = np.ones((9, 3), np.float32)
    codes[6:, 1], real[6:, 1] = language.PAD, 0
    weight = rng.standard_normal((9, 3, language.HIDDEN))
    for part in network.backward.parts():
        part[...] = part.astype(np.float32)
    wide = language.Gru(*[p.astype(np.float64) for p in network.backward.parts()])
    loss = lambda: float((language.states(wide, codes[::-1], real[::-1]) * weight).sum())
    kept = []
    language.states(wide, codes[::-1], real[::-1], keep=kept)
    grads = language.gradients(wide, codes[::-1], real[::-1], kept, weight)
    for part, grad in zip(wide.parts(), grads):
        flat = np.argsort(-np.abs(grad).ravel())[:5]
        for k in flat:
            old = part.flat[k]
            part.flat[k] = old + 1e-3
            up = loss()
            part.flat[k] = old - 1e-3
            down = loss()
            part.flat[k] = old
            assert math.isclose((up - down) / 2e-3, grad.flat[k], rel_tol=0.05, abs_tol=0.05)


def test_held_out_languages(spark, documents):
    got = language.op7_language(spark, "/root/testdata/sf0.01").collect()
    right = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    tried = [r for r in got if r.held_out and right[r.doc_id] and r.lang_pred != "und"]
    assert len(tried) > 100 and sum(r.lang_pred == right[r.doc_id] for r in tried) >= 0.97 * len(tried)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)


def plain_probabilities(network, data):
    """Mean label probabilities of a text's bytes, one byte and one number at a time."""
    size, sign = language.HIDDEN, lambda x: x / (1 + abs(x))

    def run(gru, codes):
        h, out = [0.0] * size, []
        w, b = gru.recurrent.tolist(), gru.bias.tolist()
        for code in codes:
            x = gru.inputs[code].tolist()
            s = [sum(h[i] * w[i][k] for i in range(size)) for k in range(3 * size)]
            z, r = ([0.5 + 0.5 * sign(x[k] + s[k]) for k in range(g * size, (g + 1) * size)] for g in (0, 1))
            n = [sign(x[2 * size + k] + r[k] * (s[2 * size + k] + b[k])) for k in range(size)]
            h = [n[k] + z[k] * (h[k] - n[k]) for k in range(size)]
            out.append(h)
        return out

    sums = [0.0] * len(network.languages)
    for start in range(0, len(data), language.WINDOW):
        codes = data[start : start + language.WINDOW]
        for f, b in zip(run(network.forward, codes), reversed(run(network.backward, codes[::-1]))):
            logits = [sum(v * w for v, w in zip(f + b, column)) + s for column, s in zip(network.output.T.tolist(), network.shift.tolist())]
            top = max(logits)
            e = [math.exp(v - top) for v in logits]
            sums = [t + v / sum(e) for t, v in zip(sums, e)]
    return [t / len(data) for t in sums]


def test_scores_equal_a_plain_forward_pass(spark, documents):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    network = language.fit(docs.where(~language.in_fold("doc_id", 0)).select("lang", "text"))
    got = {r.doc_id: r for r in language.op7_language(spark, SF_DIR).collect()}
    short = sorted((d for d in documents.values() if d.text and len(d.text) > 100), key=lambda d: len(d.text))[:12]
    for doc in short:
        plain = plain_probabilities(network, doc.text.encode())
        assert got[doc.doc_id].score == pytest.approx(max(plain), abs=1e-3)
        assert got[doc.doc_id].lang_pred == network.languages[int(np.argmax(plain))]


def test_probabilities_cover_every_byte():
    network = language.new_network(["a", "b", "c"], 4)
    texts = ["é" * 700, "", "short", "x" * 200_000]
    found = language.document_probabilities(network, pa.array(texts, pa.string()))
    assert np.allclose(found.sum(axis=1), [1, 0, 1, 1], atol=1e-4)
    alone = [language.document_probabilities(network, pa.array([t], pa.string()))[0] for t in texts]
    assert np.allclose(found, alone, atol=1e-5)


# --- near-duplicates ------------------------------------------------------------------


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    common, sizes = rng.integers(0, 1 << 62, 4000, dtype=np.uint64), (40, 400, 4000)
    for size in sizes:
        a = np.unique(common[:size])
        b = np.unique(np.concatenate([a[: int(size * 0.9)], rng.integers(0, 1 << 62, size // 10, dtype=np.uint64)]))
        both = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        signatures = neardup.superminhash(np.array([0, len(a), len(a) + len(b)]), np.concatenate([a, b]))
        assert (signatures < (neardup.REGISTERS << neardup.FRACTION)).all()
        assert abs((signatures[0] == signatures[1]).mean() - both) < 0.13


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 60)] + [(61, 62), (62, 62)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(5)
    got = {r.node: r.component for r in components.components(df).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 7 for i in range(7, 60)} | {61: 61, 62: 61}
    assert components.components(df.limit(0)).count() == 0


def test_near_duplicates_of_all_documents(spark, documents):
    got = {r.doc_id: r for r in neardup.op9_near_duplicates(spark, SF_DIR).collect()}
    want = near_components({i: d.text for i, d in documents.items()}, 4)
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(r.n_shingles == len(shingles(documents[i].text, 4)) and r.kept == (want[i] == i) for i, r in got.items())


def test_groups_around_a_centre_and_borderline_groups(spark, monkeypatch):
    """Copies that are near to a centre alone, others near to nothing, in small blocks."""
    monkeypatch.setattr(neardup, "BLOCK", 8)
    random.seed(9)
    base = [f"b{i}" for i in range(200)]

    def edited(source, n):
        out = list(source)
        for k in random.sample(range(len(out)), n):
            out[k] = f"e{random.random()}"
        return " ".join(out)

    texts = {1000 + i: edited(base, 5) for i in range(60)} | {1999: " ".join(base)}
    other = [f"o{i}" for i in range(200)]
    texts |= {3000 + i: edited(other, 9) for i in range(40)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(6)
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(df, size=4).collect()}
    assert got == near_components(texts, 4)
