"""Quality classifier: a generalised additive model with pairwise interactions.

A text is described by the numbers of ``FEATURES``. Each is cut into bins at quantiles of the
training sample. Cyclic boosting goes round the features and each time adds a shallow tree over the
bins of that one feature, fitted to the gradient of the logistic loss and shrunken, to the feature's
lookup table. Then the pairs that explain most of what is left get tables of two features, boosted
alike. The score of a text is the logistic of a sum of table entries: one lookup per feature and
pair, for a whole Arrow batch at a time. The tables are small enough to be read.

Labels are learned from ``SAMPLE`` labelled documents at most, those with the least hash of the id.
Everything else is done for every row and the whole text. Features are computed in numpy over slices
of a batch; a long text is one slice.

Defined results: null texts count as empty and get a score like any other; labels other than 0 and 1
and labels without id teach nothing; of several labels of an id the largest counts; without labels
all scores are 0.5, with labels of one kind all are their smoothed share; repeated rows get equal
scores; an empty table gives an empty result; columns named ``score`` or ``predicted`` are replaced.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitledger.llm import textkeys as tk
from hitledger.llm.common import text_or_empty

#: Bound of the labelled documents that the tables are fitted on.
SAMPLE = 20_000
BINS, LEAVES, PAIRS = 32, 3, 8
ROUNDS, PAIR_ROUNDS, RATE, RIDGE = 120, 60, 0.15, 2.0
THRESHOLD = 0.7

FEATURES = [
    "words",  # logarithm of their number
    "word_length",
    "upper",  # share of ASCII letters
    "digits",  # this and the next four: share of visible bytes
    "punctuation",
    "symbols",
    "shouts",
    "beyond_ascii",
    "sentences",  # ends of sentences and commas per word
    "commas",
    "distinct_words",  # share of the words
    "top_word",
    "echoes",  # words equal to the word before
    "distinct_pairs",
    "line_words",  # logarithm of the words per line
    "distinct_lines",
    "entropy",  # of the bytes, in bits
]
CLASSES = {
    "upper": bytes(range(65, 91)),
    "lower": bytes(range(97, 123)),
    "digits": bytes(range(48, 58)),
    "punctuation": bytes(b for b in range(33, 127) if not chr(b).isalnum()),
    "symbols": b"#$%&*+/<=>@[\\]^_`{|}~",
    "shouts": b"!?",
    "sentences": b".!?",
    "commas": b",;:",
    "white": tk.WHITE,
    "beyond_ascii": bytes(range(128, 256)),
}
#: Lines as the words between line ends, letters as they are.
LINES = tk._folding(b"\n", lower=False)


def _by_row(keys: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys, largest count of one key) of each row."""
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((keys, rows))
    keys, rows = keys[order], rows[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (rows[1:] != rows[:-1])
    starts = np.flatnonzero(fresh)
    counts = np.diff(np.append(starts, len(keys)))
    distinct = np.bincount(rows[starts], minlength=len(offsets) - 1)
    most = np.zeros(len(offsets) - 1, np.int64)
    np.maximum.at(most, rows[starts], counts)
    return distinct, most


def features(column: pa.Array) -> np.ndarray:
    """(rows x FEATURES) of a string column without nulls."""
    out = np.zeros((len(column), len(FEATURES)), np.float32)
    for start, stop in tk.slices(column):
        out[start:stop] = _features(column.slice(start, stop - start))
    return out


def _histograms(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(rows x 256) counts of bytes, a segment at a time so that the numbers per byte stay few."""
    counts = np.zeros((len(offsets) - 1, 256), np.int64)
    for low in range(0, len(data), tk.SEGMENT):
        part = data[low : low + tk.SEGMENT]
        row = np.searchsorted(offsets, np.arange(low, low + len(part)), "right") - 1
        first, behind = row[0], row[-1] + 1
        found = np.bincount((row - first) * 256 + part, minlength=(behind - first) * 256)
        counts[first:behind] += found.reshape(-1, 256)
    return counts


def _features(column: pa.Array) -> np.ndarray:
    data, offsets = tk.string_parts(column)
    counts = _histograms(data, offsets)
    of = {name: counts[:, list(members)].sum(axis=1) for name, members in CLASSES.items()}
    size = counts.sum(axis=1)
    visible = np.maximum(size - of["white"], 1)
    found = tk.words(column)
    n_words = np.diff(found.offsets)
    some = np.maximum(n_words, 1)
    distinct, most = _by_row(found.keys, found.offsets)
    first = np.zeros(len(found.keys) + 1, bool)
    first[found.offsets] = True
    echo = np.zeros(len(found.keys), bool)
    echo[1:] = (found.keys[1:] == found.keys[:-1]) & ~first[1:-1]
    totals = np.concatenate([[0], np.cumsum(echo)])
    pair_offsets, pairs = tk.shingles(found, 2)
    distinct_pairs, _ = _by_row(pairs, pair_offsets)
    lines = tk.words(column, LINES)
    n_lines = np.maximum(np.diff(lines.offsets), 1)
    distinct_lines, _ = _by_row(lines.keys, lines.offsets)
    share = counts / np.maximum(size, 1)[:, None]
    entropy = -(share * np.log2(np.where(share > 0, share, 1))).sum(axis=1)
    return np.column_stack(
        [
            np.log1p(n_words),
            (size - of["white"]) / some,
            of["upper"] / np.maximum(of["upper"] + of["lower"], 1),
            of["digits"] / visible,
            of["punctuation"] / visible,
            of["symbols"] / visible,
            of["shouts"] / visible,
            of["beyond_ascii"] / visible,
            of["sentences"] / some,
            of["commas"] / some,
            distinct / some,
            most / some,
            (totals[found.offsets[1:]] - totals[found.offsets[:-1]]) / some,
            distinct_pairs / np.maximum(np.diff(pair_offsets), 1),
            np.log1p(n_words / n_lines),
            distinct_lines / n_lines,
            entropy,
        ]
    )


# --- the model ------------------------------------------------------------------------


@dataclass
class Additive:
    """``edges`` by feature; ``tables`` by feature (bins) and by pair of features (bins x bins)."""

    edges: list[np.ndarray]
    base: float
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        """(features x rows), the bin of each number."""
        return np.array([np.searchsorted(edges, x[:, k], "right") for k, edges in enumerate(self.edges)], np.int64)

    def logits(self, bins: np.ndarray) -> np.ndarray:
        total = np.full(bins.shape[1], self.base)
        for table, where in zip(self.tables, bins):
            total += table[where]
        for (a, b), table in zip(self.pairs, self.pair_tables):
            total += table[bins[a], bins[b]]
        return total

    def scores(self, x: np.ndarray) -> np.ndarray:
        return logistic(self.logits(self.bins(x))) if self.edges else np.full(len(x), float(logistic(self.base)))


def logistic(x):
    return 0.5 * (np.tanh(0.5 * x) + 1)


def _gain(gradient: np.ndarray, weight: np.ndarray) -> np.ndarray:
    return gradient**2 / (weight + RIDGE)


def line_tree(gradient: np.ndarray, weight: np.ndarray, leaves: int = LEAVES) -> np.ndarray:
    """Leaf values by bin of the best greedy tree over sums of gradients and second derivatives."""
    bounds = [0, len(gradient)]
    sums_g, sums_w = np.concatenate([[0], np.cumsum(gradient)]), np.concatenate([[0], np.cumsum(weight)])
    while len(bounds) <= leaves:
        best = (1e-9, 0)
        for low, high in zip(bounds, bounds[1:]):
            cuts = np.arange(low + 1, high)
            if not len(cuts):
                continue
            left_g, left_w = sums_g[cuts] - sums_g[low], sums_w[cuts] - sums_w[low]
            all_g, all_w = sums_g[high] - sums_g[low], sums_w[high] - sums_w[low]
            gains = _gain(left_g, left_w) + _gain(all_g - left_g, all_w - left_w) - _gain(all_g, all_w)
            k = int(gains.argmax())
            best = max(best, (float(gains[k]), int(cuts[k])))
        if not best[1]:
            break
        bounds = sorted([*bounds, best[1]])
    values = np.empty(len(gradient))
    for low, high in zip(bounds, bounds[1:]):
        values[low:high] = (sums_g[high] - sums_g[low]) / (sums_w[high] - sums_w[low] + RIDGE)
    return values


def square_tree(gradient: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
    """(gain, values) of the best tree of one cut along the rows and, in each half, one along the columns."""

    def halves(sums_g: np.ndarray, sums_w: np.ndarray) -> np.ndarray:
        """Gain by (cut along the rows, cut along the columns), for the part given by its column sums."""
        left_g, left_w = sums_g[:, :-1].cumsum(axis=1), sums_w[:, :-1].cumsum(axis=1)
        all_g, all_w = sums_g.sum(axis=1, keepdims=True), sums_w.sum(axis=1, keepdims=True)
        return _gain(left_g, left_w) + _gain(all_g - left_g, all_w - left_w)

    top_g, top_w = gradient.cumsum(axis=0)[:-1], weight.cumsum(axis=0)[:-1]
    all_g, all_w = gradient.sum(axis=0), weight.sum(axis=0)
    if not top_g.size or gradient.shape[1] < 2:
        return 0.0, np.zeros_like(gradient)
    top, bottom = halves(top_g, top_w), halves(all_g - top_g, all_w - top_w)
    cut = int((top.max(axis=1) + bottom.max(axis=1)).argmax())
    values = np.empty_like(gradient)
    for rows, across in ((slice(0, cut + 1), int(top[cut].argmax()) + 1), (slice(cut + 1, None), int(bottom[cut].argmax()) + 1)):
        for columns in (slice(0, across), slice(across, None)):
            values[rows, columns] = gradient[rows, columns].sum() / (weight[rows, columns].sum() + RIDGE)
    gain = top[cut].max() + bottom[cut].max() - _gain(all_g.sum(), all_w.sum())
    return float(gain), values


def fit_tables(x: np.ndarray, good: np.ndarray) -> Additive:
    """Cyclic boosting over features, then over the most promising pairs."""
    n, positive = len(good), int(good.sum())
    base = float(np.log((positive + 1) / (n - positive + 1)))
    if positive in (0, n):
        return Additive([], base)
    cuts = np.arange(1, BINS) / BINS
    # a cut lies between two values that occur, so equal values share a bin
    edges = [np.unique(np.quantile(x[:, k], cuts, method="higher")) for k in range(x.shape[1])]
    model = Additive(edges, base)
    bins = model.bins(x)
    model.tables = [np.zeros(len(e) + 1) for e in edges]
    logits = np.full(n, base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = logistic(logits)
        return good - p, p * (1 - p)

    def sums(where: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(where, values, size)

    for _ in range(ROUNDS):
        for k, table in enumerate(model.tables):
            gradient, weight = slopes()
            step = RATE * line_tree(sums(bins[k], gradient, len(table)), sums(bins[k], weight, len(table)))
            table += step
            logits += step[bins[k]]

    def square(a: int, b: int) -> tuple[float, np.ndarray, np.ndarray]:
        shape = len(model.tables[a]), len(model.tables[b])
        cell = bins[a] * shape[1] + bins[b]
        gradient, weight = slopes()
        flat = [sums(cell, v, shape[0] * shape[1]).reshape(shape) for v in (gradient, weight)]
        return (*square_tree(*flat), cell)

    ranked = sorted(itertools.combinations(range(len(edges)), 2), key=lambda p: (-square(*p)[0], p))
    model.pairs = ranked[:PAIRS]
    model.pair_tables = [np.zeros((len(model.tables[a]), len(model.tables[b]))) for a, b in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for pair, table in zip(model.pairs, model.pair_tables):
            _, values, cell = square(*pair)
            table += RATE * values
            logits += RATE * values.reshape(-1)[cell]
    return model


# --- on Spark -------------------------------------------------------------------------


def described(texts: pa.Array) -> pa.Array:
    found = features(texts)
    offsets = pa.array(np.arange(len(found) + 1, dtype=np.int32) * len(FEATURES))
    return pa.ListArray.from_arrays(offsets, pa.array(found.reshape(-1)))


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Additive:
    """Fits on the documents of at most ``sample`` labelled ids, and at most that many rows."""
    known = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.max("quality").alias("good"))
    order = F.xxhash64("doc_id"), F.col("doc_id")
    chosen = F.broadcast(known.orderBy(*order).limit(sample))
    found = docs.select("doc_id", text_or_empty("text").alias("text")).join(chosen, "doc_id")
    rows = found.select("doc_id", "good", F.arrow_udf(described, "array<float>")("text").alias("x")).orderBy(*order, "x").limit(sample).toArrow()
    x = rows.column("x").combine_chunks().flatten().to_numpy().reshape(-1, len(FEATURES))
    return fit_tables(x, rows.column("good").to_numpy().astype(float))


def score(docs: DataFrame, model: Additive) -> DataFrame:
    """Adds ``score`` and ``predicted`` to every document."""

    @F.arrow_udf("double")
    def scores(texts: pa.Array) -> pa.Array:
        return pa.array(np.clip(model.scores(features(texts)), 0.0, 1.0))

    scored = docs.withColumn("score", scores(text_or_empty("text")))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def held_out():
    """Whether crc32 of the id as text leaves 2 modulo four (null id: crc of '')."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2


def op12_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out())
    scored = score(docs, learn(docs.where(~held_out()), labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")
