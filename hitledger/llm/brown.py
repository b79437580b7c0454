"""Language-model scores from a Brown class-based bigram model learned by exchange clustering.

P(text) is the product over its tokens of P(class | class before) * P(token | class). The end of a
text is a token with a class of its own, which is also what stands before the first word.

Units of clustering are the ``OWN - 1`` most frequent words, and for all other words the groups of
those with equal endings (hashed to ``GROUPS``), so every word, seen or not, has a class. Each round
counts for every unit the classes to its left and right over the whole training corpus, then moves
units to the class that raises the likelihood of the class bigrams most, given the counts of the
round. Half the units, by a hash that changes each round, may move, so that two which attract each
other don't swap places for ever.

Emissions: a unit word has its share of the class; the words of groups are discounted by d (Ney's
n1 / (n1 + 2 n2)), and what is discounted in a class is the probability that an unseen word follows.
So the probabilities of all words and of the unseen event sum to one in every class.

What is broadcast is bounded by parameters: ``HOT`` counts, OWN + GROUPS classes, CLASSES squared
transitions. Counts of rarer words meet the documents by a shuffle join. Words are 64-bit keys.

Defined results: null and empty texts are one end token; rows with equal ids are documents of
their own; without training rows all words are unseen; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitledger.llm import textkeys as tk
from hitledger.llm.common import in_fold, text_or_empty
from hitledger.stages import drop_stage, shared

#: Words that are units of their own, the end token included; endings' groups; together under 2**16.
OWN, GROUPS = 60_000, 4_096
UNITS = OWN + GROUPS
CLASSES = 64
ROUNDS = 6
#: Words whose counts are broadcast; the first OWN - 1 of them are units.
HOT = 1 << 18
BLOCK = 1024
SALTS = 32
TOKENS_AT_ONCE, TEXT_AT_ONCE = 1 << 20, 2 << 20
WIDTH = 2 * CLASSES + 1


def group_of(endings: np.ndarray) -> np.ndarray:
    return (tk.mixed(endings.astype(np.uint64)) % np.uint64(GROUPS)).astype(np.int64)


def word_counts(texts: DataFrame) -> DataFrame:
    """(key, n, ending) of every distinct word of a one-column table of texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in tk.slices(batch.column(0), TEXT_AT_ONCE):
                found = tk.words(batch.column(0).slice(start, stop - start), forms=True)
                keys, first, n = np.unique(found.keys, return_index=True, return_counts=True)
                arrays = [pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64)), pa.array(found.endings[first])]
                yield pa.RecordBatch.from_arrays(arrays, names=["key", "n", "ending"])

    counted = texts.mapInArrow(count, "key long, n long, ending int")
    return counted.groupBy("key").agg(F.sum("n").alias("n"), F.min("ending").alias("ending"))


@dataclass
class Lexicon:
    """Counts of the hot words by ascending key, their units (-1: by ending), and the totals."""

    keys: np.ndarray
    counts: np.ndarray
    units: np.ndarray
    unit_counts: np.ndarray
    unit_types: np.ndarray
    tokens: int
    distinct: int
    discount: float

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.5) / (self.tokens + 0.5 * (self.distinct + 1)))


def hot_words(counts: DataFrame, most: int) -> DataFrame:
    """All words from some count on: as many as fit in ``most`` rows.

    The count is found on a histogram by sixteenths of powers of two, at most 1008 rows; of the small
    counts each has a row of its own.
    """
    step = F.floor(F.log2("n") * 16).cast("int")
    histogram = counts.groupBy(step.alias("step")).agg(F.count("*").alias("words")).orderBy(F.desc("step")).collect()
    least, words = None, 0
    for row in histogram:
        words += row["words"]
        if words > most:
            break
        least = row["step"]
    return counts.where(F.lit(False) if least is None else step >= least)


def lexicon(counts: DataFrame, texts: int) -> Lexicon:
    """From the table of counts and the number of training texts. Gathers HOT rows and 2**17 sums."""
    top = hot_words(counts, HOT).toPandas().sort_values(["n", "key"], ascending=[False, True])
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    keys = top["key"].to_numpy(np.int64).view(np.uint64)
    n, endings = top["n"].to_numpy(np.int64), top["ending"].to_numpy(np.int64)
    unit_counts, unit_types = np.zeros(UNITS, np.int64), np.zeros(UNITS, np.int64)
    # words seen once are known by their ending, as unseen words have to be
    own = int(min((n > 1).sum(), OWN - 1))
    unit_counts[0] = texts
    unit_counts[1 : own + 1] = n[:own]
    by_ending = counts.groupBy("ending").agg(
        F.sum("n").alias("n"), F.count("*").alias("types"),
        F.count_if(F.col("n") == 1).alias("singles"), F.count_if(F.col("n") == 2).alias("doubles"),
    ).toPandas()
    group = group_of(by_ending["ending"].to_numpy(np.int64))
    np.add.at(unit_counts, OWN + group, by_ending["n"].to_numpy(np.int64))
    np.add.at(unit_types, OWN + group, by_ending["types"].to_numpy(np.int64))
    # less the words that are units
    np.subtract.at(unit_counts, OWN + group_of(endings[:own]), n[:own])
    np.subtract.at(unit_types, OWN + group_of(endings[:own]), 1)
    singles, doubles = int(by_ending["singles"].sum()), int(by_ending["doubles"].sum())
    units = np.full(len(top), -1, np.int64)
    units[:own] = np.arange(1, own + 1)
    order = np.argsort(keys)
    return Lexicon(
        keys[order], n[order], units[order], unit_counts, unit_types,
        int(total[0]) + texts, int(total[1]) + (texts > 0), singles / (singles + 2 * doubles) if singles else 0.5,
    )


_CODED = (
    "__tokens long, __known long, __base double, __emitted double, __units binary, "
    "__rare_keys binary, __rare_n binary, __rare_units binary"
)


def _coded(lex: Lexicon, text_at: int, names: list[str]):
    """Adds each text's units and all that the hot counts decide; other words as (key, n, unit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count_of = np.append(lex.counts, 0)
        base_of = lex.base(count_of)
        shown = np.append(np.where(lex.units >= 0, lex.counts, np.maximum(lex.counts - lex.discount, 1e-9)), 1.0)
        emitted_of = np.log10(shown)
        unit_of = np.append(lex.units, -1)
        end_base = float(lex.base(lex.unit_counts[:1])[0])
        end_emitted = float(np.log10(max(lex.unit_counts[0], 1)))
        for whole in batches:
            for start, stop in tk.slices(whole.column(text_at), TEXT_AT_ONCE):
                part = whole.slice(start, stop - start)
                found = tk.words(part.column(text_at), forms=True)
                counts = np.diff(found.offsets)
                at = np.searchsorted(lex.keys, found.keys)
                if len(lex.keys):
                    near = np.minimum(at, len(lex.keys) - 1)
                    at = np.where(lex.keys[near] == found.keys, near, len(lex.keys))
                hot = at < len(lex.keys)
                units = unit_of[at]
                units = np.where(units >= 0, units, OWN + group_of(found.endings)).astype(np.uint16)

                def by_row(x: np.ndarray) -> np.ndarray:
                    sums = np.concatenate([[0], np.cumsum(x)])
                    return sums[found.offsets[1:]] - sums[found.offsets[:-1]]

                seen = int(lex.unit_counts[0] > 0)
                columns = [
                    pa.array(counts + 1, pa.int64()),
                    pa.array(by_row(hot.astype(np.int64)) + seen, pa.int64()),
                    pa.array(by_row(np.where(hot, base_of[at], 0.0)) + end_base, pa.float64()),
                    pa.array(by_row(np.where(hot, emitted_of[at], 0.0)) + end_emitted, pa.float64()),
                ]
                lists: list[list[bytes]] = [[], [], [], []]
                end = np.zeros(1, np.uint16)
                for a, b in zip(found.offsets[:-1], found.offsets[1:]):
                    lists[0].append(np.concatenate([units[a:b], end]).tobytes())
                    rare = np.flatnonzero(~hot[a:b]) + a
                    keys, first, n = np.unique(found.keys[rare], return_index=True, return_counts=True)
                    lists[1].append(keys.tobytes())
                    lists[2].append(n.astype(np.int32).tobytes())
                    lists[3].append(units[rare][first].tobytes())
                columns += [pa.array(x, pa.binary()) for x in lists]
                kept = [c for k, c in enumerate(part.columns) if k != text_at]
                yield pa.RecordBatch.from_arrays([*kept, *columns], names=names)

    return run


def _block(block: int, whole: bool, data: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([block], pa.int32()), pa.array([whole]), pa.array([data], pa.binary())], names=["block", "whole", "counts"]
    )


def _neighbours(classes: np.ndarray):
    """Counts, by block of units: classes before, classes behind, and the unit itself before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a task reads far fewer than 2**31 tokens
        counts = np.zeros((UNITS, WIDTH), np.int32)

        def add(units: np.ndarray) -> None:
            before = np.concatenate([np.zeros(1, np.int32), units[:-1]])
            for low, key in ((0, units * CLASSES + classes[before]), (CLASSES, before * CLASSES + classes[units])):
                counts[:, low : low + CLASSES] += np.bincount(key, minlength=UNITS * CLASSES).reshape(UNITS, -1)
            counts[:, -1] += np.bincount(units[units == before], minlength=UNITS)

        held, size = [], 0
        for batch in batches:
            for data in batch.column(0):
                held.append(data.as_py())
                size += len(held[-1])
                if size >= TOKENS_AT_ONCE * 2:
                    add(np.frombuffer(b"".join(held), np.uint16).astype(np.int32))
                    held, size = [], 0
        if held:
            add(np.frombuffer(b"".join(held), np.uint16).astype(np.int32))
        for block in range(0, UNITS, BLOCK):
            part = counts[block : block + BLOCK].reshape(-1)
            cells = np.flatnonzero(part).astype(np.int32)
            if len(cells):
                # most cells are empty: places and values of the others
                data = np.stack([cells, part[cells]]).tobytes()
                yield _block(block, False, data)

    classes = classes.astype(np.int32)
    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums runs of equal blocks, one at a time: cells in, whole blocks of int64 out."""
    at, total = None, None

    for batch in batches:
        for block, whole, data in zip(batch.column("block").to_pylist(), batch.column("whole").to_pylist(), batch.column("counts")):
            if block != at:
                if at is not None:
                    yield _block(at, True, total.tobytes())
                at, total = block, np.zeros(min(BLOCK, UNITS - block) * WIDTH, np.int64)
            if whole:
                total += np.frombuffer(data.as_buffer(), np.int64)
            else:
                cells, values = np.frombuffer(data.as_buffer(), np.int32).reshape(2, -1)
                total[cells] += values
    if at is not None:
        yield _block(at, True, total.tobytes())


def neighbour_counts(coded: DataFrame, classes: np.ndarray) -> DataFrame:
    """(block, counts): at most UNITS / BLOCK rows, summed in two steps over all training rows."""
    schema = "block int, whole boolean, counts binary"
    parts = coded.select("__units").mapInArrow(_neighbours(classes), schema)
    salted = parts.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS))).repartition("block", "salt")
    some = salted.sortWithinPartitions("block", "salt").select("block", "whole", "counts").mapInArrow(_summed, schema)
    whole = some.repartition("block").sortWithinPartitions("block").mapInArrow(_summed, schema)
    return shared(whole.select("block", "counts"))


def class_counts(blocks: DataFrame, classes: np.ndarray) -> np.ndarray:
    """CLASSES x CLASSES bigram counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((CLASSES, CLASSES), np.int64)
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = np.frombuffer(data.as_py(), np.int64).reshape(-1, WIDTH)[:, :CLASSES]
                np.add.at(total.T, classes[block : block + len(rows)], rows)
        yield pa.RecordBatch.from_pydict({"counts": pa.array([total.tobytes()], pa.binary())})

    rows = blocks.mapInArrow(run, "counts binary").collect()
    return sum((np.frombuffer(r[0], np.int64).reshape(CLASSES, CLASSES) for r in rows), np.zeros((CLASSES, CLASSES), np.int64))


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def best_classes(counts: np.ndarray, own: np.ndarray, bigrams: np.ndarray) -> np.ndarray:
    """For each unit, the class whose choice gives the class bigrams the highest likelihood.

    ``counts`` are the unit's neighbours, ``own`` its present class; the unit is taken out of that
    class first. Class 0 belongs to the end token alone.
    """
    n = len(own)
    left, right = counts[:, :CLASSES].astype(float), counts[:, CLASSES:-1].astype(float)
    itself, each = counts[:, -1].astype(float), np.arange(n)
    without = np.repeat(bigrams.astype(float)[None], n, axis=0)
    without[each, :, own] -= left
    without[each, own, :] -= right
    without[each, own, own] += itself
    left[each, own] -= itself
    right[each, own] -= itself
    np.maximum(without, 0, out=without)
    base = _xlogx(without)
    diagonal = np.arange(CLASSES)
    gain = (_xlogx(without + left[:, :, None]) - base).sum(axis=1)
    gain += (_xlogx(without + right[:, None, :]) - base).sum(axis=2)
    mid = without[:, diagonal, diagonal]
    gain -= _xlogx(mid + left) + _xlogx(mid + right) - 2 * base[:, diagonal, diagonal]
    gain += _xlogx(mid + left + right + itself[:, None]) - base[:, diagonal, diagonal]
    # the unit's neighbours have it on one side whatever its class; the class has it on the other
    for axis, beside, more in ((2, left, right), (1, right, left)):
        side = without.sum(axis=axis) + beside
        gain -= _xlogx(side + (more.sum(axis=1) + itself)[:, None]) - _xlogx(side)
    gain[:, 0] = -np.inf
    best = gain.argmax(axis=1)
    return np.where(gain[each, best] > gain[each, own] + 1e-9, best, own)


def exchange(blocks: DataFrame, classes: np.ndarray, bigrams: np.ndarray, turn: int) -> np.ndarray:
    """One round of moves, decided in tasks by block; UNITS small numbers come back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts = np.frombuffer(data.as_py(), np.int64).reshape(-1, WIDTH)
                units = np.arange(block, block + len(counts))
                may = (tk.mixed((units + UNITS * turn).astype(np.uint64)) & np.uint64(1)).astype(bool)
                may &= counts.any(axis=1) & (units > 0)
                new = classes[units].copy()
                for chosen in np.array_split(np.flatnonzero(may), max(1, may.sum() // 64)):
                    if len(chosen):
                        new[chosen] = best_classes(counts[chosen], new[chosen], bigrams)
                yield pa.RecordBatch.from_pydict(
                    {"block": pa.array([block], pa.int32()), "classes": pa.array([new.astype(np.int16).tobytes()], pa.binary())}
                )

    moved = classes.copy()
    for row in blocks.mapInArrow(run, "block int, classes binary").collect():
        new = np.frombuffer(row["classes"], np.int16)
        moved[row["block"] : row["block"] + len(new)] = new
    return moved


@dataclass
class Model:
    lexicon: Lexicon
    classes: np.ndarray
    transitions: np.ndarray
    emission_sums: np.ndarray
    unseen: np.ndarray


def first_classes() -> np.ndarray:
    """Units are dealt to the classes in turn, words by falling frequency; the end token alone in 0.

    Classes that all start alike drift apart; starting from similar words instead, half of all units
    would at first crowd into a few classes, as moves of a round don't see each other.
    """
    classes = 1 + np.arange(UNITS) % (CLASSES - 1)
    classes[0] = 0
    return classes


def finished(lex: Lexicon, classes: np.ndarray, bigrams: np.ndarray) -> Model:
    share = (bigrams.sum(axis=0) + 0.5) / (bigrams.sum() + 0.5 * CLASSES)
    transitions = np.log10((bigrams + share) / (bigrams.sum(axis=1, keepdims=True) + 1.0))
    sums = np.bincount(classes, lex.unit_counts, CLASSES) + 0.5
    sums[0] = max(lex.unit_counts[0], 1)
    unseen = np.log10(np.bincount(classes, lex.unit_types, CLASSES) * lex.discount + 0.5)
    return Model(lex, classes, transitions, np.log10(sums), unseen)


def learn(coded: DataFrame, lex: Lexicon, rounds: int = ROUNDS) -> Model:
    """Exchange clustering over the coded training rows."""
    classes = first_classes()
    for turn in range(rounds):
        blocks = neighbour_counts(coded, classes)
        classes = exchange(blocks, classes, class_counts(blocks, classes), turn)
        drop_stage(blocks)
    blocks = neighbour_counts(coded, classes)
    return finished(lex, classes, class_counts(blocks, classes))


def _scored(classes: np.ndarray, transitions: np.ndarray, emission_sums: np.ndarray):
    """Per row: what units alone decide of the score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = []
            for data in batch.column(1):
                own = classes[np.frombuffer(data.as_py(), np.uint16)]
                before = np.concatenate([[0], own[:-1]])
                scores.append(float(transitions[before, own].sum() - emission_sums[own].sum()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["row", "score"])

    return run


def _rare(unseen_of: np.ndarray):
    """The rare words of each row: (row, key, n, log10 of the unseen mass in their class)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.frombuffer(b"".join(x.as_py() for x in batch.column(1)), np.int64)
            n = np.frombuffer(b"".join(x.as_py() for x in batch.column(2)), np.int32)
            units = np.frombuffer(b"".join(x.as_py() for x in batch.column(3)), np.uint16)
            sizes = [len(x.as_py()) // 8 for x in batch.column(1)]
            rows = np.repeat(batch.column(0).to_numpy(), sizes)
            unseen = unseen_of[units]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, (rows, keys, n, unseen))), names=["row", "key", "n", "unseen"])

    return run


def score_documents(docs: DataFrame, held_out: Column, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Learns from the rows that are not held out and scores all: one row per document."""
    marked = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(doc_id), held_out.alias("held_out"), text_or_empty(text).alias("__text")
    )
    training = marked.where("not held_out")
    counts = shared(word_counts(training.select("__text")))
    lex = lexicon(counts, docs.where(~held_out).count())
    slim = marked.drop("__text").schema
    fields = T.StructType([*slim.fields, *T._parse_datatype_string(_CODED).fields])
    coded = shared(marked.mapInArrow(_coded(lex, 3, fields.names), fields))
    model = learn(coded.where("not held_out"), lex)
    wholes = coded.select("row", "__units").mapInArrow(_scored(model.classes, model.transitions, model.emission_sums), "row long, score double")
    rare = coded.select("row", "__rare_keys", "__rare_n", "__rare_units").where(F.octet_length("__rare_keys") > 0)
    rare = rare.mapInArrow(_rare(model.unseen[model.classes].astype(np.float32)), "row long, key long, n int, unseen float")
    tail = counts.select(F.col("key").alias("word"), F.col("n").alias("c"))
    met = rare.join(tail, rare["key"] == tail["word"], "left")
    c, n = F.coalesce("c", F.lit(0)), F.col("n")
    whole = lex.tokens + 0.5 * (lex.distinct + 1)
    zero, none = F.lit(0.0), F.lit(None)
    terms = met.select(
        "row", none.cast(slim[1].dataType).alias(doc_id), none.cast("boolean").alias("held_out"), F.lit(0).cast("long").alias("n_tokens"),
        F.when(c > 0, n).otherwise(0).cast("long").alias("n_known"),
        (n * F.log10((c + 0.5) / whole)).alias("base_score"),
        (n * F.when(c > 0, F.log10(F.greatest(c - lex.discount, F.lit(1e-9)))).otherwise(F.col("unseen").cast("double"))).alias("score"),
    )
    heads = coded.select(
        "row", doc_id, "held_out", F.col("__tokens").alias("n_tokens"), F.col("__known").alias("n_known"),
        F.col("__base").alias("base_score"), F.col("__emitted").alias("score"),
    )
    units = wholes.select(
        "row", none.cast(slim[1].dataType).alias(doc_id), none.cast("boolean").alias("held_out"), F.lit(0).cast("long").alias("n_tokens"),
        F.lit(0).cast("long").alias("n_known"), zero.alias("base_score"), "score",
    )
    summed = heads.union(units).union(terms).groupBy("row").agg(
        F.max(doc_id).alias(doc_id), F.max("held_out").alias("held_out"),
        *[F.sum(x).alias(x) for x in ("n_tokens", "n_known", "base_score", "score")],
    )
    return summed.select(
        doc_id, "held_out", "n_tokens", "n_known", F.lit(lex.tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )


def op2_brown_scores(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return score_documents(docs, in_fold("doc_id", 1))
