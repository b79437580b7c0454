"""Near-duplicate documents by SuperMinHash, banding, exact verification and union-find.

1. Every text becomes its set of word shingles (64-bit keys). Texts with equal sets are one class,
   told by a 128-bit fingerprint; only classes go on, so copies cost nothing further.
2. A class gets a SuperMinHash signature: each shingle offers its registers a random permutation of
   ranks, one rank a step, and stops when no register can still be lowered.
3. Signatures are cut into bands. Of the classes that share a band value, the smallest is the pivot;
   each other class is compared with it on the full sets.
4. Confirmed links give components. Where the classes of one band value still lie in several
   components, those outside the largest are compared with all others, block against block, by their
   signatures: the two likeliest partners of each are confirmed on the full sets. Members of a group
   mostly meet its centre that way. What then still lies in different components is compared once
   more, all pairs whose signatures come near the threshold, on the full sets, inside the tasks. So
   no pair that shares a band value and could join two components stays unseen, and no group is ever
   expanded into rows of pairs: tasks return spanning forests.

With ``REGISTERS`` 128 in bands of 5, a pair of similarity 0.8 shares no band with probability 5e-5.

A hot band value or a hot class is dealt out by ``join_by_hot_key``; comparisons with a popular
pivot are salted. Intermediate tables lie in the shared folder.

Defined results: null texts and texts without words have an empty set, link with nothing and are
kept; texts with fewer words than a shingle have one, the whole sequence; repeated rows and rows with
equal ids are documents of their own in one class; rows without id come last when a component is
named; an empty table gives an empty result; columns named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitledger.joins import join_by_hot_key
from hitledger.llm import textkeys as tk
from hitledger.llm.common import text_or_empty
from hitledger.llm.components import components, forest
from hitledger.stages import shared

REGISTERS, BAND = 128, 5
BANDS = REGISTERS // BAND
#: Bits of a register's random part, below its rank.
FRACTION = 25
SALTS = 64
BLOCK = 256
#: How far below the threshold a signature's estimate may lie: over four standard deviations.
MARGIN = 0.15
#: Partners confirmed for each class and block before all are compared.
PARTNERS = 2
_STEP = 0x9E3779B97F4A7C15


def _step(times: int) -> np.uint64:
    return np.uint64(_STEP * times & (1 << 64) - 1)


def superminhash(offsets: np.ndarray, keys: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """Signatures (rows x registers, uint32) of rows of distinct keys.

    Step j of a key draws the j-th place of the key's own random permutation (Fisher-Yates, made as
    far as needed) and offers it j plus a random fraction. A row is done when all its registers are
    below j: later steps can only offer more.
    """
    rows = len(offsets) - 1
    out = np.full((rows, registers), 0xFFFFFFFF, np.uint32)
    flat = out.reshape(-1)
    row = np.repeat(np.arange(rows), np.diff(offsets))
    order = None
    for j in range(registers):
        if j:
            going = (out >= np.uint32(j << FRACTION)).any(axis=1)[row]
            if not going.any():
                break
            row, keys, order = row[going], keys[going], order[going]
        draw = tk.mixed(keys + _step(j + 1))
        place = (j + (((draw >> np.uint64(32)) * np.uint64(registers - j)) >> np.uint64(32))).astype(np.int64)
        value = np.uint32(j << FRACTION) | (draw & np.uint64((1 << FRACTION) - 1)).astype(np.uint32)
        if not j:
            np.minimum.at(flat, row * registers + place, value)
            going = (out >= np.uint32(1 << FRACTION)).any(axis=1)[row]
            row, keys, place = row[going], keys[going], place[going]
            order = np.broadcast_to(np.arange(registers, dtype=np.uint8), (len(row), registers)).copy()
            each = np.arange(len(row))
            order[each, place], order[:, 0] = order[:, 0], place
            continue
        each = np.arange(len(row))
        chosen = order[each, place]
        order[each, place], order[:, j] = order[:, j], chosen
        np.minimum.at(flat, row * registers + chosen, value)
    return out


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """(rows x BANDS) 64-bit keys; the band's number is part of the key."""
    out = np.zeros((len(signatures), BANDS), np.uint64)
    for b in range(BANDS):
        key = np.full(len(signatures), b + 1, np.uint64)
        for k in range(BAND):
            key = tk.mixed(key * _step(1) + signatures[:, b * BAND + k])
        out[:, b] = key
    return out


def sets_of(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    return tk.distinct_by_row(*tk.shingles(tk.words(column), size))


_FOUND = "__n long, __class string, __bands array<bigint>, __sig binary"


def _signed(size: int, text_at: int, names: list[str]):
    """Adds number, fingerprint, band keys and 16-bit register digests of each row's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            column = whole.column(text_at)
            for start, stop in tk.slices(column, 2 << 20):
                offsets, keys = sets_of(column.slice(start, stop - start), size)
                n = np.diff(offsets)
                sums = []
                for seed in (1, 2):
                    total = np.concatenate([[np.uint64(0)], np.cumsum(tk.mixed(keys + _step(seed << 40)))])
                    sums.append(total[offsets[1:]] - total[offsets[:-1]])
                signatures = superminhash(offsets, keys)
                bands = band_keys(signatures)
                digests = (tk.mixed(signatures.astype(np.uint64)) & np.uint64(0xFFFF)).astype(np.uint16)
                part = whole.slice(start, stop - start)
                added = [
                    pa.array(n, pa.int64()),
                    pa.array([f"{a:016x}{b:016x}" for a, b in zip(*sums)], pa.string()),
                    pa.array(list(bands.view(np.int64)), pa.list_(pa.int64())),
                    pa.array([x.tobytes() if k else b"" for x, k in zip(digests, n)], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays([*part.columns, *added], names=names)

    return run


def _confirmed(size: int, percent: int):
    """Compares runs of texts with the pivot before them: (a, b) where the full sets are near."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot, own = None, None
        for batch in batches:
            left, right = [], []
            texts = batch.column(3)
            for start, stop in tk.slices(texts, 4 << 20):
                offsets, keys = sets_of(texts.slice(start, stop - start), size)
                pivots = batch.column(0).slice(start, stop - start).to_pylist()
                members = batch.column(2).slice(start, stop - start).to_pylist()
                for i, (p, member) in enumerate(zip(pivots, members)):
                    mine = keys[offsets[i] : offsets[i + 1]]
                    if member == p:
                        pivot, own = p, mine.copy()
                    elif p == pivot:
                        at = np.searchsorted(own, mine)
                        both = int((own[np.minimum(at, len(own) - 1)] == mine).sum())
                        if 100 * both >= percent * (len(own) + len(mine) - both):
                            left.append(member)
                            right.append(p)
                    else:
                        raise AssertionError("a pivot's text is missing")
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    return run


def confirm(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The (a, b) pairs whose shingle sets reach the similarity, as a table.

    b's text is sent once for each of up to ``SALTS`` groups of its partners, so that a popular b is
    spread; a task holds one set of b at a time.
    """
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("a"), F.lit(SALTS)))
    asked = salted.select("b", "salt").distinct()
    members = salted.join(texts, salted["a"] == texts["cid"]).select("b", "salt", "a", "text")
    pivots = asked.join(texts, asked["b"] == texts["cid"]).select("b", "salt", F.col("b").alias("a"), "text")
    rows = members.union(pivots).repartition("b", "salt")
    rows = rows.sortWithinPartitions("b", "salt", F.when(F.col("a") == F.col("b"), 0).otherwise(1))
    return shared(rows.mapInArrow(_confirmed(size, percent), "a long, b long"))


def _groups(batches: Iterator[pa.RecordBatch], width: int = 3) -> Iterator[list[tuple]]:
    """Runs of rows that agree in their first columns, across batches."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and held[-1][:width] != row[:width]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _near(rows: list[tuple], least: int, percent: int) -> Iterator[tuple[tuple, list[tuple], np.ndarray]]:
    """For each asking class of one block pair: the others it may be near to, and how they agree.

    Those have another component, a size that allows the similarity, and digests that agree in
    ``least`` registers. Rows: key, i, j, role, cid, part, n, signature, ...
    """
    asking, others = [r for r in rows if r[3] == 0], [r for r in rows if r[3] == 1]
    if not asking or not others:
        return
    signatures = np.frombuffer(b"".join(r[7] for r in others), np.uint16).reshape(len(others), -1)
    parts, sizes = (np.array([r[k] for r in others]) for k in (5, 6))
    for own in asking:
        agree = (signatures == np.frombuffer(own[7], np.uint16)).sum(axis=1)
        fits = (parts != own[5]) & (100 * np.minimum(sizes, own[6]) >= percent * np.maximum(sizes, own[6]))
        near = np.flatnonzero(fits & (agree >= least))
        if len(near):
            yield own, [others[k] for k in near], agree[near]


def _likeliest(least: int, percent: int):
    """(a, b) of each asking class and its PARTNERS likeliest partners elsewhere."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: set[tuple[int, int]] = set()
        for rows in _groups(batches):
            for own, others, agree in _near(rows, least, percent):
                ids = np.array([r[4] for r in others])
                for x in ids[np.lexsort((ids, -agree))[:PARTNERS]]:
                    found.add((max(int(x), own[4]), min(int(x), own[4])))
            if len(found) > 50_000:
                yield _pairs(found)
                found = set()
        yield _pairs(found)

    return run


def _remaining(least: int, percent: int, size: int):
    """Links between components, as forests: all near pairs of a block pair on their full sets.

    A pair that shares several bands is compared in the first of them alone. Rows end with the band
    keys and the text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches):
            sets: dict[int, np.ndarray] = {}

            def set_of(row: tuple) -> np.ndarray:
                if row[4] not in sets:
                    sets[row[4]] = sets_of(pa.array([row[9]], pa.string()), size)[1]
                return sets[row[4]]

            links = []
            for own, others, _ in _near(rows, least, percent):
                bands = np.array(own[8])
                shared_bands = np.array([r[8] for r in others]) == bands
                for other, same in zip(others, shared_bands):
                    if bands[same.argmax()] != own[0]:
                        continue
                    a, b = set_of(own), set_of(other)
                    at = np.minimum(np.searchsorted(a, b), len(a) - 1)
                    both = int((a[at] == b).sum())
                    if 100 * both >= percent * (len(a) + len(b) - both):
                        links.append((own[4], other[4]))
            if links:
                yield _pairs(set(forest(links)))

    return run


def _pairs(found: set[tuple[int, int]]) -> pa.RecordBatch:
    left, right = zip(*found) if found else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])


def block_pairs(members: DataFrame, labels: DataFrame) -> DataFrame | None:
    """(key, i, j, role, cid, part): the blocks in which classes of one band value meet.

    Only of band values whose classes lie in several components; None if there is none. The classes
    outside the largest component (role 0) face all classes (role 1), in blocks of about ``BLOCK``:
    what one task gets is bounded, and what is sent grows with those outside.
    """
    at = members.join(labels, members["cid"] == labels["node"], "left").select(
        "key", "cid", F.coalesce("component", "cid").alias("part")
    )
    at = shared(at)
    sizes = at.groupBy("key", "part").agg(F.count("*").alias("n"))
    mixed = sizes.groupBy("key").agg(
        F.max(F.struct(F.col("n"), (-F.col("part")).alias("minus"))).alias("most"),
        F.sum("n").alias("n"),
        F.count("*").alias("parts"),
    )
    mixed = shared(
        mixed.where("parts > 1").select(
            "key", "n", (-F.col("most")["minus"]).alias("main"), (F.col("n") - F.col("most")["n"]).alias("outside")
        )
    )
    if mixed.isEmpty():
        return None
    rows = join_by_hot_key(at, mixed, "key", "n", "inner")
    few, all_of = F.ceil(F.col("outside") / BLOCK), F.ceil(F.col("n") / BLOCK)
    number = F.xxhash64("cid")
    asking = rows.where("part <> main").select(
        "key", F.pmod(number, few).alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), all_of - 1)).alias("j"),
        F.lit(0).alias("role"), "cid", "part",
    )
    others = rows.select(
        "key", F.explode(F.sequence(F.lit(0).cast("long"), few - 1)).alias("i"), F.pmod(number, all_of).alias("j"),
        F.lit(1).alias("role"), "cid", "part",
    )
    return asking.union(others)


def met(blocks: DataFrame, facts: DataFrame, task) -> DataFrame:
    """Runs ``task`` over the block pairs, each row with its class's ``facts``."""
    rows = blocks.join(facts, "cid").select(*blocks.columns, *[c for c in facts.columns if c != "cid"])
    rows = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return shared(rows.mapInArrow(task, "a long, b long").distinct())


def near_duplicates(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80
) -> DataFrame:
    """``docs`` with ``n_shingles``, ``component_id``, ``kept``, and ``first`` for one row a component.

    ``component_id`` is the smallest id linked by documents of at least ``percent`` similarity.
    """
    docs = docs.drop("n_shingles", "component_id", "kept", "first")
    given = docs.withColumns({"__row": F.monotonically_increasing_id(), "__text": text_or_empty(text)})
    fields = T.StructType([*given.schema.fields, *T._parse_datatype_string(_FOUND).fields])
    signed = given.mapInArrow(_signed(size, len(docs.columns) + 1, fields.names), fields)
    rows = shared(signed.withColumn("__text", F.when(F.col("__n") > 0, F.col("__text"))))
    some = rows.where("__n > 0")
    best = F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), F.col("__row").alias("row"))
    classes = shared(
        some.groupBy("__class").agg(F.min(best).alias("best"), F.count("*").alias("__copies"), F.min("__row").alias("cid"))
    )
    chosen = classes.select("cid")
    signatures = shared(
        some.select(F.col("__row").alias("cid"), "__n", "__bands", "__sig").join(chosen, "cid", "left_semi")
    )
    bands = signatures.select("cid", F.explode("__bands").alias("key"))
    repeated = bands.groupBy("key").agg(F.min("cid").alias("pivot"), F.count("*").alias("n")).where("n > 1")
    members = shared(join_by_hot_key(bands, shared(repeated), "key", "n", "inner"))
    pairs = shared(members.where("cid <> pivot").select(F.col("cid").alias("a"), F.col("pivot").alias("b")).distinct())
    nodes = pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct()
    # the ids of candidates grow with the corpus, so they are never sent to every task
    texts = some.select(F.col("__row").alias("cid"), F.col("__text").alias("text"))
    texts = shared(texts.join(nodes.hint("merge"), "cid", "left_semi"))
    links = confirm(pairs, texts, size, percent)
    labels = components(links)
    least = int(REGISTERS * (percent / 100 - MARGIN))
    # in a group of two, the pivot was compared with the other
    meeting, facts = members.where("n > 2").select("key", "cid"), signatures.select("cid", "__n", "__sig")
    blocks = block_pairs(meeting, labels)
    if blocks is not None:
        found = met(blocks, facts, _likeliest(least, percent)).join(pairs, ["a", "b"], "left_anti")
        links = links.union(confirm(shared(found), texts, size, percent))
        labels = components(links)
        blocks = block_pairs(meeting, labels)
    if blocks is not None:
        whole = signatures.select("cid", "__n", "__sig", "__bands").join(texts, "cid")
        links = links.union(met(blocks, whole, _remaining(least, percent, size)))
        labels = components(links)
    named = classes.join(labels, classes["cid"] == labels["node"], "left").select(
        "__class", "__copies", "best", F.coalesce("component", "cid").alias("component")
    )
    named = shared(named)
    firsts = named.groupBy("component").agg(F.min("best").alias("__best"), F.count("*").alias("n"))
    known = join_by_hot_key(named.drop("best"), shared(firsts), "component", "n", "left")
    known = shared(known.select("__class", "__copies", "__best"))
    slim = join_by_hot_key(rows.drop("__text", "__bands", "__sig"), known, "__class", "__copies", "left")
    component = F.when(F.col("__n") > 0, F.col("__best")["id"]).otherwise(F.col(doc_id))
    return slim.select(
        *docs.columns,
        F.col("__n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col(doc_id) == component, F.col("__n") == 0, F.lit(False)).alias("kept"),
        ((F.col("__n") == 0) | (F.col("__best")["row"] == F.col("__row"))).alias("first"),
    )


def op9_near_duplicates(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = near_duplicates(docs, size=4, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")
