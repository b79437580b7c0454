"""Near-duplicate vectors by NN-descent, with exact completion of dense groups.

1. Equal vectors of a label are one class. Only classes are searched.
2. First neighbours: in ``TABLES`` orders by random-hyperplane codes each class meets the ``REACH``
   next ones of its label. The best ``K`` make its neighbour list.
3. NN-descent rounds: around every class, its neighbours (and those whose neighbour it is) meet each
   other; pairs in which one is new to the list are compared, and who beats the worst of a
   list enters it. A class in very many lists is met in chunks, so no group grows with the data.
4. A list full of links is saturated: there may be more than it holds. It is enlarged to the whole
   component it lies in, whose members are compared block against block; what a task holds is
   bounded, and a block pair returns link counts and a spanning forest, not pairs.
5. Enlarged components of one label may link where no list had room. Their members are covered by
   cells, a leader and all within ``CELL`` of it; leaders are compared block against block, and
   cells of two components close enough for a link (by the angles) member by member. So links
   between enlarged components are exact; the leaders' comparisons grow with the square of the
   cells of a label.
6. Fresh hyperplane orders search for links on their own, and what they find is added. The share of
   it that was known already estimates the recall (capture and recapture); fresh orders go on until
   at least ``ENOUGH`` was known, ``SEARCHES`` times at most.
7. ``AUDIT`` classes with saturated lists, and as many others, are compared with all of their label by
   brute force: a number that doesn't grow, so the comparisons grow with the rows. If they hold links
   enough to tell (``FEW``) and less than ``RECALL`` of them is known, lists double and everything goes
   on, ``ATTEMPTS`` times at most; what is known then is returned, with a warning that states it.
   Comparing all pairs of a label is an option (``exhaustive``) that nothing turns on by itself.
8. Links are those of at least ``LEAST`` in double precision. Union-find gives components.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and rows
without label, link with nothing; vectors of different length don't compare; repeated rows are
vectors of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hitledger.joins import join_by_hot_key
from hitledger.llm.components import components
from hitledger.stages import drop_stage, shared

_LOG = logging.getLogger(__name__)
LEAST = 0.98
#: What single precision may lose; search keeps pairs down to LEAST - SLACK.
SLACK = 1e-4
K, TABLES, REACH, ROUNDS = 8, 4, 6, 4
CHUNK = 48
AUDIT, RECALL, ATTEMPTS = 1024, 0.99, 3
SEARCHES, ENOUGH, FEW = 8, 0.999, 16
BLOCK = 512
CELL = 0.995


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, vec_id, label, embedding) -> the same with unit vectors as bytes, empty if invalid."""
    for batch in batches:
        data = []
        for vector in batch.column(3):
            values = vector.values
            unit = b""
            if values is not None and len(values) and not values.null_count:
                x = values.to_numpy(zero_copy_only=False).astype(np.float64)
                # scaled first, so that squares neither vanish nor overflow
                top = np.abs(x).max()
                if np.isfinite(x).all() and top > 0:
                    x = x / top
                    unit = (x / np.sqrt((x * x).sum())).tobytes()
            data.append(unit)
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(data, pa.binary())], names=["row", "id", "label", "unit"])


def _matrix(column: pa.Array, dtype=np.float32) -> np.ndarray:
    """Unit vectors of equal length."""
    data = np.frombuffer(b"".join(x.as_py() for x in column), np.float64)
    return data.reshape(len(column), -1).astype(dtype)


def _codes(seed: int, bits: int):
    """Per table and vector: (turn, block, code, cid, unit); the code tells sides of hyperplanes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            lengths = np.array([len(x.as_py()) // 8 for x in batch.column("unit")])
            for length in np.unique(lengths):
                part = batch.filter(pa.array(lengths == length))
                vectors = _matrix(part.column("unit"), np.float64)
                for turn in range(TABLES):
                    if (turn, length) not in planes:
                        rng = np.random.default_rng([seed, turn, int(length)])
                        planes[turn, length] = rng.standard_normal((int(length), bits))
                    sides = vectors @ planes[turn, length] > 0
                    code = sides @ (1 << np.arange(bits, dtype=np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(part), turn, np.int32)), part.column("block"), pa.array(code), part.column("cid"), part.column("unit")],
                        names=["turn", "block", "code", "cid", "unit"],
                    )

    return run


def _edges(a: np.ndarray, b: np.ndarray, sim: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(a.astype(np.int64)), pa.array(b.astype(np.int64)), pa.array(sim.astype(np.float32))], names=["v", "u", "sim"]
    )


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compares each row with the REACH next ones of its table and block, batch by batch."""
    for batch in batches:
        group = np.array([f"{t}/{b}" for t, b in zip(batch.column("turn").to_pylist(), batch.column("block").to_pylist())])
        ids = batch.column("cid").to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.zeros(0, int)
        for low, high in zip(starts, [*starts[1:], len(group)]):
            vectors = _matrix(batch.column("unit").slice(low, high - low))
            own = ids[low:high]
            for step in range(1, min(REACH, len(own) - 1) + 1):
                sim = np.einsum("ij,ij->i", vectors[:-step], vectors[step:])
                yield _edges(np.r_[own[:-step], own[step:]], np.r_[own[step:], own[:-step]], np.r_[sim, sim])


def first_edges(classes: DataFrame, seed: int, bits: int) -> DataFrame:
    rows = classes.select("cid", "block", "unit").mapInArrow(
        _codes(seed, bits), "turn int, block string, code long, cid long, unit binary"
    )
    order = ["turn", "block", "code", "cid"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_in_order, "v long, u long, sim float")


def best_lists(edges: DataFrame, k: int) -> DataFrame:
    """(v, u, sim, fresh, worst) of the k best neighbours; ``worst`` is what a new one must beat."""
    once = edges.groupBy("v", "u").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    ranked = once.withColumn("place", F.row_number().over(Window.partitionBy("v").orderBy(F.desc("sim"), "u")))
    ranked = ranked.where(F.col("place") <= k)
    full = F.count("*").over(Window.partitionBy("v")) >= k
    return shared(
        ranked.withColumn(
            "worst", F.when(full, F.min("sim").over(Window.partitionBy("v"))).otherwise(F.lit(-2.0).cast("float"))
        ).drop("place")
    )


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of (x, chunk): all pairs of the members of which one is fresh, if they improve a list."""

    def compare(rows: list[tuple]):
        if len(rows) < 2:
            return None
        ids = np.array([r[2] for r in rows])
        fresh = np.array([r[3] for r in rows])
        vectors = np.frombuffer(b"".join(r[5] for r in rows), np.float64).reshape(len(rows), -1).astype(np.float32)
        sim = vectors @ vectors.T
        worst = np.array([r[4] for r in rows], np.float32)
        use = (sim > worst[:, None]) & (fresh[:, None] | fresh[None, :]) & (ids[:, None] != ids[None, :])
        a, b = np.nonzero(use)
        return ids[a], ids[b], sim[a, b]

    held: list[tuple] = []
    for batch in batches:
        found = []
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and held[-1][:2] != row[:2]:
                found.append(compare(held))
                held = []
            held.append(row)
        found = [f for f in found if f is not None]
        if found:
            yield _edges(*(np.concatenate(x) for x in zip(*found)))
    last = compare(held)
    if last is not None:
        yield _edges(*last)


def descend(lists: DataFrame, classes: DataFrame, k: int) -> tuple[DataFrame, int]:
    """One round: (better lists, number of entries that changed)."""
    around = lists.select(F.col("v").alias("x"), F.col("u").alias("y"), "fresh").union(
        lists.select(F.col("u").alias("x"), F.col("v").alias("y"), "fresh")
    )
    popular = lists.groupBy(F.col("u").alias("x")).agg((F.count("*") + k).alias("n")).where(F.col("n") > CHUNK)
    chunked = join_by_hot_key(around, shared(popular), "x", "n", "left")
    chunked = chunked.withColumn("chunk", F.pmod(F.xxhash64("y"), F.coalesce(F.ceil(F.col("n") / CHUNK), F.lit(1))))
    chunked = chunked.groupBy("x", "chunk", "y").agg(F.max("fresh").alias("fresh"))
    worst = lists.groupBy("v").agg(F.first("worst").alias("worst"))
    known = classes.select("cid", "unit").join(worst, F.col("cid") == F.col("v")).select("cid", "worst", "unit")
    rows = chunked.join(known, chunked["y"] == known["cid"]).select("x", "chunk", "y", "fresh", "worst", "unit")
    rows = rows.repartition("x", "chunk").sortWithinPartitions("x", "chunk")
    found = rows.mapInArrow(_met, "v long, u long, sim float").withColumn("fresh", F.lit(True))
    old = lists.select("v", "u", "sim", F.lit(False).alias("fresh"))
    better = best_lists(old.union(found), k)
    return better, better.where("fresh").count()


def _block_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of (component, i, j): links of the asking members to the others, and a spanning forest.

    Rows out: (a, b, n): n links of a found here (b null), or an edge of the forest (n null).
    """

    def compare(rows: list[tuple]):
        asking, others = [r for r in rows if r[3] == 0], [r for r in rows if r[3] == 1]
        if not asking or not others:
            return
        a, b = np.array([r[4] for r in asking]), np.array([r[4] for r in others])
        left = np.frombuffer(b"".join(r[6] for r in asking), np.float64).reshape(len(a), -1)
        right = np.frombuffer(b"".join(r[6] for r in others), np.float64).reshape(len(b), -1)
        near = (left @ right.T >= LEAST) & (a[:, None] != b[None, :])
        n = near @ np.array([r[5] for r in others], np.int64)
        yield from ((int(x), None, int(k)) for x, k in zip(a, n) if k)
        # labels settle to the smallest node linked within the block pair
        low_a, low_b = a.copy(), b.copy()
        top = np.iinfo(np.int64).max
        while True:
            next_b = np.minimum(low_b, np.where(near, low_a[:, None], top).min(axis=0))
            next_a = np.minimum(low_a, np.where(near, next_b[None, :], top).min(axis=1))
            if (next_a == low_a).all() and (next_b == low_b).all():
                break
            low_a, low_b = next_a, next_b
        for own, low in ((a, low_a), (b, low_b)):
            yield from ((int(x), int(y), None) for x, y in zip(own, low) if x != y)

    def out(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b", "n"])

    held: list[tuple] = []
    for batch in batches:
        found: list[tuple] = []
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and held[-1][:3] != row[:3]:
                found += compare(held)
                held = []
            held.append(row)
        yield out(found)
    yield out(list(compare(held)))


def block_links(asking: DataFrame, others: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b, n) rows of ``_block_links`` for ``asking`` and ``others``, both (cid, component)."""
    sizes = asking.groupBy("component").agg(F.count("*").alias("asked"))
    sizes = shared(sizes.join(others.groupBy("component").agg(F.count("*").alias("size")), "component"))

    def dealt(rows: DataFrame, role: int, own: str, other: str) -> DataFrame:
        known = join_by_hot_key(rows.select("component", "cid"), sizes, "component", own, "inner")
        places = {
            own: F.pmod(F.xxhash64("cid"), F.ceil(F.col(own) / BLOCK)),
            other: F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col(other) / BLOCK) - 1)),
        }
        return known.select(
            "component", places["asked"].alias("i"), places["size"].alias("j"), F.lit(role).alias("role"), "cid"
        )

    rows = dealt(asking, 0, "asked", "size").union(dealt(others, 1, "size", "asked"))
    return _compared(rows, classes)


def _compared(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """``_block_links`` of (component, i, j, role, cid)."""
    rows = rows.join(classes.select("cid", "copies", "unit"), "cid")
    rows = rows.select("component", "i", "j", "role", "cid", "copies", "unit")
    rows = rows.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j")
    return shared(rows.mapInArrow(_block_links, "a long, b long, n long"))


def _runs(batches: Iterator[pa.RecordBatch], key: int) -> Iterator[list[tuple]]:
    """Runs of rows that agree in their first ``key`` columns."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and held[-1][:key] != row[:key]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of (component, i): each member's cell, named by its leader, and the cell's angle."""
    for rows in _runs(batches, 2):
        ids = np.array([r[2] for r in rows])
        vectors = np.frombuffer(b"".join(r[3] for r in rows), np.float64).reshape(len(rows), -1)
        cell, angle, left = np.zeros(len(rows), np.int64), np.zeros(len(rows)), np.arange(len(rows))
        while len(left):
            sim = vectors[left] @ vectors[left[0]]
            near = sim >= CELL
            near[0] = True
            cell[left[near]] = ids[left[0]]
            angle[left[near]] = np.arccos(np.clip(sim[near].min(), -1, 1))
            left = left[~near]
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(cell), pa.array(angle)], names=["cid", "cell", "angle"])


def _near_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of (block, i, j): pairs of cells of two components whose members may link."""
    for rows in _runs(batches, 3):
        asking, others = [r for r in rows if r[3] == 0], [r for r in rows if r[3] == 1]
        if not asking or not others:
            continue
        left, right = (np.frombuffer(b"".join(r[7] for r in x), np.float64).reshape(len(x), -1) for x in (asking, others))
        (own, a, ra), (other, b, rb) = ([np.array([r[k] for r in x]) for k in (4, 5, 6)] for x in (asking, others))
        most = np.arccos(LEAST) + ra[:, None] + rb[None, :] + SLACK
        near = (np.arccos(np.clip(left @ right.T, -1, 1)) <= most) & (own[:, None] != other[None, :])
        x, y = np.nonzero(near)
        yield pa.RecordBatch.from_arrays([pa.array(a[x]), pa.array(b[y])], names=["x", "y"])


def bridge_links(members: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b, n) rows of ``_block_links`` between the (cid, component) members of different components."""
    placed = members.select("cid", "component").join(classes.select("cid", "block", "unit"), "cid")
    alone = placed.groupBy("block").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    placed = placed.join(alone.where("low < high").select("block"), "block", "left_semi")
    counted = shared(placed.groupBy("component").agg(F.count("*").alias("size")))
    dealt = join_by_hot_key(placed.select("component", "cid", "unit"), counted, "component", "size", "inner")
    dealt = dealt.select("component", F.pmod(F.xxhash64("cid"), F.ceil(F.col("size") / BLOCK)).alias("i"), "cid", "unit")
    dealt = dealt.repartition("component", "i").sortWithinPartitions("component", "i")
    cells = shared(dealt.mapInArrow(_cells, "cid long, cell long, angle double"))
    leaders = cells.where("cid = cell").select("cell", "angle").join(
        members.select(F.col("cid").alias("cell"), "component"), "cell"
    ).join(classes.select(F.col("cid").alias("cell"), "block", "unit"), "cell")
    leaders = shared(leaders)
    sizes = shared(leaders.groupBy("block").agg(F.count("*").alias("size")))
    known = join_by_hot_key(leaders, sizes, "block", "size", "inner")
    few = F.ceil(F.col("size") / BLOCK)
    own = F.pmod(F.xxhash64("cell"), few)
    every = F.explode(F.sequence(F.lit(0).cast("long"), few - 1))
    rest = ["component", "cell", "angle", "unit"]
    rows = known.select("block", own.alias("i"), every.alias("j"), F.lit(0).alias("role"), *rest).union(
        known.select("block", every.alias("i"), own.alias("j"), F.lit(1).alias("role"), *rest)
    )
    rows = rows.repartition("block", "i", "j").sortWithinPartitions("block", "i", "j")
    pairs = shared(rows.mapInArrow(_near_cells, "x long, y long"))
    inside = cells.select("cid", "cell")
    sides = [
        pairs.join(inside, pairs[side] == inside["cell"]).select(
            F.lit(0).alias("component"), F.col("x").alias("i"), F.col("y").alias("j"), F.lit(role).alias("role"), "cid"
        )
        for role, side in enumerate(("x", "y"))
    ]
    return _compared(sides[0].union(sides[1]), classes)


def completed(lists: DataFrame, confirmed: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(a, n) link counts and (a, b) edges, after components with saturated lists are compared whole."""
    grouped = components(confirmed.select(F.col("v").alias("a"), F.col("u").alias("b")))
    full = saturated(lists)
    dense = grouped.join(full, grouped["node"] == full["v"], "left_semi").select("component").distinct()
    sizes = grouped.groupBy("component").agg(F.count("*").alias("size")).join(dense, "component", "left_semi")
    members = join_by_hot_key(grouped, shared(sizes), "component", "size", "inner")
    members = shared(members.select(F.col("node").alias("cid"), "component"))
    whole = block_links(members, members, classes).union(bridge_links(members, classes))
    both = confirmed.union(confirmed.select("u", "v"))
    loose = both.join(members.select(F.col("cid").alias("v")), "v", "left_anti")
    counts = (
        loose.join(classes.select(F.col("cid").alias("u"), "copies"), "u")
        .select(F.col("v").alias("a"), F.col("copies").alias("n"))
        .union(whole.where("n is not null").select("a", "n"))
        .groupBy("a").agg(F.sum("n").alias("n"))
    )
    edges = confirmed.select(F.col("v").alias("a"), F.col("u").alias("b")).union(whole.where("b is not null").select("a", "b"))
    return shared(counts), edges


def saturated(lists: DataFrame) -> DataFrame:
    return lists.where(F.col("worst") >= LEAST - SLACK).select("v").distinct()


@dataclass(frozen=True)
class Audit:
    """Links of drawn classes found by brute force, and how many of them are known."""

    links: int
    known: int

    def share(self) -> float:
        return self.known / self.links if self.links else 1.0

    def interval(self) -> tuple[float, float]:
        """95 percent interval of the recall (Wilson), as if links were drawn one by one."""
        if not self.links:
            return 0.0, 1.0
        z, n, p = 1.96, self.links, min(1.0, self.share())
        middle, width = p + z * z / (2 * n), z * np.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
        return float((middle - width) / (1 + z * z / n)), float((middle + width) / (1 + z * z / n))

    def failed(self) -> bool:
        return self.links >= FEW and self.share() < RECALL


def audit(counts: DataFrame, lists: DataFrame, classes: DataFrame) -> list[Audit]:
    """AUDIT classes with saturated lists, then AUDIT others, against all of their label."""
    everyone = classes.select("cid", F.col("block").alias("component"))
    full = saturated(lists).select(F.col("v").alias("cid"))
    done = []
    for how in ("left_semi", "left_anti"):
        # hashed with a word, so that the draw says nothing about blocks
        kind = everyone.join(full, "cid", how).orderBy(F.xxhash64("cid", F.lit("audit")), "cid")
        drawn = shared(kind.limit(AUDIT))
        links = block_links(drawn, everyone, classes)
        true = links.where("n is not null").groupBy("a").agg(F.sum("n").alias("true"))
        row = true.join(counts, "a", "left").agg(F.coalesce(F.sum("true"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
        done.append(Audit(int(row[0]), int(row[1])))
        drop_stage(links)
        drop_stage(drawn)
    return done


def confirmed_links(links: DataFrame, classes: DataFrame) -> DataFrame:
    """The (v, u) that are near in double precision."""
    joined = links.join(classes.select(F.col("cid").alias("v"), F.col("unit").alias("x")), "v")
    joined = joined.join(classes.select(F.col("cid").alias("u"), F.col("unit").alias("y")), "u")
    return shared(joined.select("v", "u", "x", "y").mapInArrow(_confirm, "v long, u long"))


def near_pairs(edges: DataFrame) -> DataFrame:
    near = edges.where(F.col("sim") >= LEAST - SLACK)
    return near.select(F.least("v", "u").alias("v"), F.greatest("v", "u").alias("u")).distinct()


def searched(confirmed: DataFrame, lists: DataFrame, classes: DataFrame, seed: int, bits: int) -> DataFrame:
    """``confirmed`` and what fresh orders find, until they find next to nothing new.

    Pairs of which both lists are saturated join components but don't count for the estimate:
    the links inside such components are found by comparing them whole.
    """
    full = saturated(lists)
    for turn in range(SEARCHES):
        pairs = shared(near_pairs(first_edges(classes, seed + turn, bits)))
        new = confirmed_links(pairs.join(confirmed, ["v", "u"], "left_anti"), classes)
        room = lambda rows: rows.join(full, "v", "left_semi").join(full.withColumnRenamed("v", "u"), "u", "left_semi")
        n_known = pairs.join(confirmed, ["v", "u"], "left_semi").count()
        n_new, n_inside = new.count(), room(new).count()
        drop_stage(pairs)
        if n_new:
            both = shared(confirmed.union(new))
            drop_stage(confirmed)
            confirmed = both
        drop_stage(new)
        if n_new - n_inside <= (1 - ENOUGH) * (n_known + n_new):
            break
    return confirmed


def all_links(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(a, n) link counts and (a, b) edges from all pairs of every label."""
    everyone = classes.select("cid", F.col("block").alias("component"))
    whole = block_links(everyone, everyone, classes)
    return whole.where("n is not null").groupBy("a").agg(F.sum("n").alias("n")), whole.where("b is not null").select("a", "b")


def near_links(classes: DataFrame) -> tuple[DataFrame, DataFrame, list[Audit]]:
    """(a, n) link counts, (a, b) edges and the last audit."""
    n = classes.count()
    bits = max(6, min(24, n.bit_length() - 3))
    k, lists, extra = K, None, None
    for attempt in range(ATTEMPTS):
        edges = shared(first_edges(classes, attempt, bits))
        start = edges.withColumn("fresh", F.lit(True))
        if lists is not None:
            start = start.union(lists.select("v", "u", "sim", "fresh"))
        # pairs met in the first orders count as well, though a full list may have dropped them
        near = near_pairs(edges)
        extra = shared(near if extra is None else extra.union(near).distinct())
        lists, before = best_lists(start, k), lists
        drop_stage(edges)
        for _ in range(ROUNDS):
            if before is not None:
                drop_stage(before)
            before = lists
            lists, changed = descend(lists, classes, k)
            if changed <= 0.002 * n * k:
                break
        confirmed = confirmed_links(near_pairs(lists).union(extra).distinct(), classes)
        confirmed = searched(confirmed, lists, classes, 1000 * (attempt + 1), bits)
        counts, linked = completed(lists, confirmed, classes)
        audits = audit(counts, lists, classes)
        if not any(a.failed() for a in audits):
            return counts, linked, audits
        extra, k = confirmed, 2 * k
    for kind, found in zip(("saturated", "other"), audits):
        low, high = found.interval()
        _LOG.warning("%s classes: %d of %d drawn links known, recall %.3f to %.3f", kind, found.known, found.links, low, high)
    return counts, linked, audits


def near_vectors(
    vectors: DataFrame, *, vec_id: str = "vec_id", label: str = "label", embedding: str = "embedding", exhaustive: bool = False
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    ``exhaustive`` compares all pairs of every label instead of searching; for small labels.
    """
    given = vectors.select(
        F.monotonically_increasing_id().alias("row"), F.col(vec_id).cast("long").alias("id"),
        F.col(label).cast("string").alias("label"), F.col(embedding).cast("array<double>").alias("embedding"),
    )
    rows = shared(given.mapInArrow(_units, "row long, id long, label string, unit binary"))
    some = rows.where("label is not null and octet_length(unit) > 0").withColumn(
        "block", F.concat_ws(":", F.octet_length("unit").cast("string"), "label")
    )
    classes = shared(
        some.groupBy("block", "unit").agg(F.min("row").alias("cid"), F.count("*").alias("copies"), F.min("id").alias("least"))
    )
    counts, edges = all_links(classes) if exhaustive else near_links(classes)[:2]
    labels = components(edges)
    named = classes.join(counts, classes["cid"] == counts["a"], "left").join(labels, F.col("cid") == labels["node"], "left")
    named = shared(
        named.select(
            "block", "unit", "copies", "least", F.coalesce("component", "cid").alias("component"),
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    firsts = named.groupBy("component").agg(F.min("least").alias("first"), F.count("*").alias("n"))
    known = join_by_hot_key(named, shared(firsts), "component", "n", "left")
    key = F.sha2(F.concat(F.col("block").cast("binary"), F.lit(b"\x00"), F.col("unit")), 256)
    known = shared(known.select(key.alias("key"), "copies", "first", "n_links"))
    # vectors that can't link have no key
    keyed = rows.withColumn("block", F.concat_ws(":", F.octet_length("unit").cast("string"), "label"))
    linkable = F.col("label").isNotNull() & (F.octet_length("unit") > 0)
    keyed = keyed.select("id", F.when(linkable, key).alias("key"))
    done = join_by_hot_key(keyed, known, "key", "copies", "left")
    component = F.coalesce("first", "id")
    return done.select(
        F.col("id").alias(vec_id),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(v, u, x, y) -> (v, u) where the unit vectors x and y are near in double precision."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = np.array([len(x.as_py()) for x in batch.column("x")])
        for length in np.unique(lengths):
            part = batch.filter(pa.array(lengths == length))
            x, y = _matrix(part.column("x"), np.float64), _matrix(part.column("y"), np.float64)
            near = part.filter(pa.array(np.einsum("ij,ij->i", x, y) >= LEAST))
            yield pa.RecordBatch.from_arrays([near.column("v"), near.column("u")], names=["v", "u"])


def op8_near_vectors(spark, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
