"""Audit of how five filters interact: who removes what, in every order they could run in.

Each document passes or fails each of the filters A to E, whatever the others do. Counts by part and
by the 32 patterns of failures are all that any order needs: reshaped to 2x2x2x2x2 per part, they
are contracted by ``einsum`` with one vector per axis (pass, fail or all), once for every step of
every order. What a filter removes at a step is those that pass all earlier filters and fail it.

Failures: A fewer than 200 words; B fewer distinct words than half of them; C more than 2 percent of
the characters are A-Z; D one of ``#$%&*|`` occurs; E a smaller doc_id has the identical text.

Flags are DataFrame expressions. Texts meet each other as SHA-256 digests: the smallest id of each
digest is found by an aggregation, and rows join it on digest and id together, so that copies, however
many, spread over all tasks. Counting combines before its shuffle; parts are contracted where they
lie, in Arrow batches of at most 32 rows a part.

Defined results: null texts are empty; null parts are the empty string; rows without an id have no
smaller id and are none, so they pass E; rows of equal id and text pass or fail E together and count
one by one; of several labels of an id any that says so makes it good or toxic; an empty table has no
parts and so no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import itertools
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitledger.llm.common import let, text_or_empty, words
from hitledger.stages import shared

FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_UPPER_PERCENT, SYMBOLS = 200, 50, 2, "#$%&*|"
PASS, FAIL, ALL = np.array([1, 0]), np.array([0, 1]), np.array([1, 1])
ORDERS = ["".join(order) for order in itertools.permutations(FILTERS)]
SIZES = ("documents", "good", "toxic")
RESULTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
#: Parts contracted at once.
PARTS = 256


def failures(text: Column) -> Column:
    """Bits of the filters that look at the text alone: 1 for A, 2 for B, 4 for C, 8 for D."""

    def bits(found: Column) -> Column:
        n = F.size(found).cast("long")
        rare = n * MIN_DISTINCT_PERCENT > F.size(F.array_distinct(found)).cast("long") * 100
        return (n < MIN_WORDS).cast("int") + rare.cast("int") * 2

    # what a translation to nothing leaves is all but A-Z
    length = F.char_length(text).cast("long")
    upper = (length - F.char_length(F.translate(text, string.ascii_uppercase, ""))) * 100 > length * MAX_UPPER_PERCENT
    symbol = F.char_length(F.translate(text, SYMBOLS, "")) < length
    return let(words(text), bits) + upper.cast("int") * 4 + symbol.cast("int") * 8


def patterns(docs: DataFrame, labels: DataFrame, part: str) -> DataFrame:
    """(part, pattern, documents, good, toxic): how many documents show each pattern of failures.

    Bit k of the pattern is set for a failure of the k-th filter.
    """
    text = text_or_empty("text")
    slim = docs.select(
        F.col("doc_id"),
        F.coalesce(F.col(part), F.lit("")).alias("part"),
        failures(text).alias("bits"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
    )
    # rows of equal id and text are one row from here on, with their number; two plans read them
    rows = shared(slim.groupBy("doc_id", "digest", "part", "bits").agg(F.count("*").alias("n")))
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    smallest = rows.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    marked = rows.join(smallest.withColumn("first", F.lit(True)), ["digest", "doc_id"], "left").join(marks, "doc_id", "left")
    copy = (F.col("doc_id").isNotNull() & F.col("first").isNull()).cast("int")

    def total(mark: str) -> Column:
        return F.sum(F.col("n") * F.coalesce(mark, F.lit(0))).cast("long").alias(mark)

    return marked.groupBy("part", (F.col("bits") + copy * 16).alias("pattern")).agg(
        F.sum("n").alias("documents"), total("good"), total("toxic")
    )


def contract(tensors: np.ndarray, along: list[np.ndarray]) -> np.ndarray:
    """Sums (parts x 2x2x2x2x2) with one vector (steps x 2) per axis: (parts x steps), exactly."""
    # one axis after the other, the steps kept: at most 16 numbers a part and step at a time
    found = np.einsum("pabcde,se->psabcd", tensors, along[4])
    found = np.einsum("psabcd,sd->psabc", found, along[3])
    found = np.einsum("psabc,sc->psab", found, along[2])
    return np.einsum("psab,sa,sb->ps", found, along[0], along[1])


def selections(chosen) -> list[np.ndarray]:
    """By axis, the vector that ``chosen(filter, order, step)`` names for each step of each order."""
    return [
        np.array([chosen(name, order, step) for order in ORDERS for step in range(len(FILTERS))]) for name in FILTERS
    ]


def _steps() -> dict[str, list[np.ndarray]]:
    def kept(name: str, order: str, step: int) -> np.ndarray:
        return PASS if order.index(name) <= step else ALL

    def removed(name: str, order: str, step: int) -> np.ndarray:
        at = order.index(name)
        return FAIL if at == step else PASS if at < step else ALL

    def failing(name: str, order: str, step: int) -> np.ndarray:
        return FAIL if order[step] == name else ALL

    def alone(name: str, order: str, step: int) -> np.ndarray:
        return FAIL if order[step] == name else PASS

    return {"kept": selections(kept), "removed": selections(removed), "failing": selections(failing), "alone": selections(alone)}


def interactions(tensors: np.ndarray) -> dict[str, np.ndarray]:
    """Results by name, each (parts x 600), of tensors (3 x parts x 2x2x2x2x2): documents, good, toxic."""
    documents, good, toxic = tensors
    steps = _steps()
    removed = contract(documents, steps["removed"])
    # by filter, over all orders: steps in rows of five letters
    letters = np.array([FILTERS.index(name) for order in ORDERS for name in order])
    by_filter = np.zeros((len(documents), len(FILTERS)), np.int64)
    for k in range(len(FILTERS)):
        by_filter[:, k] = removed[:, letters == k].sum(axis=1)
    return {
        "kept": contract(documents, steps["kept"]),
        "removed": removed,
        "redundant": contract(documents, steps["failing"]) - removed,
        "unique_fails": contract(documents, steps["alone"]),
        "good_lost": contract(good, steps["removed"]),
        "toxic_lost": contract(toxic, steps["removed"]),
        "shapley": by_filter[:, letters],
    }


def audit_filters(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """One row per part, order of the filters and step: part, filter_order, step and ``RESULTS``."""
    counted = patterns(docs, labels, part)
    by_part = counted.groupBy("part").agg(F.collect_list(F.struct("pattern", *SIZES)).alias("cells"))
    fields = ", ".join(f"{name} long" for name in RESULTS)

    def audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, PARTS):
                yield _audit(batch.slice(start, PARTS))

    return by_part.mapInArrow(audits, f"part string, filter_order string, step int, {fields}")


def _audit(batch: pa.RecordBatch) -> pa.RecordBatch:
    cells = batch.column("cells")
    row = np.repeat(np.arange(len(cells)), cells.value_lengths().to_numpy(zero_copy_only=False))
    flat = cells.flatten()
    tensors = np.zeros((len(SIZES), len(cells), 32), np.int64)
    for k, name in enumerate(SIZES):
        tensors[k, row, flat.field("pattern").to_numpy()] = flat.field(name).to_numpy()
    # bit 0 of the pattern is the last axis of a reshape, so the axes are turned round
    found = interactions(tensors.reshape(len(SIZES), len(cells), 2, 2, 2, 2, 2).transpose(0, 1, 6, 5, 4, 3, 2))
    steps = len(ORDERS) * len(FILTERS)
    columns = [
        batch.column("part").take(pa.array(np.repeat(np.arange(len(cells)), steps))),
        pa.array(np.repeat(ORDERS, len(FILTERS)).tolist() * len(cells), pa.string()),
        pa.array(np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(cells) * len(ORDERS))),
        *[pa.array(found[name].reshape(-1).astype(np.int64)) for name in RESULTS],
    ]
    return pa.RecordBatch.from_arrays(columns, ["part", "filter_order", "step", *RESULTS])


def op11_filter_audit(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return audit_filters(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


OP11_SQL = rf"""
with recursive docs as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as text,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w from documents),
marks as (
  select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels where doc_id is not null group by doc_id),
flags as (
  select part, coalesce(good, false) as good, coalesce(toxic, false) as toxic, [
    len(w) < {MIN_WORDS},
    100 * len(list_distinct(w)) < {MIN_DISTINCT_PERCENT} * len(w),
    100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > {MAX_UPPER_PERCENT} * length(text),
    regexp_matches(text, '[{SYMBOLS}]'),
    coalesce(doc_id > min(doc_id) over (partition by text), false)] as fails
  from docs left join marks using (doc_id)),
counts as (
  select part, fails, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic from flags group by all),
orders(o) as (
  select '' union all select o || f from orders, (values ('A'), ('B'), ('C'), ('D'), ('E')) v(f)
  where length(o) < 5 and not contains(o, f)),
steps as (
  select o, cast(step as int) as step, substr(o, step, 1) as f, ascii(substr(o, step, 1)) - 64 as axis,
    list_transform(range(1, step), lambda k: ascii(substr(o, k, 1)) - 64) as before
  from orders, range(1, 6) r(step) where length(o) = 5),
parts as (select distinct part from counts),
seen as (
  select part, o, step, f, n, good, toxic, fails[axis] as failing,
    not list_bool_or(list_transform(list_prepend(0, before), lambda k: k > 0 and fails[greatest(k, 1)])) as here,
    len(list_filter(fails, lambda x: x)) = 1 as once
  from steps cross join counts),
audit as (
  select part, o as filter_order, step, f,
    coalesce(sum(n) filter (here and not failing), 0) as kept, coalesce(sum(n) filter (here and failing), 0) as removed,
    coalesce(sum(n) filter (not here and failing), 0) as redundant,
    coalesce(sum(n) filter (failing and once), 0) as unique_fails,
    coalesce(sum(good) filter (here and failing), 0) as good_lost,
    coalesce(sum(toxic) filter (here and failing), 0) as toxic_lost
  from seen group by part, o, step, f)
select part, filter_order, step, cast(kept as bigint) as kept, cast(removed as bigint) as removed,
  cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails,
  cast(good_lost as bigint) as good_lost, cast(toxic_lost as bigint) as toxic_lost,
  cast(sum(removed) over (partition by part, f) as bigint) as shapley
from audit
"""
