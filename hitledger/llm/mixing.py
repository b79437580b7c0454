"""Mixing sources to target weights as a min-cost flow.

Documents belong to one or more sources. They are summed by membership pattern; a small flow
network routes every pattern's words to the quotas of its sources, where a word's first use costs
nothing and each further use costs more, so that nothing is repeated while unused words could
serve. The flow gives every pattern consecutive segments of its documents, taken in a seeded order.

Only sums by pattern, and by pattern and hash bucket, are gathered: at most ``MAX_CELLS`` rows,
whatever the input holds. A segment ends inside a few buckets; only their rows are sorted, all
others are decided where they are read.

Defined results: null or empty text has size 0 and takes 0; null membership is the source null;
repeated rows count as documents of their own; ties of the seeded order go by id, then size; an
empty table gives an empty result; columns named ``taken`` or ``uses`` are replaced.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hitledger.llm.common import SEPARATORS, text_or_empty
from hitledger.stages import shared

#: Bound of the (pattern, bucket) sums that are broadcast.
MAX_CELLS = 1 << 17
BUCKETS = 4096
WEIGHTS = (3, 1, 2)


def word_count(text: Column) -> Column:
    """Number of words; null counts 0."""
    spaced = F.regexp_replace(text_or_empty(text), f"^{SEPARATORS}|{SEPARATORS}$", "")
    return F.when(spaced == "", 0).otherwise(F.size(F.split(spaced, SEPARATORS))).cast("long")


def capped_targets(
    sizes: Sequence[int], weights: Sequence[float], total: float, cap: int = 2
) -> list[float]:
    """Shares ``total`` by weight; no share exceeds ``cap`` times its size, the rest gets the excess."""
    targets = [0.0] * len(sizes)
    open_weight, left, capping = float(sum(weights)), float(total), True
    for i in sorted(range(len(sizes)), key=lambda i: (cap * sizes[i] / weights[i], i)):
        capping = capping and cap * sizes[i] * open_weight <= left * weights[i]
        if capping:
            targets[i] = float(cap * sizes[i])
            left -= cap * sizes[i]
            open_weight -= weights[i]
        else:
            targets[i] = left * weights[i] / open_weight
    return targets


def route(
    capacity: Sequence[int], members: Sequence[Sequence[int]], quota: Sequence[int], repeats: int
) -> list[list[list[int]]]:
    """Min-cost flow: words that each pattern gives to each of its sources, by use.

    ``result[use][pattern]`` is a list parallel to ``members[pattern]``. Use u costs u * u, so costs
    are convex. Shortest augmenting paths over a network of patterns and sources.
    """
    n, m = len(capacity), len(quota)
    source, sink = n + m, n + m + 1
    to, cap, cost, out = [], [], [], [[] for _ in range(n + m + 2)]

    def arc(a: int, b: int, room: int, price: int) -> int:
        for x, y, r, p in ((a, b, room, price), (b, a, 0, -price)):
            out[x].append(len(to))
            to.append(y)
            cap.append(r)
            cost.append(p)
        return len(to) - 2

    for p in range(n):
        for use in range(repeats):
            arc(source, p, capacity[p], use * use)
    wires = [[arc(p, n + s, capacity[p] * repeats, 0) for s in members[p]] for p in range(n)]
    for s in range(m):
        arc(n + s, sink, quota[s], 0)
    while True:
        far, via, queue, queued = {source: 0}, {}, deque([source]), {source}
        while queue:
            a = queue.popleft()
            queued.discard(a)
            for e in out[a]:
                b = to[e]
                if cap[e] > 0 and far[a] + cost[e] < far.get(b, 1 << 60):
                    far[b], via[b] = far[a] + cost[e], e
                    if b not in queued:
                        queue.append(b)
                        queued.add(b)
        if sink not in via:
            break
        path, b = [], sink
        while b != source:
            path.append(via[b])
            b = to[via[b] ^ 1]
        step = min(cap[e] for e in path)
        for e in path:
            cap[e] -= step
            cap[e ^ 1] += step
    flows = [[cap[e ^ 1] for e in wires[p]] for p in range(n)]
    uses = []
    for _ in range(repeats):
        level = []
        for p in range(n):
            room, row = capacity[p], []
            for k, words in enumerate(flows[p]):
                row.append(min(words, room))
                room -= row[-1]
                flows[p][k] -= row[-1]
            level.append(row)
        uses.append(level)
    return uses


def mix(
    docs: DataFrame,
    *,
    doc_id: str,
    size: Column,
    sources: Column,
    targets: Mapping[str | None, float],
    repeats: int = 2,
    seed: str = "mix",
    whole: bool = False,
) -> DataFrame:
    """Adds ``taken`` (words used, repeats counted) and ``uses`` (source, words) to every document.

    ``docs`` is read four times, so it should be a written table where ``size`` is costly.
    ``sources`` is an array of source names. Sums of ``taken`` meet ``targets`` rounded down
    wherever the flow can; the one document at the end of a segment is used in part, unless
    ``whole``, which rounds it to the nearer number of whole uses.
    """
    names = sorted(targets, key=lambda s: (s is None, s or ""))
    keyed = docs.withColumns(
        {
            "__size": size.cast("long"),
            "__pattern": F.to_json(F.sort_array(F.array_distinct(sources))),
            "__order": F.md5(
                F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(f":{seed}"))
                .cast("binary")
            ),
        }
    )
    keyed = keyed.withColumn("__first", F.conv(F.substring("__order", 1, 3), 16, 10).cast("int"))
    sums = shared(
        keyed.withColumn("__members", F.sort_array(F.array_distinct(sources)))
        .groupBy("__pattern", "__members", "__first")
        .agg(F.sum("__size").alias("__words"))
    )
    patterns = (
        sums.groupBy("__pattern", "__members").agg(F.sum("__words").alias("w")).orderBy("__pattern").collect()
    )
    if len(patterns) > MAX_CELLS // 16:
        raise ValueError(f"{len(patterns)} membership patterns; at most {MAX_CELLS // 16}")
    place = {s: i for i, s in enumerate(names)}
    members = [[place[s] for s in row["__members"] if s in place] for row in patterns]
    used = route([row["w"] for row in patterns], members, [int(targets[s]) for s in names], repeats)
    segments = []
    for p, row in enumerate(patterns):
        for use in range(repeats):
            at = 0
            for s, words in zip(members[p], used[use][p]):
                if words:
                    segments.append((row["__pattern"], names[s], use, at, at + words))
                at += words
    spark = docs.sparkSession
    plan = spark.createDataFrame(
        segments, "__pattern string, source string, use int, start long, stop long"
    ).groupBy("__pattern").agg(
        F.sort_array(F.collect_list(F.struct("use", "start", "stop", "source"))).alias("__segments")
    )
    width = 1
    while len(patterns) * (BUCKETS // width) > MAX_CELLS:
        width *= 2
    cells = sums.groupBy("__pattern", F.floor(F.col("__first") / width).alias("__bucket")).agg(
        F.sum("__words").alias("__words")
    )
    by_bucket = Window.partitionBy("__pattern").orderBy("__bucket")
    cells = (
        cells.withColumn("__base", F.sum("__words").over(by_bucket) - F.col("__words"))
        .join(F.broadcast(plan), "__pattern", "left")
        .withColumn(
            "__cut",
            F.coalesce(
                F.exists(
                    "__segments",
                    lambda g: ((g["start"] > F.col("__base")) & (g["start"] < F.col("__base") + F.col("__words")))
                    | ((g["stop"] > F.col("__base")) & (g["stop"] < F.col("__base") + F.col("__words"))),
                ),
                F.lit(False),
            ),
        )
        .drop("__words")
    )
    cells = shared(cells)
    placed = keyed.withColumn("__bucket", F.floor(F.col("__first") / width)).join(
        F.broadcast(cells), ["__pattern", "__bucket"]
    )
    in_bucket = (
        Window.partitionBy("__pattern", "__bucket")
        .orderBy("__order", doc_id, "__size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    cut = placed.where("__cut").withColumn(
        "__base", F.col("__base") + F.coalesce(F.sum("__size").over(in_bucket), F.lit(0))
    )
    rows = placed.where(~F.col("__cut")).unionByName(cut)
    begin, end = F.col("__base"), F.col("__base") + F.col("__size")

    def share(g: Column) -> Column:
        part = F.greatest(F.lit(0), F.least(g["stop"], end) - F.greatest(g["start"], begin))
        if whole:
            part = F.when(2 * part > F.col("__size"), F.col("__size")).otherwise(0)
        return F.struct(g["source"].alias("source"), part.cast("long").alias("words"))

    uses = F.coalesce(
        F.filter(F.transform("__segments", share), lambda u: u["words"] > 0),
        F.array().cast("array<struct<source:string,words:bigint>>"),
    )
    taken = F.aggregate("uses", F.lit(0).cast("long"), lambda a, u: a + u["words"])
    kept = [c for c in docs.columns if c not in ("uses", "taken")]
    return rows.select(*kept, uses.alias("uses")).withColumn("taken", taken)


def source_targets(docs: DataFrame, size: Column, source: str, share: float = 1.5) -> dict:
    """Target words of every source: weights 3, 1, 2 repeating by code point, capped at two uses."""
    sums = {r[0]: r[1] for r in docs.groupBy(source).agg(F.sum(size)).collect()}
    names = sorted(sums, key=lambda s: (s is None, s or ""))
    sizes = [sums[s] for s in names]
    weights = [WEIGHTS[i % len(WEIGHTS)] for i in range(len(names))]
    targets = capped_targets(sizes, weights, share * sum(sizes))
    return {s: (size, target) for s, size, target in zip(names, sizes, targets)}


def mix_documents(docs: DataFrame, whole: bool = False) -> tuple[DataFrame, dict]:
    """Documents by their one ``source``: (rows with ``size`` and ``taken``, totals by source).

    Words are counted once, into a table; all else reads that.
    """
    counted = shared(docs.withColumn("size", word_count(F.col("text"))) if "text" in docs.columns else docs)
    totals = source_targets(counted, F.col("size"), "source")
    mixed = mix(
        counted,
        doc_id="doc_id",
        size=F.col("size"),
        sources=F.array(F.col("source").cast("string")),
        targets={s: t for s, (_, t) in totals.items()},
        whole=whole,
    )
    return mixed, totals


def op10_mix_sources(spark, sf_dir: str) -> DataFrame:
    """Per document: size, source_size, target of its source, taken."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    mixed, totals = mix_documents(sized)
    table = spark.createDataFrame(
        [(s, size, target) for s, (size, target) in totals.items()],
        "source string, source_size long, target double",
    )
    joined = mixed.join(F.broadcast(table), mixed["source"].eqNullSafe(table["source"]))
    return joined.select("doc_id", "size", "source_size", "target", "taken")


OP10_SQL = r"""
with sized as (
  select doc_id, source,
    len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')) as size
  from documents),
sums as (
  select source, cast(sum(size) as bigint) as source_size,
    [3, 1, 2][1 + (row_number() over (order by source nulls last) - 1) % 3] as weight,
    row_number() over (order by source nulls last) as place
  from sized group by source),
steps as (
  select *, row_number() over w as step,
    1.5 * sum(source_size) over () - coalesce(sum(2 * source_size) over (w rows between unbounded preceding and 1 preceding), 0) as left_words,
    sum(weight) over (w rows between current row and unbounded following) as open_weight
  from sums window w as (order by 2 * source_size / weight, place)),
firsts as (
  select arg_min(left_words, step) as l, arg_min(open_weight, step) as o, min(step) as s
  from steps where not 2 * source_size * open_weight <= left_words * weight),
targets as (
  select source, source_size,
    case when step < coalesce(s, 1 << 40) then cast(2 * source_size as double)
      else cast(l as double) * cast(weight as double) / cast(o as double) end as target
  from steps, firsts),
placed as (
  select doc_id, size, source_size, target,
    coalesce(sum(size) over (partition by source order by md5(coalesce(cast(doc_id as varchar), '') || ':mix'), doc_id, size
      rows between unbounded preceding and 1 preceding), 0) as pos
  from sized join targets using (source) where source is not null
  union all
  select doc_id, size, source_size, target,
    coalesce(sum(size) over (order by md5(coalesce(cast(doc_id as varchar), '') || ':mix'), doc_id, size
      rows between unbounded preceding and 1 preceding), 0) as pos
  from sized, targets where sized.source is null and targets.source is null)
select doc_id, cast(size as bigint) as size, source_size, target,
  cast(greatest(0, least(least(floor(target), source_size) - pos, size))
    + greatest(0, least(floor(target) - least(floor(target), source_size) - pos, size)) as bigint) as taken
from placed
"""
