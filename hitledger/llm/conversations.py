"""Repair of conversation structure: the cheapest edits that make the roles alternate.

A conversation's rows stand in the order of their turn. Each may have one fault, the first of:
``blank`` (nothing but white space), ``duplicate`` (role and text stood earlier in the
conversation), ``truncated`` (its last visible character ends no sentence). Edits turn the initials
of the roles into ``(s?(ua)+)?``: Keep costs 0, Rerole to user or assistant 2, Delete 3 (blank and
duplicate rows have no other choice), Insert of an empty user or assistant row 2; a truncated row
that stays adds 1. Of the cheapest edits the ones whose initials are least in ASCII count.

They are found by depth-first branch and bound with an explicit stack: a node is (rows done, last
role written), the bound is what the remaining rows cost at least, the incumbent is a whole (cost,
audit), and one dominance table per node drops prefixes that are no better than a known one. The
search ends when the stack is empty, which proves the incumbent.

Spark sorts slim rows (no texts) of each conversation into one stream; a conversation is searched
``SEGMENT`` rows at a time, the labels of a border being the entries of the next segment, so time
grows with the rows and memory with the audit alone. Texts are shuffled once, behind the decision
of their conversation, and edited as they stream by: no conversation is ever held whole.

Defined results: rows of equal turn (null turns first) go by role, then by the SHA-256 of the text;
null roles and texts count as one space; a null conversation id is an id like any other; other
roles than system, user and assistant are read by their first character, and one with another
initial or none is reroled or deleted; repeated rows are duplicates; ids passed as ``every`` without
rows get zeros and an empty audit; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitledger.llm.quality import CRC_SQL

SEGMENT = 16
COSTS = {"D": 3, "I": 2, "K": 0, "R": 2}
TRUNCATED = 1
#: Faults of a row, and the least a row with that fault costs.
FAULTS = ("none", "truncated", "duplicate", "blank")
LEAST = (0, min(TRUNCATED, COSTS["D"]), COSTS["D"], COSTS["D"])
#: Initials a row may keep its role with; any other is the last kind.
KINDS = "sua"
#: What was written last. A conversation may end in two of these.
START, SYSTEM, USER, ASSISTANT = range(4)
FINAL = (START, ASSISTANT)
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: By state: the states a kept row of each kind leads to, None where it may not follow.
KEPT = {START: (SYSTEM, USER, None, None), SYSTEM: (None, USER, None, None), USER: (None, None, ASSISTANT, None)}
KEPT[ASSISTANT] = KEPT[SYSTEM]
#: A label costing this much more than another cannot win: two inserts reach any role, one
#: deletion replaces the system row that only the start allows, two inserts end a conversation.
HOPELESS = 2 * COSTS["I"] + COSTS["D"] + 2 * COSTS["I"]
WHITE = " \t\n\x0b\x0c\r"
REMEMBERED = 100_000


def written_role(state: int) -> int:
    """The role that a reroled or inserted row gets behind ``state``."""
    return ASSISTANT if state == USER else USER


def branch_and_bound(entries: list[tuple], codes: bytes, last: bool) -> tuple[dict, int]:
    """Searches one segment; returns ({state: (cost, rank, audit)}, nodes expanded).

    ``entries`` are (state, cost, rank, audit). Ranks order the edits before the segment, audits
    are those since, so (rank, audit) compares as the whole audit does. Codes are four times the
    kind plus the fault. Behind the ``last`` segment one label remains, that of the best end.
    """
    n = len(codes)
    least = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        least[i] = least[i + 1] + LEAST[codes[i] & 3]
    tables: list[dict] = [{} for _ in range(n + 1)]
    best, expanded = None, 0
    stack = [(0, *e) for e in sorted(entries, key=lambda e: e[1:], reverse=True)]
    while stack:
        i, state, cost, rank, audit = stack.pop()
        if best is not None:
            bound = cost + least[i]
            if bound > best[0] or (bound == best[0] and (rank, audit) > (best[1], best[2][: len(audit)])):
                continue
        label, table = (cost, rank, audit), tables[i]
        if state in table and table[state] <= label:
            continue
        table[state] = label
        expanded += 1
        if i == n:
            if not last:
                continue
            if state in FINAL and (best is None or label < best):
                best = label
        role = written_role(state)
        children = [(i, role, cost + COSTS["I"], rank, audit + "I")]
        if i < n:
            kind, fault = codes[i] >> 2, codes[i] & 3
            if fault < 2:
                children.append((i + 1, role, cost + COSTS["R"] + fault * TRUNCATED, rank, audit + "R"))
                kept = KEPT[state][kind]
                if kept is not None:
                    children.append((i + 1, kept, cost + COSTS["K"] + fault * TRUNCATED, rank, audit + "K"))
            children.append((i + 1, state, cost + COSTS["D"], rank, audit + "D"))
        children.sort(key=lambda c: (c[2] + least[c[0]], c[4]), reverse=True)
        stack += children
    return ({START: best} if last else tables[n]), expanded


class Search:
    """The edits of one conversation, fed with the codes of its rows in order."""

    def __init__(self) -> None:
        self.waiting = bytearray()
        #: (state, cost, rank, inserts at the end, chain of audits before them)
        self.entries: list[tuple] = [(START, 0, 0, "", None)]
        self.expanded = 0

    def feed(self, codes: bytes) -> None:
        self.waiting += codes
        while len(self.waiting) > SEGMENT:
            self._advance(bytes(self.waiting[:SEGMENT]))
            del self.waiting[:SEGMENT]

    def _search(self, codes: bytes, last: bool) -> dict:
        chains = {rank: chain for _, _, rank, _, chain in self.entries}
        found, expanded = branch_and_bound([e[:4] for e in self.entries], codes, last)
        self.expanded += expanded
        return {state: (*label, chains[label[1]]) for state, label in found.items()}

    def _advance(self, codes: bytes) -> None:
        found = self._search(codes, last=False)
        limit = min(v[0] for v in found.values()) + HOPELESS
        # without the inserts at their end, audits of as many rows never start one another, so
        # their order can be kept as a number
        bases = {state: (v[1], v[2].rstrip("I")) for state, v in found.items() if v[0] <= limit}
        ranks = {base: k for k, base in enumerate(sorted(set(bases.values())))}
        chains = {base: (found[state][3], base[1]) for state, base in bases.items()}
        self.entries = [
            (state, found[state][0], ranks[base], found[state][2][len(base[1]) :], chains[base])
            for state, base in bases.items()
        ]

    def result(self) -> tuple[int, str]:
        """(cost, audit) of the cheapest edits."""
        if not self.waiting:
            return 0, ""
        cost, _, audit, chain = self._search(bytes(self.waiting), last=True)[START]
        parts = [audit]
        while chain is not None:
            chain, part = chain
            parts.append(part)
        return cost, "".join(reversed(parts))


def cheapest_edits(codes: bytes) -> tuple[int, str]:
    search = Search()
    search.feed(codes)
    return search.result()


# --- rows -----------------------------------------------------------------------------


def damaged(rows: DataFrame) -> DataFrame:
    """Known damage for trials: by crc32 of ``conv_id:turn`` modulo 20, a fifth part of it all.

    0 drops the row, 1 empties its text, 2 removes its sentence ends, 3 repeats it, 4 makes it the
    user's. Nulls count as one space.
    """
    space = F.lit(" ")
    key = F.concat(*[F.coalesce(F.col(c).cast("string"), space) if c != ":" else F.lit(c) for c in ("conv_id", ":", "turn")])
    marked = rows.select(
        "conv_id",
        "turn",
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
        (F.crc32(key.cast("binary")) % 20).alias("__kind"),
    ).where("__kind > 0")
    kind = F.col("__kind")
    times = F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return marked.select(
        "conv_id",
        "turn",
        F.when(kind == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, F.lit(""))
        .when(kind == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.explode(times).alias("__time"),
    ).drop("__time")


def _plain(rows: DataFrame) -> DataFrame:
    space = F.lit(" ")
    text = F.coalesce("text", space)
    return rows.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", space).alias("role"),
        text.alias("text"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
    )


def _codes(plain: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest, code): everything the search needs of a row."""
    visible = F.rtrim(F.col("text"), F.lit(WHITE))
    slim = plain.select(
        "conv_id",
        "turn",
        "role",
        "digest",
        (visible == "").alias("blank"),
        F.substring(visible, -1, 1).isin(".", "!", "?").alias("ended"),
    )
    earlier = F.row_number().over(Window.partitionBy("conv_id", "role", "digest").orderBy("turn")) > 1
    fault: Column = F.when(F.col("blank"), 3).when(F.col("again"), 2).when(~F.col("ended"), 1).otherwise(0)
    return slim.withColumn("again", earlier).select(
        "conv_id", "turn", "role", "digest", (_kind() * 4 + fault).cast("int").alias("code")
    )


def _kind() -> Column:
    first = F.substring("role", 1, 1)
    kind = F.lit(len(KINDS))
    for number, initial in enumerate(KINDS):
        kind = F.when(first == initial, number).otherwise(kind)
    return kind


SUMMARY = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


class _Conversation:
    def __init__(self) -> None:
        self.search = Search()
        self.faults = [0, 0, 0, 0]
        self.illegal = self.turns = 0
        self.first = self.latest = self.kind = None
        self.codes: bytes | None = b""

    def add(self, turns: list, codes: bytes) -> None:
        for turn, code in zip(turns, codes):
            kind = code >> 2
            self.faults[code & 3] += 1
            if self.kind is not None and (self.kind, kind) not in ((0, 1), (1, 2), (2, 1)):
                self.illegal += 1
            self.kind = kind
            if turn is not None and turn != self.latest:
                self.turns += 1
                self.first = turn if self.first is None else self.first
                self.latest = turn
        # short conversations are looked up among those met before
        if self.codes is not None and len(self.codes) + len(codes) <= SEGMENT:
            self.codes += codes
        else:
            self.search.feed((self.codes or b"") + codes)
            self.codes = None

    def summary(self, known: dict) -> tuple:
        if self.codes is None:
            cost, audit = self.search.result()
        else:
            if self.codes not in known:
                if len(known) >= REMEMBERED:
                    known.clear()
                known[self.codes] = cheapest_edits(self.codes)
            cost, audit = known[self.codes]
        gaps = self.latest - self.first + 1 - self.turns if self.turns else 0
        _, truncated, duplicate, blank = self.faults
        return gaps, blank, duplicate, truncated, self.illegal, cost, audit


def decide(rows: DataFrame, every: DataFrame | None = None) -> DataFrame:
    """One row per conversation: conv_id, its faults, and the cost and audit of the cheapest edits.

    ``every`` names conversations (conv_id) that appear also without rows.
    """
    coded = _codes(_plain(rows))
    kind = coded.schema["conv_id"].dataType
    if every is not None:
        heads = every.select("conv_id").distinct().select("conv_id", *[F.lit(None).cast(coded.schema[c].dataType).alias(c) for c in ("turn", "role", "digest", "code")])
        coded = coded.unionByName(heads)
    ordered = coded.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "digest", "code")

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        open_id, current, out = None, None, []
        for batch in batches:
            ids, turns = batch.column("conv_id").to_pylist(), batch.column("turn").to_pylist()
            codes = batch.column("code").fill_null(255).to_numpy(zero_copy_only=False).astype(np.uint8)
            bounds = [0, *[k for k in range(1, len(ids)) if ids[k] != ids[k - 1]], len(ids)]
            for low, high in zip(bounds, bounds[1:]):
                if low == high:
                    continue
                if current is None or ids[low] != open_id:
                    if current is not None:
                        out.append((open_id, *current.summary(known)))
                    open_id, current = ids[low], _Conversation()
                real = codes[low:high] != 255
                kept = turns[low:high] if real.all() else [t for t, r in zip(turns[low:high], real) if r]
                current.add(kept, codes[low:high][real].tobytes())
            if len(out) > 4096:
                yield _batch(out, schema)
                out = []
        if current is not None:
            out.append((open_id, *current.summary(known)))
        yield _batch(out, schema)

    declared = f"conv_id {kind.simpleString()}, {SUMMARY}"
    schema = _arrow(declared)
    return ordered.select("conv_id", "turn", "code").mapInArrow(summaries, declared)


def _arrow(declared: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(declared))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def _streamed(rows: DataFrame, decisions: DataFrame) -> DataFrame:
    """Rows of each conversation in order, behind the row that holds its decision."""
    plain = _plain(rows)
    names = [f.split()[0] for f in SUMMARY.split(", ")]
    heads = decisions.select("conv_id", F.lit(True).alias("head"), *names)
    both = plain.withColumn("head", F.lit(False)).unionByName(heads, allowMissingColumns=True)
    ordered = both.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("head"), "turn", "role", "digest")
    return ordered.select("conv_id", "head", "role", "text", *names)


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(summary, None) at the start of a conversation, then (place, edit, role, text) by edit."""
    audit, place, state = "", 0, START

    def inserts() -> Iterator[tuple]:
        nonlocal place, state
        while place < len(audit) and audit[place] == "I":
            state = written_role(state)
            yield place, "I", NAMES[state], ""
            place += 1

    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for conv_id, head, role, text, *summary in zip(*columns):
            if head:
                yield from inserts()
                audit, place, state = summary[-1], 0, START
                yield (conv_id, *summary), None
                continue
            yield from inserts()
            edit = audit[place]
            if edit == "D":
                yield place, edit, None, None
            else:
                if edit == "R":
                    state = written_role(state)
                    role = NAMES[state]
                else:
                    state = KEPT[state][KINDS.index(role[0])]
                yield place, edit, role, text
            place += 1
    yield from inserts()


def repaired_rows(rows: DataFrame, decisions: DataFrame | None = None) -> DataFrame:
    """One row per edit: conv_id, place (from 0), edit, role and text (null where deleted)."""
    decisions = decide(rows) if decisions is None else decisions
    streamed = _streamed(rows, decisions)
    declared = f"conv_id {streamed.schema['conv_id'].dataType.simpleString()}, place long, edit string, role string, text string"
    schema = _arrow(declared)

    def edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv_id, out, held = None, [], 0
        for event in _edited(batches):
            if event[1] is None and len(event) == 2:
                conv_id = event[0][0]
                continue
            out.append((conv_id, *event))
            held += len(event[3] or "")
            if len(out) >= 4096 or held > 1 << 22:
                yield _batch(out, schema)
                out, held = [], 0
        yield _batch(out, schema)

    return streamed.mapInArrow(edits, declared)


def repair_digests(rows: DataFrame, every: DataFrame | None = None) -> DataFrame:
    """``decide`` with the SHA-256 of the repaired rows as ``role:text`` lines."""
    streamed = _streamed(rows, decide(rows, every))
    declared = f"conv_id {streamed.schema['conv_id'].dataType.simpleString()}, {SUMMARY}, repaired_sha256 string"
    schema = _arrow(declared)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary, digest, between, out = None, None, b"", []
        for event in _edited(batches):
            if event[1] is None and len(event) == 2:
                if summary is not None:
                    out.append((*summary, digest.hexdigest()))
                summary, digest, between = event[0], hashlib.sha256(), b""
                if len(out) >= 4096:
                    yield _batch(out, schema)
                    out = []
            elif event[2] is not None:
                digest.update(between + f"{event[2]}:{event[3]}".encode())
                between = b"\n"
        if summary is not None:
            out.append((*summary, digest.hexdigest()))
        yield _batch(out, schema)

    return streamed.mapInArrow(digests, declared)


def op13_conversation_repair(spark, sf_dir: str) -> DataFrame:
    """Every conversation of ``conversations``, damaged and repaired."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return repair_digests(damaged(rows), every=rows.select("conv_id"))


#: Relaxes all (rows done, last role) nodes in step; the cheapest audit of each node survives.
OP13_SQL = rf"""
with recursive source as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as s from conversations),
strings as (select distinct s from source),{CRC_SQL},
marked as (select source.*, crc % 20 as kind from source join crcs using (s)),
damaged as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
    case kind when 1 then '' when 2 then translate(text, '.!?', '') else text end as text
  from (select * from marked union all select * from marked where kind = 3) where kind > 0),
plain as (
  select *, sha256(text) as digest, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as visible
  from damaged),
placed as (
  select *, row_number() over (partition by conv_id, role, digest order by k) > 1 as again
  from (select *, row_number() over (partition by conv_id order by turn nulls first, role, digest) as k from plain)),
coded as (
  select conv_id, k, turn, role, text, left(role, 1) as initial,
    case when visible = '' then 'blank' when again then 'duplicate'
      when right(visible, 1) not in ('.', '!', '?') then 'truncated' else 'none' end as fault,
    lag(left(role, 1)) over (partition by conv_id order by k) as before
  from placed),
faults as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
    count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
    count(*) filter (fault = 'truncated') as truncated,
    count(*) filter (k > 1 and before || initial not in ('su', 'ua', 'au')) as illegal, count(*) as n
  from coded group by conv_id),
inserted(q, added, to_q) as (values ('-', '', '-'), ('-', 'I', 'u'), ('-', 'II', 'a'), ('s', '', 's'), ('s', 'I', 'u'),
  ('s', 'II', 'a'), ('u', '', 'u'), ('u', 'I', 'a'), ('a', '', 'a'), ('a', 'I', 'u')),
edits(q, edit, initial, to_q, price) as (
  select q, 'D', cast(null as varchar), q, 3 from (values ('-'), ('s'), ('u'), ('a')) v(q)
  union all values ('-', 'R', cast(null as varchar), 'u', 2), ('s', 'R', null, 'u', 2), ('u', 'R', null, 'a', 2), ('a', 'R', null, 'u', 2),
    ('-', 'K', 's', 's', 0), ('-', 'K', 'u', 'u', 0), ('s', 'K', 'u', 'u', 0), ('u', 'K', 'a', 'a', 0), ('a', 'K', 'u', 'u', 0)),
steps as (
  select i.q, i.added || e.edit as letters, e.initial, e.edit, e.to_q, 2 * length(i.added) + e.price as price
  from inserted i join edits e on i.to_q = e.q),
nodes(conv_id, k, q, label) as (
  select conv_id, cast(0 as bigint), '-', struct_pack(cost := cast(0 as bigint), audit := '') from faults
  union all
  select n.conv_id, c.k, s.to_q, min(struct_pack(
      cost := n.label.cost + s.price + case when c.fault = 'truncated' and s.edit <> 'D' then 1 else 0 end,
      audit := n.label.audit || s.letters))
  from nodes n join coded c on c.conv_id is not distinct from n.conv_id and c.k = n.k + 1
    join steps s on s.q = n.q and (s.initial is null or s.initial = c.initial)
      and (s.edit = 'D' or c.fault in ('none', 'truncated'))
  group by n.conv_id, c.k, s.to_q),
ended as (
  select n.conv_id, min(struct_pack(cost := n.label.cost + 2 * length(i.added), audit := n.label.audit || i.added)) as label
  from nodes n join faults f on f.conv_id is not distinct from n.conv_id and f.n = n.k
    join inserted i on i.q = n.q and i.to_q in ('-', 'a') group by n.conv_id),
letters as (select conv_id, label.audit as audit, unnest(range(1, length(label.audit) + 1)) as p from ended),
cut as (
  select conv_id, p, substr(audit, p, 1) as edit,
    length(replace(substr(audit, 1, p), 'I', '')) as k,
    length(replace(substr(audit, 1, p), 'D', '')) as written
  from letters),
written as (
  select cut.conv_id, cut.p, cut.edit, cut.written, c.role, c.text, cut.written
    - max(case when cut.edit = 'K' and c.initial = 's' then 1 else 0 end) over (partition by cut.conv_id) as place
  from cut left join coded c on c.conv_id is not distinct from cut.conv_id and c.k = cut.k where cut.edit <> 'D'),
repaired as (
  select conv_id, string_agg(case edit when 'K' then role || ':' || text else
    (case when place % 2 = 1 then 'user:' else 'assistant:' end) || case when edit = 'R' then text else '' end end,
    chr(10) order by p) as body
  from written group by conv_id)
select v.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
  coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(e.label.cost, 0) as cost,
  coalesce(e.label.audit, '') as audit, sha256(coalesce(body, '')) as repaired_sha256
from (select distinct conv_id from conversations) v
  left join faults f on f.conv_id is not distinct from v.conv_id
  left join ended e on e.conv_id is not distinct from v.conv_id
  left join repaired r on r.conv_id is not distinct from v.conv_id
"""
