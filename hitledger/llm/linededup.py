"""Line dedup by content-defined chunks of lines.

A rolling hash runs over every two successive lines with words. Where it begins or ceases to be one
that another place has too, a chunk begins or ends. So boundaries follow from the content alone:
inserted or deleted lines move none, and a repeated passage is a chunk exactly, whatever stands
around it. Chunks have two lines at least; a line of ``LONG`` words or more counts by itself.

Of equal windows, those in the document with the smallest id stay and the lines of all others go;
within a document the first one stays. A line that goes is in a window that a document with a smaller
id keeps or has lost to one with a smaller id still, so every line stays somewhere. Equality is that
of bytes: hashes only say what to compare. The text of each repeated window is fetched from the
document that keeps it and compared with the text to go.

All of it is DataFrame expressions. Texts are not shuffled to be counted, only their hashes, combined
map-side; hot hashes are dealt out by the join for hot keys, with texts only up to ``BROADCAST``.

Defined results: null text stays null, empty text stays empty; lines without words stay where
others go, but a document left without words and lines has empty text; rows with equal ids act as
one document, so they don't take lines from each other; rows without id lose lines that a document
with id holds; an empty table gives an empty result; columns named ``n_lines`` or ``removed_lines``
are replaced, all others stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitledger.joins import join_by_hot_key
from hitledger.llm.common import SEPARATORS, let, text_or_empty
from hitledger.stages import shared

LONG = 50
MARK = "\x01"
WHITE = " \t\n\x0b\x0c\r"
#: Longest window text, in bytes, that may be broadcast for a hot hash; at most 1000 are.
BROADCAST = 16 << 10


def _is_long(line: Column) -> Column:
    # 50 words take 99 characters at least
    count = F.size(F.array_remove(F.split(line, SEPARATORS), ""))
    return (F.length(line) >= 2 * LONG - 1) & (count >= LONG)


def _worded(body: Column, then) -> Column:
    """``then`` of a struct: the lines of a text, and the places of those with words, in order."""

    def places(lines: Column) -> Column:
        every = F.sequence(F.lit(0), F.size(lines) - 1)
        with_words = F.filter(every, lambda i: F.rtrim(F.get(lines, i), F.lit(WHITE)) != "")
        return let(F.struct(lines.alias("lines"), with_words.alias("at")), then)

    return let(F.split(body, "\n"), places)


def _windows(d: Column, use) -> Column:
    """``use`` of the text of every two successive lines with words, in order."""
    first = F.sequence(F.lit(0), F.size(d["at"]) - 2)
    texts = F.transform(
        first, lambda k: use(F.concat(F.get(d["lines"], F.get(d["at"], k)), F.lit("\n"), F.get(d["lines"], F.get(d["at"], k + 1))))
    )
    # no window: an empty array of the same type
    return F.when(F.size(d["at"]) >= 2, texts).otherwise(F.slice(texts, 1, 0))


def _long_lines(d: Column, use) -> Column:
    return F.transform(F.filter(d["at"], lambda i: _is_long(F.get(d["lines"], i))), lambda i: use(F.get(d["lines"], i)))


def hashes(body: Column) -> Column:
    """The hashes of a text's windows and long lines, each once."""
    return F.array_distinct(_worded(body, lambda d: F.concat(_windows(d, F.xxhash64), _long_lines(d, F.xxhash64))))


def texts_of(body: Column, wanted: Column) -> Column:
    """(hash, text) of the windows and long lines whose hash is wanted."""

    def same(text: Column) -> Column:
        return F.struct(F.xxhash64(text).alias("hash"), text.alias("chunk"))

    found = _worded(body, lambda d: F.concat(_windows(d, same), _long_lines(d, same)))
    return F.array_distinct(F.filter(found, lambda t: F.array_contains(wanted, t["hash"])))


def remaining(body: Column, gone: Column) -> Column:
    """The lines that stay when the windows and long lines in ``gone`` go, and all but the first of
    equal windows in the text."""

    def with_windows(d: Column) -> Column:
        return let(F.struct(d["lines"].alias("lines"), d["at"].alias("at"), _windows(d, lambda t: t).alias("w")), marked)

    def marked(d: Column) -> Column:
        # equal windows stand side by side when sorted; all but the first are later ones
        order = F.array_sort(F.transform(d["w"], lambda t, k: F.struct(F.xxhash64(t).alias("h"), t.alias("t"), k.alias("k"))))
        none = F.array().cast("array<int>")
        several = F.size(F.array_distinct(d["w"])) < F.size(d["w"])

        def sides(o: Column) -> Column:
            places = F.sequence(F.lit(1), F.size(o) - 1)
            equal = F.filter(places, lambda p: F.get(o, p)["t"] == F.get(o, p - 1)["t"])
            return F.struct(
                F.transform(equal, lambda p: F.get(o, p)["k"]).alias("later"),
                F.transform(
                    F.filter(equal, lambda p: ~F.coalesce(F.get(o, p - 2)["t"] == F.get(o, p)["t"], F.lit(False))),
                    lambda p: F.get(o, p - 1)["k"],
                ).alias("first"),
            )

        self_equal = F.when(several, let(order, sides)).otherwise(F.struct(none.alias("later"), none.alias("first")))
        lost = F.filter(
            F.sequence(F.lit(0), F.size(d["w"])), lambda k: F.coalesce(F.array_contains(gone, F.get(d["w"], k)), F.lit(False))
        )
        both = F.struct(d["lines"].alias("lines"), d["at"].alias("at"), lost.alias("lost"), self_equal.alias("same"))
        return let(both, left)

    def left(d: Column) -> Column:
        def covered(windows: Column, k: Column) -> Column:
            return F.array_contains(windows, k) | F.array_contains(windows, k - 1)

        goes = F.filter(
            F.transform(
                d["at"],
                lambda i, k: F.when(
                    covered(d["lost"], k)
                    | (covered(d["same"]["later"], k) & ~covered(d["same"]["first"], k))
                    | F.coalesce(F.array_contains(gone, F.get(d["lines"], i)), F.lit(False)),
                    i,
                ),
            ),
            lambda i: i.isNotNull(),
        )
        return let(F.struct(d["lines"].alias("lines"), goes.alias("goes")), lambda g: F.filter(g["lines"], lambda line, i: ~F.array_contains(g["goes"], i)))

    return _worded(body, with_windows)


def dedup_lines(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with repeated chunks removed from ``text``, plus ``n_lines`` and ``removed_lines``."""
    docs = docs.drop("n_lines", "removed_lines")
    body = text_or_empty(text)
    key = F.coalesce(F.col(doc_id).cast("string"), F.concat(F.lit(MARK), F.md5(body.cast("binary"))))
    hashed = shared(docs.select(F.col(doc_id).alias("id"), key.alias("doc"), hashes(body).alias("hashes")))
    places = hashed.select("id", "doc", F.explode("hashes").alias("hash"))
    repeated = places.groupBy("hash").agg(F.min("id").alias("keeper"), F.count("*").alias("n"))
    repeated = shared(repeated.where("n > 1 and keeper is not null"))
    found = join_by_hot_key(places, repeated, "hash", "n", "inner")
    goes = F.col("id").isNull() | (F.col("id") > F.col("keeper"))
    found = shared(found.select("doc", "hash", goes.alias("goes")))
    # the texts of repeated windows, from the documents that keep them
    wanted = found.where("not goes").groupBy(F.col("doc").alias("__doc")).agg(F.collect_set("hash").alias("__wanted"))
    holders = docs.select(key.alias("__doc"), body.alias("__text")).join(wanted, "__doc")
    chunks = holders.select(F.inline(texts_of(F.col("__text"), F.col("__wanted"))))
    chunks = shared(chunks.groupBy("hash").agg(F.min("chunk").alias("chunk")).join(repeated.select("hash", "n"), "hash"))
    short = F.octet_length("chunk") <= BROADCAST
    gone = join_by_hot_key(found.where("goes").select("doc", "hash"), chunks, "hash", "n", "inner", short)
    gone = gone.groupBy(F.col("doc").alias("__gone_doc")).agg(F.collect_set("chunk").alias("__gone"))
    joined = docs.withColumn("__doc", key).join(gone, F.col("__doc") == F.col("__gone_doc"), "left")
    nothing = F.array().cast("array<string>")
    kept = let(F.coalesce("__gone", nothing), lambda g: remaining(body, g))
    n_lines = F.when(F.col(text).isNull(), 0).otherwise(F.size(F.split(text, "\n")))
    done = joined.withColumn("__kept", F.explode(F.array(kept)))
    done = done.withColumns(
        {"__text": F.when(F.col(text).isNotNull(), F.array_join("__kept", "\n")), "n_lines": n_lines.cast("long")}
    )
    left = F.when(F.col("__text") == "", 0).otherwise(F.size("__kept"))
    # a text that lost nothing but is empty has one line and keeps it
    left = F.when(F.col("__text") == F.col(text), F.col("n_lines")).otherwise(left)
    done = done.withColumn("removed_lines", F.when(F.col(text).isNull(), 0).otherwise(F.col("n_lines") - left).cast("long"))
    return done.select(
        *[F.col("__text").alias(text) if c == text else F.col(c) for c in docs.columns], "n_lines", "removed_lines"
    )


def op3_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs)


OP3_SQL = rf"""
with docs as (
  select row_number() over () as r, doc_id, text, coalesce(cast(doc_id as varchar), chr(1) || md5(coalesce(text, ''))) as doc
  from documents),
lines as (
  select r, unnest(l) as s, generate_subscripts(l, 1) as k
  from (select r, string_split(coalesce(text, ''), chr(10)) as l from docs)),
worded as (
  select *, row_number() over (partition by r order by k) as w from lines where regexp_matches(s, '[^\x20\x09-\x0D]')),
windows as (
  select r, w, s || chr(10) || lead(s) over (partition by r order by w) as chunk from worded
  qualify lead(s) over (partition by r order by w) is not null),
long_lines as (
  select r, w, s as chunk from worded
  where len(list_filter(string_split_regex(s, '[\x20\x09-\x0D]+'), lambda x: x <> '')) >= {LONG}),
firsts as (
  select chunk, min(doc_id) as keeper from (select * from windows union all select * from long_lines) join docs using (r)
  group by chunk),
numbered as (
  select r, w, chunk, row_number() over (partition by r, chunk order by w) as nth, count(*) over (partition by r, chunk) as n
  from windows),
marked as (
  select r, w, nth > 1 as later, nth = 1 and n > 1 as first,
    coalesce(doc_id is null and keeper is not null or doc_id > keeper, false) as lost
  from numbered join docs using (r) join firsts using (chunk)),
covering as (select r, w, later, first, lost from marked union all select r, w + 1, later, first, lost from marked),
covered as (
  select r, w, bool_or(later) as later, bool_or(first) as first, bool_or(lost) as lost from covering group by r, w),
alone as (
  select r, w, coalesce(doc_id is null and keeper is not null or doc_id > keeper, false) as lost
  from long_lines join docs using (r) join firsts using (chunk)),
goes as (
  select r, k from worded left join covered using (r, w) left join alone using (r, w)
  where coalesce(covered.lost, false) or coalesce(alone.lost, false) or coalesce(later and not first, false)),
kept as (select * from lines anti join goes using (r, k)),
rebuilt as (select r, string_agg(s, chr(10) order by k) as t, count(*) as n from kept group by r),
totals as (select r, count(*) as n_lines from lines group by r)
select doc_id, case when text is not null then coalesce(t, '') end as text,
  cast(case when text is null then 0 else n_lines end as bigint) as n_lines,
  cast(case when text is null then 0 when coalesce(t, '') = text then 0
    else n_lines - case when coalesce(t, '') = '' then 0 else n end end as bigint) as removed_lines
from docs left join totals using (r) left join rebuilt using (r)
"""
