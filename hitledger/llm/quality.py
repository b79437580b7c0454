"""Quality rules: repetition and symbol counts, and a log-likelihood ratio of hashed n-grams.

Every document gets the mean, over its token unigrams and bigrams, of the log ratio between two
multinomials over hashed n-grams: one of trusted documents, one of the whole raw corpus. The mean
is normalised for length and compared with a fixed threshold, so reruns agree.

Everything runs in DataFrame expressions. The raw counts cover every document; the trusted ones
come from the ``TRUSTED`` labelled documents with the smallest id hash. The log ratios are one
array of ``BUCKETS`` numbers.

Defined results: null and empty texts have no words and fail the base rules; without trusted
documents every ratio is 0, so only the base rules decide; repeated rows are judged one by one and
alike; an empty table gives an empty result; columns named like a result are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitledger.llm.common import let, text_or_empty, words

BUCKETS = 1 << 16
#: Bound of the labelled documents that the trusted multinomial is fitted on.
TRUSTED = 20_000
#: Least mean log ratio of a kept document.
THRESHOLD = -0.25
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
#: Runs of letters and digits, and runs of anything else but white space.
TOKEN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"


def repeat_words(tokens: Column, window: int = WINDOW) -> Column:
    """Words that lie in a window of words found at least twice; each counts once."""

    def covered(found: Column) -> Column:
        marked = F.sort_array(F.transform(found, lambda v, i: F.struct(v.alias("v"), i.alias("i"))))

        def twice(m: Column) -> Column:
            return F.filter(
                m,
                lambda s, k: F.coalesce(F.get(m, k - 1)["v"] == s["v"], F.lit(False))
                | F.coalesce(F.get(m, k + 1)["v"] == s["v"], F.lit(False)),
            )

        places = F.sort_array(F.transform(let(marked, twice), lambda s: s["i"]))
        start = F.struct(F.lit(-window).alias("last"), F.lit(0).cast("long").alias("sum"))
        return F.aggregate(
            places,
            start,
            lambda a, p: F.struct(
                p.alias("last"), (a["sum"] + F.least(F.lit(window), p - a["last"])).alias("sum")
            ),
        )["sum"]

    def of_hashes(h: Column) -> Column:
        found = F.transform(
            F.sequence(F.lit(0), F.size(h) - window),
            lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(window)]),
        )
        return let(
            found,
            lambda f: F.when(F.size(F.array_distinct(f)) == F.size(f), F.lit(0).cast("long")).otherwise(covered(f)),
        )

    hashes = F.transform(tokens, lambda w: F.xxhash64(w))
    return let(hashes, lambda h: F.when(F.size(h) < window, F.lit(0).cast("long")).otherwise(of_hashes(h)))


def hashed_ngrams(text: Column, buckets: int = BUCKETS) -> Column:
    """Buckets of all token unigrams and bigrams."""
    hashes = F.transform(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)), lambda t: F.crc32(t.cast("binary")))

    def pairs(h: Column) -> Column:
        two = F.zip_with(
            F.slice(h, 1, F.greatest(F.size(h) - 1, F.lit(0))),
            F.slice(h, 2, F.greatest(F.size(h) - 1, F.lit(0))),
            lambda a, b: ((a * 1000003 + b) % buckets).cast("int"),
        )
        return F.concat(F.transform(h, lambda a: (a % buckets).cast("int")), two)

    return let(hashes, pairs)


def trusted_ids(labels: DataFrame, bound: int = TRUSTED) -> DataFrame:
    """Ids of the trusted documents: quality 1, at most ``bound``, smallest id hash first."""
    ids = labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()
    return ids.orderBy(F.md5(F.col("doc_id").cast("string").cast("binary")), "doc_id").limit(bound)


def log_ratios(docs: DataFrame, trusted: DataFrame, text: str, doc_id: str) -> DataFrame:
    """One row with ``ratios``: ln of trusted over raw probability by bucket, add-one smoothed."""
    marked = trusted.select(F.col("doc_id").alias("__id"), F.lit(1).alias("__good"))
    grams = (
        docs.select(F.col(doc_id).alias("__id"), text_or_empty(text).alias("__text"))
        .join(F.broadcast(marked), "__id", "left")
        .select(F.coalesce("__good", F.lit(0)).alias("good"), F.explode(hashed_ngrams(F.col("__text"))).alias("bucket"))
    )
    counts = grams.groupBy("bucket").agg(F.sum("good").alias("good"), F.count("*").alias("raw"))
    cells = docs.sparkSession.range(0, BUCKETS, 1, 1).select(F.col("id").cast("int").alias("bucket"))
    filled = cells.join(counts, "bucket", "left").na.fill(0, ["good", "raw"])
    gathered = filled.agg(
        F.sum("good").alias("n_good"),
        F.sum("raw").alias("n_raw"),
        F.sort_array(F.collect_list(F.struct("bucket", "good", "raw"))).alias("cells"),
    )
    ratio = lambda c: (
        F.log((c["good"] + 1) / (F.col("n_good") + BUCKETS)) - F.log((c["raw"] + 1) / (F.col("n_raw") + BUCKETS))
    )
    return gathered.select(
        F.transform("cells", lambda c: F.when(F.col("n_good") == 0, F.lit(0.0)).otherwise(ratio(c))).alias("ratios")
    )


def judge(docs: DataFrame, trusted: DataFrame, *, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Adds the counts, ``llr`` (mean log ratio), ``base_failed`` and ``kept`` to every document."""
    ratios = log_ratios(docs, trusted, text, doc_id).scalar()
    body = text_or_empty(text)
    grams = hashed_ngrams(body)
    tokens = words(body)
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    llr = let(
        F.struct(grams.alias("g"), F.col("__ratios").alias("r")),
        lambda s: F.aggregate(s["g"], F.lit(0.0), lambda a, b: a + F.get(s["r"], b)) / F.greatest(F.size(s["g"]), F.lit(1)),
    )
    # a subquery may not stand inside a lambda; the optimizer merges this column into its one use,
    # which has to stay alone in its projection, or the array would be written into every row
    docs = docs.withColumn("__ratios", ratios).withColumn("llr", llr).drop("__ratios")
    # the words are found once for the three counts that need them
    of_words = let(
        tokens,
        lambda w: F.struct(
            F.size(w).cast("long").alias("n"),
            F.length(F.array_join(w, "")).cast("long").alias("chars"),
            repeat_words(w).alias("repeated"),
        ),
    )
    # no filter moves below a generator, so one on ``kept`` doesn't evaluate all this again
    measured = docs.select("*", F.explode(F.array(of_words)).alias("__of_words")).withColumns(
        {
            "n_words": F.col("__of_words")["n"],
            "word_chars": F.col("__of_words")["chars"],
            "n_symbols": (F.size(F.split(body, f"[{SYMBOLS}]")) - 1).cast("long"),
            "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
            "n_repeat_words": F.col("__of_words")["repeated"],
        }
    )
    measured = measured.drop("__of_words")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return measured.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("llr") >= THRESHOLD)
    )


def op5_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return judge(docs, trusted_ids(labels)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


#: crc32 of distinct strings, for engines without it: the table by rule, then byte by byte.
CRC_SQL = r"""
crc_table as (
  select list(c order by i) as tab from (
    select i, list_reduce(list_prepend(i, range(8)), lambda c, k:
      case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as c
    from range(256) r(i))),
crcs as (
  select s, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(0, len(h), 2),
      lambda i: cast('0x' || substr(h, i + 1, 2) as bigint))),
    lambda c, b: xor(c >> 8, tab[1 + (xor(c, b) & 255)]))) as crc
  from (select s, hex(encode(s)) as h from strings) cross join crc_table)"""

OP5_SQL = rf"""
with docs as (
  select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
tokens as (
  select r, unnest(t) as s, generate_subscripts(t, 1) as k
  from (select r, regexp_extract_all(text, '{TOKEN}') as t from docs)),
strings as (select distinct s from tokens),{CRC_SQL},
coded as (
  select r, crc, lead(crc) over (partition by r order by k) as after
  from tokens join crcs using (s)),
grams as (
  select r, crc % {BUCKETS} as b from coded
  union all select r, (crc * 1000003 + after) % {BUCKETS} from coded where after is not null),
trusted as (
  select doc_id from (select distinct doc_id from labels where quality = 1 and doc_id is not null)
  order by md5(cast(doc_id as varchar)), doc_id limit {TRUSTED}),
counts as (
  select b, count(*) as raw, count(t.doc_id) as good
  from grams join docs using (r) left join trusted t using (doc_id) group by b),
sums as (select sum(raw) as n_raw, sum(good) as n_good from counts),
ratios as (
  select b, case when n_good = 0 then 0 else
    ln((good + 1) / (n_good + {BUCKETS})) - ln((raw + 1) / (n_raw + {BUCKETS})) end as ratio
  from counts, sums),
llr as (select r, sum(ratio) / count(*) as llr from grams join ratios using (b) group by r),
split as (
  select r, text, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') as w,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as l
  from docs),
windows as (
  select r, i, list_slice(w, i, i + 4) as g
  from (select r, w, unnest(range(1, len(w) - 3)) as i from split where len(w) >= 5)),
twice as (select r, i from (select r, i, count(*) over (partition by r, g) as n from windows) where n > 1),
covered as (select r, count(distinct i + k) as n from twice, range(5) x(k) group by r),
measured as (
  select doc_id, cast(len(w) as bigint) as n_words,
    cast(length(array_to_string(w, '')) as bigint) as word_chars,
    cast(length(split.text) - length(translate(split.text, '{SYMBOLS}', '')) as bigint) as n_symbols,
    cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines,
    cast(coalesce(n, 0) as bigint) as n_repeat_words, coalesce(llr, 0) as llr
  from split left join docs using (r) left join covered using (r) left join llr using (r))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words as base_failed,
  not (n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) and llr >= {THRESHOLD} as kept
from measured
"""
