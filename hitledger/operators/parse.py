"""Raw lines -> typed rows, and the lines that did not parse -> reasons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hitledger.functions import patterns as P
from hitledger.functions.iphash import hll_hash
from hitledger.functions.layout import ACCESS_LOG, Field, Layout
from hitledger.functions.values import CASTS, absent_to_null, server_of

# Captured texts are separated by this character, which cannot occur inside a line.
_MARK = "\n"


def _captures(line: Column, layout: Layout, fields: Sequence[Field]) -> Column:
    """The captured texts of ``fields``, from a single pass of the regular expression.

    They follow an empty first element. A line that does not match yields itself alone.
    """
    marked = "".join(f"{_MARK}${layout.group_of[f.name]}" for f in fields)
    return F.split(F.regexp_replace(line, layout.regex, marked), _MARK)


def _matched(captures: Column, fields: Sequence[Field]) -> Column:
    return F.size(captures) == len(fields) + 1


def _present(captures: Column) -> Column:
    """Absent fields as NULL, for all captures at once: 25 separate rules would push the
    generated method beyond the size the JVM compiles."""
    return F.transform(captures, absent_to_null)


def _typed(captures: Column, fields: Sequence[Field]) -> list[Column]:
    return [CASTS[f.kind](captures.getItem(i)).alias(f.name) for i, f in enumerate(fields, start=1)]


def parse_lines(
    lines: DataFrame,
    line: str = "value",
    keep: Sequence[str] = (),
    file_name: Column | None = None,
    layout: Layout = ACCESS_LOG,
    only: Sequence[str] | None = None,
) -> DataFrame:
    """Typed rows of the lines that match ``layout``; ``keep`` columns pass through.

    The captures come out of a generator. Catalyst moves no filter and no projection below
    a generator, so each line meets the regular expression exactly once, however many of
    its fields a query filters on or returns. The generator also drops the other lines.
    For the same reason Catalyst cannot prune captures: a job that needs few fields names
    them in ``only``. Which lines match does not depend on it.
    """
    fields = [f for f in layout.captured if only is None or f.name in only]
    if only is not None and len(fields) != len(set(only)):
        unknown = sorted(set(only) - {f.name for f in layout.captured})
        raise ValueError(f"the layout has no such fields: {unknown}")
    # at least one group, so that a line that matches yields more than itself
    fields = fields or layout.captured[:1]
    wanted = [f for f in fields if only is None or f.name in only]
    matched = F.filter(
        F.array(_captures(F.col(line), layout, fields)), lambda c: _matched(c, fields)
    )
    server = [] if file_name is None else [server_of(file_name).alias("pkgserver")]
    return lines.select(
        *keep, *server, F.explode(F.transform(matched, _present)).alias("_captures")
    ).select(
        *keep,
        *_typed(F.col("_captures"), wanted),
        *["pkgserver" for _ in server],
    )


def parse_or_reject(
    lines: DataFrame,
    line: str = "value",
    keep: Sequence[str] = (),
    file_name: Column | None = None,
    layout: Layout = ACCESS_LOG,
) -> DataFrame:
    """Every line once, in one pass: ``record`` is ``row`` or ``reject``.

    Rejected lines keep their text in ``line`` and say which piece failed; the typed columns
    are NULL. Parsed lines have NULL there.
    """
    fields = layout.captured
    once = lines.select(
        *keep,
        F.col(line).alias("line"),
        (F.lit(None).cast("string") if file_name is None else server_of(file_name)).alias("pkgserver"),
        F.explode(F.array(_captures(F.col(line), layout, fields))).alias("_captures"),
    )
    ok = _matched(F.col("_captures"), fields)
    typed = once.withColumn("_row", F.when(ok, _present(F.col("_captures"))))
    return typed.select(
        *keep,
        F.when(ok, "row").otherwise("reject").alias("record"),
        *_typed(F.col("_row"), fields),
        "pkgserver",
        F.when(~ok, F.col("line")).alias("line"),
        F.when(~ok, reject_field(F.col("line"), layout)).alias("reject_field"),
        F.when(~ok, reject_class(F.col("line"), layout)).alias("reject_class"),
    )


def with_hll_hash(rows: DataFrame, secret: bytes = b"") -> DataFrame:
    return rows.withColumn("hll_hash", hll_hash(F.col("remote_addr"), secret))


def reject_field(line: Column, layout: Layout = ACCESS_LOG) -> Column:
    """Name of the first piece a line does not match; ``end_of_line`` for trailing text.

    Evaluated on rejected lines only, and each test only if the shorter ones passed.
    """
    out = None
    for n, spec in enumerate(layout.fields, start=1):
        test = ~line.rlike(layout.leading_regex(n))
        out = F.when(test, spec.name) if out is None else out.when(test, spec.name)
    return out.otherwise("end_of_line")


def reject_class(line: Column, layout: Layout = ACCESS_LOG) -> Column:
    """``known_noise`` for health checks, bots and site pages, else ``unknown``."""

    def captured(name: str, piece: str) -> Column:
        upto = [f.name for f in layout.fields].index(piece) + 1
        return F.regexp_extract(line, layout.leading_regex(upto), layout.group_of[name])

    url = captured("request_url", "request")
    agent = captured("http_user_agent", "http_user_agent")
    noise = url.isin(*P.NOISE_URLS)
    for prefix in P.NOISE_URL_PREFIXES:
        noise = noise | url.startswith(prefix)
    noise = noise | (F.lower(agent) == P.NOISE_AGENT)
    return F.when(noise, "known_noise").otherwise("unknown")


def rejected_lines(
    lines: DataFrame,
    line: str = "value",
    keep: Sequence[str] = (),
    layout: Layout = ACCESS_LOG,
) -> DataFrame:
    """The lines that do not match, with the failing piece and the noise class."""
    return lines.where(F.col(line).isNotNull() & ~F.col(line).rlike(layout.regex)).select(
        *keep,
        F.col(line).alias("line"),
        reject_field(F.col(line), layout).alias("reject_field"),
        reject_class(F.col(line), layout).alias("reject_class"),
    )


def next_token(line: Column, failed: Column, layout: Layout = ACCESS_LOG) -> Column:
    """The first word after the pieces that matched: what the failing piece met instead."""
    rest = None
    for n, spec in enumerate(layout.fields):
        matched = F.regexp_extract(line, layout.leading_regex(n), 0) if n else F.lit("")
        after = F.substring(line, F.length(matched) + 1, F.length(line))
        here = failed == spec.name
        rest = F.when(here, after) if rest is None else rest.when(here, after)
    everything = F.regexp_extract(line, layout.leading_regex(len(layout.fields)), 0)
    rest = rest.otherwise(F.substring(line, F.length(everything) + 1, F.length(line)))
    return F.nullif(F.regexp_extract(rest, r"^\s*(\S+)", 1), F.lit(""))


def reject_examples(
    rejects: DataFrame, per_field: int = 4, layout: Layout = ACCESS_LOG
) -> DataFrame:
    """Up to ``per_field`` unexplained lines per failing piece, as a report would show them.

    Spark cuts a ranking window to the limit in every task before the shuffle, so a piece
    that fails for most lines sends ``per_field`` lines per task, not all of them.
    """
    order = W.partitionBy("reject_field").orderBy("line")
    examples = (
        rejects.where(F.col("reject_class") == "unknown")
        .withColumn("example", F.row_number().over(order))
        .where(F.col("example") <= per_field)
    )
    return examples.withColumn("next_token", next_token(F.col("line"), F.col("reject_field"), layout))
