"""Hit counts: per package, artifact, day; splits, totals, top-k, wide reports.

Every report starts from one pre-aggregated table (``daily_hits``): one row per kind, key
and day. Spark combines map-side before the shuffle, so a package that draws a third of all
requests is one partial row per task. The later steps (day trim, ranking, zero filling,
pivot, names) only see that small table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitledger.functions import patterns as P
from hitledger.functions.values import month_day

PACKAGE, ARTIFACT = "package", "artifact"


def is_package_request(url: str = "request_url") -> Column:
    return F.col(url).startswith(P.PACKAGE_PREFIX)


def is_artifact_request(url: str = "request_url") -> Column:
    return F.col(url).startswith(P.ARTIFACT_PREFIX)


def request_kind(url: str = "request_url") -> Column:
    return F.when(is_package_request(url), PACKAGE).when(is_artifact_request(url), ARTIFACT)


def count_by(rows: DataFrame, **keys: Column) -> DataFrame:
    """Group by any named key expressions; NULL keys form their own group."""
    return rows.groupBy(*[k.alias(name) for name, k in keys.items()]).agg(
        F.count(F.lit(1)).alias("n")
    )


def ranked(counts: DataFrame, key: str, n: str = "n") -> DataFrame:
    """Largest first; equal counts in key order."""
    return counts.orderBy(F.desc(n), F.asc_nulls_last(key))


def hits_by_package(rows: DataFrame) -> DataFrame:
    return count_by(rows.where(is_package_request()), package_uuid=F.col("package_uuid"))


def hits_by_artifact(rows: DataFrame) -> DataFrame:
    return count_by(rows.where(is_artifact_request()), artifact_hash=F.col("artifact_hash"))


def split_totals(hits: DataFrame) -> DataFrame:
    """Package and artifact requests by CI flag; all four rows, absent ones with 0.

    ``hits`` has ``kind``, ``is_ci`` and a count ``n``: single requests or pre-aggregated ones.
    """
    cells = [(kind, ci) for kind in (PACKAGE, ARTIFACT) for ci in (False, True)]
    summed = hits.agg(
        *[
            F.sum(F.when((F.col("kind") == kind) & (F.col("is_ci") == ci), F.col("n"))).alias(f"{kind}_{ci}")
            for kind, ci in cells
        ]
    )
    rows = [
        F.struct(
            F.lit(kind).alias("kind"),
            F.lit(ci).alias("is_ci"),
            F.coalesce(f"{kind}_{ci}", F.lit(0)).cast("bigint").alias("n"),
        )
        for kind, ci in cells
    ]
    return summed.select(F.inline(F.array(*rows)))


def single_requests(rows: DataFrame) -> DataFrame:
    """(kind, is_ci, n = 1) of package and artifact requests."""
    requests = rows.where(is_package_request() | is_artifact_request())
    return requests.select(request_kind().alias("kind"), "is_ci", F.lit(1).alias("n"))


# --- days -----------------------------------------------------------------------------


def hits_by_key_and_day(rows: DataFrame, *more: str) -> DataFrame:
    """(*more, kind, key, day, n) of package and artifact requests; no time is no day."""
    key = F.when(is_package_request(), F.col("package_uuid")).otherwise(F.col("artifact_hash"))
    return (
        rows.where(is_package_request() | is_artifact_request())
        .groupBy(
            *more,
            request_kind().alias("kind"),
            key.alias("key"),
            F.to_date("time_utc").alias("day"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )


def daily_hits(rows: DataFrame) -> DataFrame:
    """(kind, key, day, n) of package and artifact requests that carry a time."""
    return hits_by_key_and_day(rows).where(F.col("day").isNotNull())


def _package_days(daily: DataFrame) -> DataFrame:
    return daily.where(F.col("kind") == PACKAGE).select("day").distinct()


def plotted_days(daily: DataFrame) -> DataFrame:
    """Distinct package days without the first and the last one (time-zone edges)."""
    days = _package_days(daily)
    return days.where(_inside(days, "day"))


def plotted_day_labels(daily: DataFrame) -> DataFrame:
    """The same trim on ``MM/DD`` labels in text order.

    Differs from ``plotted_days`` only for windows that cross New Year, where text order
    puts the newest days first.
    """
    labels = (
        daily.where(F.col("kind") == PACKAGE).select(month_day(F.col("day")).alias("label")).distinct()
    )
    return labels.where(_inside(labels, "label"))


def _inside(days: DataFrame, name: str) -> Column:
    """Strictly between the extremes, which Spark computes as one-value subqueries."""
    first = days.agg(F.min(name)).scalar()
    last = days.agg(F.max(name)).scalar()
    return (F.col(name) > first) & (F.col(name) < last)


def totals(trimmed: DataFrame) -> DataFrame:
    return trimmed.groupBy("key").agg(F.sum("n").alias("total"))


def top_keys(trimmed: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` keys with most hits (the NULL key may rank; fewer keys: all of them)."""
    return ranked(totals(trimmed), "key", "total").limit(k)


def zero_filled(trimmed: DataFrame, days: Sequence[date]) -> DataFrame:
    """One row per key and day of ``days``; pairs without hits get 0.

    Each key's counts are folded into a map of at most one entry per calendar day, then
    read back for every day, so no key/day product has to be joined.
    """
    per_key = trimmed.groupBy("key").agg(
        F.map_from_entries(F.collect_list(F.struct("day", "n"))).alias("by_day")
    )
    every_day = F.explode(F.lit(list(days)).cast("array<date>")).alias("day")
    return per_key.select("key", "by_day", every_day).select(
        "key", "day", F.coalesce(F.try_element_at("by_day", F.col("day")), F.lit(0)).alias("n")
    )


def wide_report(trimmed: DataFrame, days: Sequence[date], key: str) -> DataFrame:
    """One row per key: ``total_downloads`` and one ``MM/DD`` column per day; no NULL key.

    ``days`` names the columns, so it has to be known when the plan is built. The per-day
    counts exist already, so a cell adds up few rows and no raw row is pivoted.
    """
    labels = list(dict.fromkeys(d.strftime("%m/%d") for d in days))
    return (
        trimmed.where(F.col("key").isNotNull())
        .withColumn("label", month_day(F.col("day")))
        .groupBy(F.col("key").alias(key))
        .agg(
            F.sum("n").alias("total_downloads"),
            *[
                F.coalesce(F.sum(F.when(F.col("label") == d, F.col("n"))), F.lit(0)).alias(d)
                for d in labels
            ],
        )
    )


@dataclass(frozen=True)
class DailyHits:
    """The pre-aggregated counts of one report window and its plotted days.

    ``days`` is a Python list because the wide reports need it for their columns. Parsed
    times have four-digit years, so it holds fewer than 3.7 million dates whatever the log
    says, and in practice as many as the window has days.
    """

    table: DataFrame
    days: list[date]

    @classmethod
    def of(cls, table: DataFrame) -> DailyHits:
        """``table`` is the result of ``daily_hits``, written or checkpointed: it is read often."""
        return cls(table, sorted(r.day for r in plotted_days(table).collect()))

    def trimmed(self, kind: str) -> DataFrame:
        """(key, day, n) of one kind on the plotted days, which always come from packages."""
        chosen = self.table.where(F.col("kind") == kind)
        return chosen.join(plotted_days(self.table), "day", "left_semi").select("key", "day", "n")

    def by_day(self, kind: str, name: str) -> DataFrame:
        present = self.trimmed(kind).where(F.col("key").isNotNull())
        return zero_filled(present, self.days).withColumnRenamed("key", name)

    def wide(self, kind: str, name: str) -> DataFrame:
        return wide_report(self.trimmed(kind), self.days, name)

    def top_series(self, kind: str = PACKAGE, k: int = 10, keep_missing: bool = True) -> DataFrame:
        """Zero-filled daily series of the ``k`` most requested keys."""
        trimmed = self.trimmed(kind)
        if not keep_missing:
            trimmed = trimmed.where(F.col("key").isNotNull())
        top = top_keys(trimmed, k).select(F.col("key").alias("top_key"))
        chosen = trimmed.join(top, F.col("key").eqNullSafe(F.col("top_key")), "left_semi")
        return zero_filled(chosen, self.days)


# --- distinct values ------------------------------------------------------------------


def count_distinct_of(rows: DataFrame, name: str) -> DataFrame:
    """Exact number of different non-NULL values; pre-deduplicated map-side."""
    return rows.agg(F.count_distinct(F.col(name)).alias("n"))


def present_values(rows: DataFrame, name: str) -> DataFrame:
    return rows.select(name).where(F.col(name).isNotNull())
