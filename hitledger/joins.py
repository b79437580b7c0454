"""Joining many rows per key with one, where some keys hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is hot when it has more than this share of all rows; so there are at most 1000.
HOT_SHARE = 1000


def join_by_hot_key(
    left: DataFrame, right: DataFrame, key: str, rows: str, how: str, fits: Column | None = None
) -> DataFrame:
    """Joins many rows per key (``left``) with one row per key (``right``).

    ``right.rows`` counts the left rows of its key. Keys with over a thousandth of them all, at
    most 1000 by arithmetic, go by broadcast; the rest by shuffle, where hot rows and null keys
    carry spread keys that match nothing. ``how`` is inner or left; ``left`` is read once,
    ``right`` three times, so it should be a written table. ``fits``, a condition on ``right``, names
    the rows short enough to be broadcast; needed where values have no greatest length.
    """
    values = [c for c in right.columns if c != key]
    total = right.agg(F.coalesce(F.sum(rows), F.lit(0))).first()[0]
    is_hot = F.col(rows) * HOT_SHARE > total
    if fits is not None:
        is_hot = is_hot & F.coalesce(fits, F.lit(False))
    packed = F.struct(*values)
    hot = F.broadcast(right.where(is_hot).select(F.col(key).alias("__key"), packed.alias("__hot")))
    cold = right.where(~is_hot).select(F.col(key).cast("string").alias("__key"), packed.alias("__cold"))
    spread = F.concat(F.lit("\x00"), F.monotonically_increasing_id().cast("string"))
    probed = left.join(hot, left[key] == hot["__key"], "left").drop("__key")
    probed = probed.withColumn(
        "__key", F.when(F.col("__hot").isNull() & F.col(key).isNotNull(), F.col(key).cast("string")).otherwise(spread)
    )
    joined = probed.join(cold, "__key", "left").withColumn("__hot", F.coalesce("__hot", "__cold"))
    if how == "inner":
        joined = joined.where(F.col("__hot").isNotNull())
    return joined.select(*left.columns, *[F.col("__hot")[v].alias(v) for v in values])
