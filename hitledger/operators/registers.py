"""Distinct-client estimates from stored register updates (``hll_hash``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitledger.functions import patterns as P
from hitledger.functions.iphash import bucket_of, rank_of


def registers(rows: DataFrame, keys: Sequence[str], hashed: str = "hll_hash") -> DataFrame:
    """Largest rank per group and bucket: at most 4096 rows per group, also map-side."""
    return (
        rows.where(F.col(hashed).isNotNull())
        .groupBy(*keys, bucket_of(F.col(hashed)).alias("bucket"))
        .agg(F.max(rank_of(F.col(hashed))).alias("rank"))
    )


def merged(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Registers of coarser groups, e.g. of a month from its days."""
    return parts.groupBy(*keys, "bucket").agg(F.max("rank").alias("rank"))


def estimated(regs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct clients per group: harmonic mean, or linear counting while buckets are empty."""
    m = float(P.REGISTERS)
    alpha = 0.7213 / (1 + 1.079 / m)
    zeros = F.lit(m) - F.col("_filled")
    raw = F.lit(alpha * m * m) / (F.col("_mass") + zeros)
    small = (raw <= 2.5 * m) & (zeros > 0)
    linear = F.lit(m) * F.ln(F.lit(m) / F.greatest(zeros, F.lit(1.0)))
    return (
        regs.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).cast("double").alias("_filled"),
            F.sum(F.pow(F.lit(2.0), -F.col("rank"))).alias("_mass"),
        )
        .select(*keys, F.when(small, linear).otherwise(raw).alias("clients"))
    )


def estimate_clients(rows: DataFrame, keys: Sequence[str], hashed: str = "hll_hash") -> DataFrame:
    return estimated(registers(rows, keys, hashed), keys)
