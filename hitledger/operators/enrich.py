"""Lookups that add a column: CI provider by address prefix, package name, CI variables."""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitledger.functions import patterns as P
from hitledger.functions.addresses import digits, network
from hitledger.joins import join_by_hot_key
from hitledger.stages import shared

# Rows a prefix table may have to be broadcast: about 50 MB of short keys and names.
BROADCAST_ROWS = 500_000


def _aligned(prefixes: DataFrame) -> DataFrame:
    """(provider, cidr) -> (level, net, provider): prefixes widened to whole hex digits.

    A prefix that ends inside a digit becomes the up to 8 networks it covers at the next
    border. Of several prefixes with one network the longest wins, then the smaller provider
    name. ``net`` is the start of an address's ``digits``, so its length tells the level.
    """
    parts = F.split("cidr", "/")
    base = prefixes.select(
        "provider",
        digits(F.get(parts, F.lit(0))).alias("base"),
        F.get(parts, F.lit(1)).try_cast("int").alias("plen"),
    ).where(F.col("base").isNotNull() & F.col("plen").between(0, (F.length("base") - 2) * 4))
    level = F.ceil(F.col("plen") / 4).cast("int")
    span = F.pow(F.lit(2), level * 4 - F.col("plen")).cast("int")
    last = F.conv(F.substring("base", level + 2, F.lit(1)), 16, 10).cast("int")
    first = last - last % span
    tails = F.when(level == 0, F.array(F.lit(""))).otherwise(
        F.transform(F.sequence(first, first + span - 1), lambda n: F.hex(n))
    )
    nets = base.select(
        "provider",
        "plen",
        level.alias("level"),
        F.substring("base", F.lit(1), F.greatest(level + 1, F.lit(2))).alias("head"),
        F.explode(tails).alias("tail"),
    ).select("provider", "plen", "level", F.concat("head", "tail").alias("net"))
    return (
        nets.groupBy("level", "net")
        .agg(F.min(F.struct((-F.col("plen")).alias("shorter"), "provider")).alias("best"))
        .select("level", "net", F.col("best.provider").alias("provider"))
    )


@dataclass(frozen=True)
class PrefixTable:
    """Digit-aligned networks of a prefix dimension, with its size checked once.

    Up to ``BROADCAST_ROWS`` networks are fetched and kept as small local tables, one per
    level in use (at most 33). ``small`` is None for anything larger.
    """

    nets: DataFrame
    small: dict[int, DataFrame] | None

    @classmethod
    def build(cls, prefixes: DataFrame, most_rows: int | None = None) -> PrefixTable:
        most_rows = BROADCAST_ROWS if most_rows is None else most_rows
        nets = _aligned(prefixes)
        found = nets.limit(most_rows + 1).toArrow()
        if found.num_rows > most_rows:
            return cls(nets, None)
        spark = prefixes.sparkSession
        levels = found["level"]
        small = {
            level: spark.createDataFrame(
                found.filter(pc.equal(levels, level)).select(["net", "provider"])
            ).toDF(f"_net{level}", f"_provider{level}")
            for level in sorted(pc.unique(levels).to_pylist(), reverse=True)
        }
        return cls(nets, small)


def with_provider(rows: DataFrame, prefixes: PrefixTable, addr: str = "remote_addr") -> DataFrame:
    """Adds ``provider``: the owner of the longest prefix around the address, or ``<unknown>``.

    A prefix table of counted, broadcastable size is looked up with one hash join per level
    in use, longest first: the log itself is neither shuffled nor multiplied, and a hot
    address costs nothing extra. A larger table is joined against the distinct addresses.
    """
    if prefixes.small is None:
        return _with_provider_shuffled(rows, prefixes, addr)
    names = rows.columns
    keyed = rows.withColumn("_key", digits(F.col(addr)))
    out, owner = _probed(keyed, prefixes.small)
    return out.select(*names, F.coalesce(owner, F.lit(P.UNKNOWN_PROVIDER)).alias("provider"))


def _probed(keyed: DataFrame, tables: dict[int, DataFrame]) -> tuple[DataFrame, Column]:
    """Joins ``_key`` to each level's broadcast table; the owner found at the longest level."""
    for level, table in tables.items():
        same = network(F.col("_key"), level) == F.col(f"_net{level}")
        keyed = keyed.join(F.broadcast(table), same, "left")
    return keyed, F.coalesce(*[F.col(f"_provider{level}") for level in tables], F.lit(None))


# Up to four digits there are at most 2 * 69,905 networks, whatever the table holds.
_COARSE = (4, 3, 2, 1, 0)


def _with_provider_shuffled(rows: DataFrame, prefixes: PrefixTable, addr: str) -> DataFrame:
    """Prefix tables beyond the broadcast bound: look up distinct addresses, then join back.

    One job finds the owners of the distinct addresses; the rows are then read once, those of
    hot addresses joined by broadcast and the others by shuffle.
    """
    owners = shared(_owners(rows, prefixes, addr))
    named = owners.withColumnRenamed("_addr", addr)
    joined = join_by_hot_key(rows, named, addr, "_rows", "left")
    owner = F.coalesce("_owner", F.lit(P.UNKNOWN_PROVIDER)).alias("provider")
    return joined.select(*rows.columns, owner)


def _owners(rows: DataFrame, prefixes: PrefixTable, addr: str) -> DataFrame:
    """(_addr, _rows, _owner) per distinct address; no owner is NULL.

    Networks of up to four digits hold huge shares of all addresses but are few: they are
    broadcast. Longer ones meet the addresses in a join that treats hot networks apart.
    """
    nets = prefixes.nets
    counted = (
        rows.groupBy(F.col(addr).alias("_addr"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_addr").isNotNull())
    )
    keyed = shared(counted.withColumn("_key", digits(F.col("_addr"))))
    coarse = {level: _level_of(nets, level) for level in _COARSE}
    probed, coarse_owner = _probed(keyed, coarse)
    probed = probed.select("_addr", "_rows", coarse_owner.alias("_coarse"))

    fine_levels = F.sequence(F.lit(len(_COARSE)), F.length("_key") - 2)
    probes = (
        keyed.where(F.col("_key").isNotNull())
        .select("_addr", "_key", F.explode(fine_levels).alias("level"))
        .select("_addr", "level", F.substring("_key", F.lit(1), F.col("level") + 2).alias("net"))
    )
    fine_nets = nets.where(F.col("level") >= len(_COARSE)).select("net", "provider")
    met = probes.groupBy("net").agg(F.count(F.lit(1)).alias("_met"))
    found = shared(fine_nets.join(met, "net").select("net", "provider", "_met"))
    fine = (
        join_by_hot_key(probes, found, "net", "_met", "inner")
        .groupBy("_addr")
        .agg(F.max_by("provider", "level").alias("_fine"))
    )
    return probed.join(fine, "_addr", "left").select(
        "_addr", "_rows", F.coalesce("_fine", "_coarse").alias("_owner")
    )


def _level_of(nets: DataFrame, level: int) -> DataFrame:
    return nets.where(F.col("level") == level).select(
        F.col("net").alias(f"_net{level}"), F.col("provider").alias(f"_provider{level}")
    )


def is_ci() -> Column:
    return F.col("provider") != P.UNKNOWN_PROVIDER


def with_ci_flag(rows: DataFrame, prefixes: PrefixTable, addr: str = "remote_addr") -> DataFrame:
    return with_provider(rows, prefixes, addr).withColumn("is_ci", is_ci()).drop("provider")


def ci_rows(rows: DataFrame, prefixes: PrefixTable) -> DataFrame:
    return with_provider(rows, prefixes).where(is_ci()).drop("provider")


def non_ci_rows(rows: DataFrame, prefixes: PrefixTable) -> DataFrame:
    return with_provider(rows, prefixes).where(~is_ci()).drop("provider")


def first_names(registry: DataFrame) -> DataFrame:
    """One name per package: from the registry with the smallest priority, then by name."""
    return registry.groupBy("package_uuid").agg(
        F.min_by("name", F.struct("priority", "registry")).alias("name")
    )


def with_package_name(counts: DataFrame, registry: DataFrame, key: str = "package_uuid") -> DataFrame:
    """Left join with the first registry's name; NULL where no registry knows the package.

    Both sides are aggregated by package and small, so the strategy is left to Spark.
    """
    names = first_names(registry).withColumnRenamed("package_uuid", "_uuid")
    return counts.join(names, F.col(key) == F.col("_uuid"), "left").drop("_uuid")


def ci_variables(text: Column) -> Column:
    """``K=v;K=v`` as a map; of a repeated key the last value counts."""
    # last first, so that the first position of a key is the one that counts
    pairs = F.transform(F.reverse(F.split(text, ";")), lambda p: F.split(p, "=", 2))
    keys = F.transform(pairs, lambda p: p.getItem(0))
    values = F.transform(pairs, lambda p: F.get(p, F.lit(1)))
    sides = F.struct(keys.alias("k"), values.alias("v"))
    of_keys = F.transform(
        F.array(sides),
        lambda s: F.map_from_arrays(
            F.reverse(F.array_distinct(s["k"])),
            F.transform(
                F.reverse(F.array_distinct(s["k"])),
                lambda k: F.get(s["v"], (F.array_position(s["k"], k) - 1).cast("int")),
            ),
        ),
    )
    return F.when(text.isNotNull(), F.get(of_keys, F.lit(0)))


def is_ci_environment(text: Column) -> Column:
    """True when any CI variable is set to something other than ``n``."""
    return F.exists(F.map_values(ci_variables(text)), lambda v: v != "n")
