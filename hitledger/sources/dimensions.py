"""Small inputs a job is given: CI prefixes, package registries, the hash secret."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CI_PREFIX_SCHEMA = "provider string, cidr string"
REGISTRY_SCHEMA = "package_uuid string, name string, registry string, priority int"


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    if path.rstrip("/").endswith((".csv", ".csv.gz")):
        return spark.read.schema(schema).option("header", True).csv(path)
    return spark.read.schema(schema).parquet(path)


def ci_prefixes(spark: SparkSession, path: str) -> DataFrame:
    return _table(spark, path, CI_PREFIX_SCHEMA)


def registries(spark: SparkSession, path: str) -> DataFrame:
    return _table(spark, path, REGISTRY_SCHEMA)


def read_secret(spark: SparkSession, path: str) -> bytes:
    """Bytes of one key file; they travel to the tasks inside the hash function."""
    rows = spark.read.format("binaryFile").load(path).select("content").collect()
    if len(rows) != 1:
        raise ValueError(f"expected one key file, found {len(rows)}: {path}")
    return bytes(rows[0].content)


def legacy_csv(spark: SparkSession, path: str, without: tuple[str, ...] = ()) -> DataFrame:
    """Parsed rows from CSV exports (plain, gzip or zstd), typed by the contract schema."""
    from pyspark.sql import types as T

    from hitledger.functions.layout import ACCESS_LOG

    schema = T.StructType([f for f in ACCESS_LOG.schema.fields if f.name not in without])
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)
