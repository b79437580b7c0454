"""Reading tables that may not exist yet."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_if_present(
    spark: SparkSession, path: str, schema: T.StructType | str, **options: str | bool
) -> DataFrame | None:
    """A Parquet folder with a known schema, None where the folder does not exist."""
    try:
        return spark.read.schema(schema).options(**options).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
