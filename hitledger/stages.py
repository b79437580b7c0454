"""Cutting a plan at an intermediate result that several later steps share."""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

#: Used on local masters only, where driver and executors are one process.
LOCAL_FOLDER = "file:///tmp/checkpoints"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Where it is unset a local master gets a fixed folder; a cluster gets an error, because
    part files written to the executors' own disks would be missing from later reads.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    local = spark.conf.get("spark.master", "").split("[")[0] == "local"
    if not folder:
        if not local:
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        return LOCAL_FOLDER
    return folder.rstrip("/")


_made: list[tuple[str, object]] = []


def new_folder(spark: SparkSession, kind: str) -> str:
    """A path below the shared folder that nothing else uses.

    What is there when the driver's Python ends is deleted; a killed driver leaves it.
    """
    path = f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}"
    _made.append((path, spark._jsc.hadoopConfiguration()))
    return path


@atexit.register
def _delete_made() -> None:
    for path, configuration in _made if SparkContext._jvm else ():
        with contextlib.suppress(Exception):  # the JVM may be gone already
            _delete(SparkContext._jvm, path, configuration)


def _delete(jvm, folder: str, configuration) -> None:
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(configuration).delete(path, True)


def shared(df: DataFrame) -> DataFrame:
    """Computes ``df`` once into a table in the shared folder, so it survives lost executors.

    Unlike a checkpoint the table keeps column statistics, and is computed in one job.
    """
    spark = df.sparkSession
    path = new_folder(spark, "stage")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stage(df: DataFrame) -> None:
    """Deletes the folder behind a table made by ``shared`` once no plan needs it any more."""
    spark = df.sparkSession
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        if folder.rsplit("/", 1)[-1].startswith("stage-"):
            _delete(spark._jvm, folder, spark._jsc.hadoopConfiguration())
