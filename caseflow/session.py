"""Session settings and the shared folder that stage tables are written to."""

from __future__ import annotations

import atexit
import uuid

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

_folders: set[str] = set()


def use_utc(spark: SparkSession) -> SparkSession:
    """All timestamps are read, compared and formatted in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``, or one in the warehouse where
    that is unset: both can be reached by all executors."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    folder = configured or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def run_folder(spark: SparkSession) -> str:
    """Where this application writes its stage tables; removed when Python ends."""
    folder = f"{shared_dir(spark)}/caseflow/{spark.sparkContext.applicationId}"
    if not _folders:
        atexit.register(clear)
    _folders.add(folder)
    return folder


def clear(spark: SparkSession | None = None) -> None:
    """Remove what this application has written; frames that read it must not be used again."""
    context = spark.sparkContext if spark else SparkContext._active_spark_context
    if context is None:
        return
    for folder in sorted(_folders):
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
    _folders.clear()


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, in whatever store the path names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(at)


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; never reused, so no run overwrites another."""
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table below the shared folder that nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def materialise(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written parquet.

    Unlike a checkpointed plan the result keeps column pruning, filter pushdown and (with
    ``partition_by``) partition pruning, and it survives the loss of any executor.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
