"""Tables that a job writes once and reads several times, in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a local one of our own only in local mode, as in tests."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = getattr(spark, "_tidewatch_shared", None) or tempfile.mkdtemp(prefix="tidewatch-")
        spark._tidewatch_shared = base
    return f"{base.rstrip('/')}/tidewatch/{spark.sparkContext.applicationId}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table read back: cuts lineage, survives lost executors, computes once.

    Tables stay until ``release``, as results that are not computed yet read them.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._tidewatch_path = path
    return table


def discard(table: DataFrame) -> None:
    """Deletes what ``written`` has written, when nothing reads it any more."""
    _deleted(table.sparkSession, table._tidewatch_path)


def release(spark: SparkSession) -> None:
    """Deletes all tables this application has written here; call it once their readers' results are stored."""
    _deleted(spark, shared_dir(spark))


def _deleted(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
