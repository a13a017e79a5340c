"""Spot-market analytics on Spark: snapshots, change logs, series and request planning as DataFrames."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def ready(spark: SparkSession) -> SparkSession:
    """Lets Python workers that start on a machine with this checkout import the package; elsewhere ship it with --py-files."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
    return spark
