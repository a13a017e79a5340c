"""The given tables read as market signals: events are ticks, line items offers, suppliers zones, nations regions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.store import shared_folder, stored  # noqa: F401

KEYS = ["user_id", "event_type"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``k`` from their properties, and the ``score`` and ``capacity`` of a tick."""
    e = read(spark, sf_dir, "events")
    return e.withColumn("k", F.get_json_object("props", "$.k").try_cast("int"))


#: DuckDB's view of ``ticks``; to be followed by further views and a query.
TICKS = "WITH ticks AS (SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)"


def signals(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Scores by (InstanceType, Region, AZ), frequencies and on-demand prices by (InstanceType, Region), spot prices by
    (InstanceType, AZ).  Some frequencies and prices are missing."""
    supplier = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    part = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    items = read(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    # partial sums by offer first: the joins then see a row for each part and supplier
    items = items.groupBy("l_partkey", "l_suppkey").agg(F.count("*").alias("n"), F.max("l_extendedprice").alias("hi"), F.min("l_extendedprice").alias("lo"))
    offers = items.join(part, "l_partkey").join(supplier, "l_suppkey")
    zone = F.concat(F.lit("az"), F.col("l_suppkey").cast("string"))
    offers = offers.select(F.col("p_brand").alias("InstanceType"), F.concat(F.lit("r"), F.col("s_nationkey").cast("string")).alias("Region"), zone.alias("AZ"), "n", "hi", "lo")
    offers = offers.groupBy("InstanceType", "Region", "AZ").agg(F.sum("n").alias("n"), F.max("hi").alias("hi"), F.min("lo").alias("lo"))
    offers = stored(offers, "offers")  # all four tables are made of it
    score = (1 + F.col("n") % 3).cast("int")
    scores = offers.select("InstanceType", "Region", "AZ", score.alias("SPS"), F.when(score >= 3, 5).otherwise(0).alias("T3"), F.when(score == 2, 5).otherwise(0).alias("T2"))
    regional = offers.groupBy("InstanceType", "Region").agg(F.sum("n").alias("n"), F.max("hi").alias("hi"))
    frequencies = regional.where("n % 7 <> 0").select("InstanceType", "Region", (1 + F.col("n") % 5 * 0.5).cast("double").alias("IF"))
    ondemand = regional.where("n % 5 <> 0").select("InstanceType", "Region", (F.col("hi") / 1000).alias("OndemandPrice"))
    spot = offers.where("n % 4 <> 0").select("InstanceType", "AZ", (F.col("lo") / 1000).alias("SpotPrice"))
    return scores, frequencies, ondemand, spot


#: DuckDB's views of ``signals``.
SIGNALS = """WITH offers AS (SELECT p_brand AS InstanceType, 'r' || s_nationkey AS Region, 'az' || l_suppkey AS AZ, count(*) AS n,
    max(l_extendedprice) AS hi, min(l_extendedprice) AS lo FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey GROUP BY ALL),
  scores AS (SELECT InstanceType, Region, AZ, CAST(1 + n % 3 AS INTEGER) AS SPS, CASE WHEN 1 + n % 3 >= 3 THEN 5 ELSE 0 END AS T3,
    CASE WHEN 1 + n % 3 = 2 THEN 5 ELSE 0 END AS T2 FROM offers),
  regional AS (SELECT InstanceType, Region, CAST(sum(n) AS BIGINT) AS n, max(hi) AS hi FROM offers GROUP BY ALL),
  frequencies AS (SELECT InstanceType, Region, CAST(1 + (n % 5) * 0.5 AS DOUBLE) AS "IF" FROM regional WHERE n % 7 <> 0),
  ondemand AS (SELECT InstanceType, Region, hi / 1000 AS OndemandPrice FROM regional WHERE n % 5 <> 0),
  spot AS (SELECT InstanceType, AZ, lo / 1000 AS SpotPrice FROM offers WHERE n % 4 <> 0)"""
