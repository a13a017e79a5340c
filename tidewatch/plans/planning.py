"""Queries on request planning: packing, batches, covers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import planner
from .tables import SIGNALS, signals


def _zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals(spark, sf_dir)[0].groupBy("InstanceType", "Region").agg(F.count("*").alias("n"))


def _support(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals(spark, sf_dir)[0].select(F.col("Region").alias("RegionCode"), "InstanceType").distinct()


def bin_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    bins = planner.bin_packed(_zones(spark, sf_dir))
    return bins.groupBy("InstanceType").agg(F.count_distinct("bin").alias("n_bins"), F.sum("n").alias("zones"))


def request_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    batches = planner.request_batches(planner.bin_packed(_zones(spark, sf_dir)))
    return batches.select("batch", F.explode("queries").alias("q")).select("batch", "q.instance", "q.n", F.array_join("q.regions", ",").alias("regions"))


def _shown(requests: DataFrame) -> DataFrame:
    return requests.select(F.array_join("regions", ",").alias("regions"), F.array_join("types", ",").alias("types"))


def cover_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(planner.covering_requests(_support(spark, sf_dir)))


def clustered_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(planner.clustered_requests(_support(spark, sf_dir)))


def grouped_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(planner.grouped_requests(_support(spark, sf_dir)))


def sampled_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planner.stratified_triples(signals(spark, sf_dir)[0], [3, 5, 7, 9])


def triples_by_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many triples of types each zone and all have by the sum of their scores."""
    per = planner.triple_counts(signals(spark, sf_dir)[0], [3, 4, 5, 6, 7, 8, 9]).groupBy("AZ", "total").agg(F.sum("n").alias("n"))
    whole = per.groupBy("total").agg(F.sum("n").alias("n")).select(F.lit("all").alias("AZ"), "total", "n")
    return per.unionByName(whole)


QUERIES = {f.__name__: f for f in (triples_by_sum, sampled_triples, bin_pack, request_batches, cover_requests, clustered_requests, grouped_requests)}

ORACLE_SQL = {
    # all triples of a zone, by joining its types
    "triples_by_sum": f"""{SIGNALS}, t AS (SELECT a.AZ, CAST(a.SPS + b.SPS + c.SPS AS INTEGER) AS total FROM scores a JOIN scores b ON b.AZ = a.AZ AND a.InstanceType < b.InstanceType
        JOIN scores c ON c.AZ = b.AZ AND b.InstanceType < c.InstanceType), per AS (SELECT AZ, total, count(*) AS n FROM t GROUP BY ALL)
      SELECT * FROM per UNION ALL SELECT 'all', total, CAST(sum(n) AS BIGINT) FROM per GROUP BY total""",
    # weights of 10 together are paired, ones fill what room there is, the rest is counted in twos with each number of threes by themselves
    "bin_pack": f"""{SIGNALS}, z AS (SELECT InstanceType, Region, count(*) AS n FROM scores GROUP BY ALL),
      w AS (SELECT InstanceType, CAST(sum(n) AS BIGINT) AS zones, CAST(sum(n // 10) AS BIGINT) AS whole, {", ".join(f"count(*) FILTER (n % 10 = {i}) AS n{i}" for i in range(1, 10))} FROM z GROUP BY ALL),
      r AS (SELECT InstanceType, zones, whole + n5 // 2 + {" + ".join(f"least(n{i}, n{10 - i})" for i in range(1, 5))} AS made, n5 % 2 AS a5,
        {", ".join(f"n{i} - least(n{i}, n{10 - i}) AS a{i}" for i in (1, 2, 3, 4, 6, 7, 8, 9))} FROM w),
      y AS (SELECT *, unnest(range(0, a3 + 1)) AS lone FROM r), j AS (SELECT *, unnest(range(0, least(a5, a3) + 1)) AS joined FROM y),
      u AS (SELECT *, a2 AS u1, a4 + lone AS u2, a6 + (a3 - joined - lone) // 2 + a5 - joined AS u3, a8 + a7 + joined AS u4 FROM j WHERE a3 - joined - lone >= 0 AND (a3 - joined - lone) % 2 = 0),
      v AS (SELECT *, u4 + greatest(u3, u2) - greatest(u2 - u3, 0) + (greatest(u2 - u3, 0) + 1) // 2 AS b, greatest(u1 - u4, 0) - 2 * greatest(u3 - u2, 0) - greatest(u2 - u3, 0) % 2 * 3 - greatest(u2 - u3, 0) // 2 AS o FROM u),
      m AS (SELECT InstanceType, min(b + (greatest(o, 0) + 4) // 5) AS core FROM v GROUP BY ALL)
      SELECT InstanceType, made + greatest(a9 + core, (a1 + 2 * a2 + 3 * a3 + 4 * a4 + 5 * a5 + 6 * a6 + 7 * a7 + 8 * a8 + 9 * a9 + 9) // 10) AS n_bins, zones FROM r JOIN m USING (InstanceType)""",
    "grouped_requests": f"""{SIGNALS}, s AS (SELECT DISTINCT Region AS r, InstanceType AS t FROM scores), p AS (SELECT r, count(*) AS n FROM s GROUP BY r),
      g AS (SELECT r, n >= 100 AS large, (row_number() OVER (PARTITION BY n >= 100 ORDER BY n DESC, r) - 1) // 8 AS g FROM p),
      rg AS (SELECT large, g, string_agg(r, ',' ORDER BY r) AS regions FROM g GROUP BY ALL),
      tg AS (SELECT large, g, t, (row_number() OVER (PARTITION BY large, g ORDER BY t) - 1) // 5 AS c FROM (SELECT DISTINCT large, g, t FROM s JOIN g USING (r)))
      SELECT regions, string_agg(t, ',' ORDER BY t) AS types FROM tg JOIN rg USING (large, g) GROUP BY regions, large, g, c""",
}
