"""Queries on relations: projections, filters, joins, aggregations, sets and lookups."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import diff, index, merge, planner, query
from ..sources import records, sinks
from .tables import SIGNALS, TICKS, read, shared_folder, signals, ticks


def savings_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part").select("p_partkey", F.col("p_retailprice").alias("od"), (F.col("p_retailprice") * (F.col("p_size") % 3 + 1) / 4).alias("spot"))
    p = p.withColumn("od", F.when(F.col("p_partkey") % 10 == 0, None).when(F.col("p_partkey") % 10 == 1, 0.0).otherwise(F.col("od")))
    od, spot = F.col("od"), F.col("spot")
    return p.select(
        "p_partkey", S.savings_truncated(od, spot).alias("truncated"), F.round(S.savings_exact(od, spot), 6).alias("exact"),
        S.savings_even(od, spot).alias("even"), S.savings_shown(od, spot).alias("shown"),
    )


def bucket_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part").select("p_partkey", F.concat(F.col("p_size") % 6 * 5, F.lit("-"), F.col("p_size") % 6 * 5 + 5).alias("b"))
    label = F.when(F.col("p_partkey") % 4 == 0, "High").when(F.col("p_partkey") % 4 == 1, "Low").when(F.col("p_partkey") % 4 == 2, "2").otherwise("none")
    return p.select(
        "p_partkey", S.mapped(F.col("b"), S.EVICTION_SCORES).alias("eviction"), S.mapped(F.concat("b", F.lit("%")), S.INTERRUPTION_SCORES).alias("interruption"),
        S.mapped(F.concat("b", F.lit("%")), S.RESEARCH_SCORES).alias("research"), S.score_number(label).alias("score"),
    )


def sku_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.when(F.col("c_custkey") % 3 == 0, "Standard_").when(F.col("c_custkey") % 3 == 1, "Basic_").otherwise(""), F.lower("c_mktsegment"), F.lit("_v"), F.col("c_custkey").cast("string"))
    sku = F.when(F.col("c_custkey") % 11 == 0, "Standard").otherwise(name)
    c = read(spark, sf_dir, "customer").select("c_custkey", sku.alias("sku"), F.concat_ws(" ", "c_mktsegment", F.lit("x"), "c_name").alias("meter"))
    return c.select("c_custkey", S.sku_tier(F.col("sku")).alias("tier"), S.sku_type(F.col("sku")).alias("type"), S.capitalised(F.col("sku")).alias("capital"), S.without_last_word(F.col("meter")).alias("meter"), S.machine_family(F.concat("sku", F.lit("-8"))).alias("family"))


def regex_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "pages")
    return p.select("page_id", F.regexp_extract("url", r"^https?://([^/]+)/", 1).alias("host"), F.regexp_extract("url", r"page=([0-9]+)", 1).alias("page"), F.split_part("url", F.lit("/"), F.lit(4)).alias("part"))


def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks(spark, sf_dir).where(F.length("props") > 0).groupBy("event_type").agg(F.sum("k").alias("k"), F.count_distinct("k").alias("kinds"), F.max("k").alias("top"))


def filter_not_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part")
    words = F.split(F.trim("p_type"), r"\s+")
    out = p.where(~F.contains("p_name", F.lit("bolt")) & ~F.get(words, F.lit(0)).isin("PROMO", "LARGE") & ~F.coalesce(F.contains(F.lower("p_brand"), F.lit("#11")), F.lit(False)))
    return out.select("p_partkey", "p_name", "p_type")


def region_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = read(spark, sf_dir, "nation").select("n_nationkey", F.element_at(F.lit(["us-east-1", "ap-northeast-2", "eu-central-1", "us-gov-west-1", "ap-southeast-1", "nowhere"]), F.col("n_nationkey") % 6 + 1).alias("region"))
    return r.select("n_nationkey", "region", S.zone_prefix(F.col("region")).alias("prefix"))


def display_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    n = F.when(F.col("event_id") % 21 == 0, -1).otherwise(F.col("user_id")).cast("int")
    text = F.when(F.col("event_id") % 14 == 0, "soon").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    return e.select("event_id", S.shown_number(n).alias("shown"), S.shown_time(text).alias("shown_time"), F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"))


def chunk_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.array_sort(F.collect_set("c_mktsegment")).alias("all"))
    c = c.select("c_nationkey", F.posexplode(S.chunked(F.col("all"), 2)).alias("chunk", "items"))
    return c.select("c_nationkey", "chunk", F.array_join("items", ",").alias("items"))


def melted_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.series import melted, numeric_columns

    s = read(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal", F.col("s_nationkey").cast("double").alias("s_nationkey"))
    return melted(s, ["s_suppkey"], numeric_columns(s, "s_suppkey"))


def latest_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").withColumn("day", F.col("o_orderdate").cast("date"))
    return merge.latest_partition(o, "day").select("o_orderkey", "o_custkey", "o_totalprice")


def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    return diff.first_per_key(e, ["user_id", "event_type"], F.col("ts"), F.col("event_id")).select("user_id", "event_type", "event_id", "value")


def dedup_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    return diff.latest_per_key(e, ["user_id", "event_type"], F.col("ts"), F.col("event_id")).select("user_id", "event_type", "event_id", "value")


EVENT_TYPES = ["view", "click", "purchase", "signup", "error"]


def pivot_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    return merge.pivot_first(e, ["user_id"], F.col("event_type"), EVENT_TYPES, "value", "ts", "event_id")


def price_formula(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Machines are parts; unit prices come from their brand, and from their type where the brand has none."""
    p = read(spark, sf_dir, "part")
    brand = p.where("p_size % 5 <> 0").groupBy("p_brand").agg(F.max("p_retailprice").alias("core"), F.min("p_retailprice").alias("mem"))
    brand = brand.where(~F.col("p_brand").like("%3"))
    kind = p.groupBy("p_type").agg(F.max("p_retailprice").alias("core_new"), F.min(F.when(F.col("p_size") > 25, F.col("p_retailprice"))).alias("gpu"))
    out = p.join(brand, "p_brand", "left").join(kind, "p_type", "left")
    core = F.coalesce("core", F.when(F.col("p_size") % 2 == 0, F.col("core_new")))
    price = S.machine_price(F.col("p_size") % 4, F.col("p_size") / 2, (F.col("p_size") % 2).cast("double"), core, F.col("mem"), F.col("gpu"))
    return out.select("p_partkey", F.round(price, 6).alias("price"), F.round(S.unit_price(F.col("p_size").cast("string"), F.col("p_partkey")), 9).alias("unit"))


def wildcard_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    rows = query.wildcard(e, {"event_type": "click", "user_id": "*"}, F.lit("2024-01-05").cast("timestamp_ntz"), F.lit("2024-01-12").cast("timestamp_ntz"), order=("event_id",))
    return rows.select("event_id", "user_id", "event_type", "value")


def global_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return query.search(read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment"), "Auto")


def page_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return query.page(read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), 2, 50, F.desc("o_totalprice"), F.col("o_orderkey"))


def selector_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").withColumn("event_type", F.when(F.col("event_type") != "error", F.col("event_type")))
    return index.selector_union(e.where("user_id % 2 = 0"), e.where("user_id % 3 = 0"), ["user_id", "event_type"])


def union_all_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read(spark, sf_dir, "nation")
    c = read(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"), F.lit("customer").alias("kind"), F.col("c_acctbal").alias("balance"))
    s = read(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"), F.lit("supplier").alias("kind"), F.col("s_acctbal").alias("balance"))
    out = c.unionByName(s).join(n, F.col("nation") == F.col("n_nationkey"))
    return out.groupBy("n_name", "kind").agg(F.count("*").alias("n"), F.max("balance").alias("top"))


def set_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    a, b = (e.where(F.col("event_type") == t).select("user_id") for t in ("click", "purchase"))
    both, only = a.intersect(b).withColumn("op", F.lit("intersect")), a.subtract(b).withColumn("op", F.lit("except"))
    return both.unionByName(only)


GPU_NAMES = ["nvidia-tesla-t4", "nvidia-a100-80gb", "nvidia-tesla-a100", "nvidia-h100-mega-80gb", "nvidia-l4-vws", "some-tpu", "maker-x9"]
GPU_MODELS = ["T4", "A100", "A100 80GB", "H100", "L4", "L40"]


def set_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read(spark, sf_dir, "nation").withColumn("gpu", F.element_at(F.lit(GPU_NAMES), F.col("n_nationkey") % len(GPU_NAMES) + 1))
    return n.select("n_nationkey", F.round(S.jaccard_letters(F.col("n_name"), F.lit("GERMANY")), 6).alias("like"), S.best_name(F.col("gpu"), GPU_MODELS).alias("best"))


def assoc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer").withColumn("nation", F.when(F.col("c_nationkey") == 3, "nan").otherwise(F.col("c_nationkey").cast("string")))
    return index.association(c, "c_mktsegment", "nation").select("c_mktsegment", F.array_join("nation", ",").alias("nations"))


def asof_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    views, clicks = e.where("event_type = 'view'"), e.where("event_type = 'click'")
    return index.asof_forward(views.drop("event_type"), clicks.select("user_id", "ts"), ["user_id"]).select("event_id", "user_id", "next_ts")


def asof_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of two signals that belong together: each time of one with the next time of the other, then an equi-join."""
    e = read(spark, sf_dir, "events").withColumn("hour", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    a = e.where("event_type = 'signup'").select("user_id", "hour", F.col("value").alias("price")).dropDuplicates(["user_id", "hour", "price"])
    b = e.where("event_type = 'view'").select("user_id", F.col("hour").alias("next_ts"), F.col("value").alias("score"))
    bridge = index.asof_forward(a.select("hour").distinct().select(F.lit(0).alias("g"), F.col("hour").alias("ts")), b.select(F.lit(0).alias("g"), F.col("next_ts").alias("ts")).distinct(), ["g"])
    out = a.join(bridge.select(F.col("ts").alias("hour"), "next_ts"), "hour").join(b, ["next_ts", "user_id"])
    return out.select("user_id", "hour", "next_ts", "price", "score")


def prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_name", F.substring("n_name", 1, 1).alias("prefix"))
    c = read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.col("n_name").alias("zone"))
    return index.starts_with_join(c, "zone", n.select("n_nationkey", "prefix"), "prefix").select("s_suppkey", "zone", "n_nationkey")


def lookup_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").cast("string").alias("place"))
    n = read(spark, sf_dir, "nation").where("n_nationkey % 2 = 0").select(F.col("n_nationkey").cast("string").alias("k"), "n_name")
    return index.replaced(s, "place", n, "k", "n_name")


def cross_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read(spark, sf_dir, "nation").select(F.col("n_name").alias("RegionCode"))
    p = read(spark, sf_dir, "part").select(F.col("p_brand").alias("InstanceType"))
    out = planner.chunk_pairs(n, p)
    return out.select(F.array_join("RegionCode", ",").alias("regions"), F.array_join("InstanceType", ",").alias("types"))


def az_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = signals(spark, sf_dir)[0]
    return scores.groupBy("InstanceType", "Region").agg(F.count("*").alias("zones")).groupBy("InstanceType").agg(F.count("*").alias("regions"), F.sum("zones").alias("zones"))


def signal_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores, frequencies, ondemand, spot = signals(spark, sf_dir)
    out = scores.join(frequencies, ["InstanceType", "Region"], "left").join(ondemand, ["InstanceType", "Region"], "left").join(spot, ["InstanceType", "AZ"], "left")
    there = lambda *cs: F.count_if(sum((F.col(c).isNotNull().cast("int") for c in cs), F.lit(0)) == len(cs))
    return out.agg(F.count("*").alias("n"), there("IF").alias("frequencies"), there("OndemandPrice", "SpotPrice").alias("prices"), there("IF", "OndemandPrice", "SpotPrice").alias("full"))


def capacity_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = ticks(spark, sf_dir).where("k <> 0").withColumn("capacity", F.col("k") % 5)
    return e.rollup("capacity").agg(F.count("*").alias("n"), F.grouping("capacity").cast("int").alias("whole"))


def dup_key_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = read(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n"))
    return items.agg(F.sum(F.col("n") - 1).alias("duplicates"), F.count_if(F.col("n") > 1).alias("keys"))


def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.count_distinct("o_custkey").alias("customers"), F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))


def topk_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read(spark, sf_dir, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("n"))
    return planner.top_k(n, ["c_nationkey"], 2, F.desc("n"), F.col("c_mktsegment"))


def first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest order of each customer that matches a predicate on text."""
    o = read(spark, sf_dir, "orders").where(F.contains("o_orderpriority", F.lit("HIGH")) | F.contains("o_orderpriority", F.lit("URGENT")))
    return diff.latest_per_key(o, ["o_custkey"], F.col("o_orderdate"), F.col("o_orderkey")).select("o_custkey", "o_orderkey")


def invalid_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"))
    n = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nation"), "n_regionkey")
    return planner.without(c, "nation", n.where("n_regionkey = 1"), n.where("nation % 7 = 0"))


def last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.max_by("o_totalprice", F.struct("o_orderdate", "o_orderkey")).alias("price"))


def record_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "supplier").withColumn("ts", F.lit("2025-02-15 00:10:00").cast("timestamp"))
    path = f"{shared_folder(spark)}/records-{uuid.uuid4().hex}"
    records.publish(sinks.records(s, ["s_name", "s_nationkey"], {"s_suppkey": "BIGINT"}, F.col("ts")), path)
    r = records.published(spark, path)
    return r.select(F.get("dimensions", F.lit(0))["value"].alias("name"), F.get("dimensions", F.lit(1))["value"].alias("nation"), F.get("measures", F.lit(0))["value"].alias("measure"), "time")


def numbered_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.numbered(read(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), ["s_suppkey"]).withColumn("id", F.col("id").cast("int"))


def newest_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = read(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("version"))
    return sinks.newest_versions(log, ["l_orderkey"], "line").groupBy("line").agg(F.count("*").alias("n"), F.sum("version").alias("versions"))


_NAMES = (
    savings_variants, bucket_score, sku_parse, regex_extract, json_props, filter_not_contains, region_prefix, display_formats, chunk_lists, melted_prices, latest_partition,
    dedup_first, dedup_last, pivot_first, price_formula, wildcard_query, global_search, page_sort, selector_union, union_all_regions, set_ops, set_functions, assoc_index,
    asof_forward, asof_pairs, prefix_join, lookup_replace, cross_chunks, az_counts, signal_counts, capacity_rollup, dup_key_count, value_counts, topk_per_group, first_match,
    invalid_filtered, last_wins, record_export, numbered_latest, newest_versions,
)
QUERIES = {f.__name__: f for f in _NAMES}

_SAVED = "WITH p AS (SELECT p_partkey, CASE WHEN p_partkey % 10 = 0 THEN NULL WHEN p_partkey % 10 = 1 THEN 0.0 ELSE p_retailprice END AS od, p_retailprice * (p_size % 3 + 1) / 4 AS spot FROM part), q AS (SELECT *, (nullif(od, 0) - spot) / nullif(od, 0) * 100 AS e FROM p)"

ORACLE_SQL = {
    "savings_variants": f"""{_SAVED} SELECT p_partkey, coalesce(CAST(trunc(100 - spot * 100 / nullif(od, 0)) AS INTEGER), -1) AS truncated, round(e, 6) AS exact,
      round_even(e, 0) AS even, CASE WHEN od NOT IN (0, -1) AND spot NOT IN (0, -1) THEN CAST(floor(e + 0.5) AS BIGINT) END AS shown FROM q""",
    "bucket_score": """SELECT p_partkey, CASE b WHEN 0 THEN 3.0::DOUBLE WHEN 5 THEN 2.5 WHEN 10 THEN 2.0 WHEN 15 THEN 1.5 END AS eviction,
      CASE b WHEN 5 THEN 2.5::DOUBLE WHEN 10 THEN 2.0 WHEN 15 THEN 1.5 END AS interruption, CASE b WHEN 5 THEN 4 WHEN 10 THEN 3 WHEN 15 THEN 2 END AS research,
      CASE p_partkey % 4 WHEN 0 THEN 3 WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE -1 END AS score FROM (SELECT p_partkey, p_size % 6 * 5 AS b FROM part)""",
    "sku_parse": """WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN 'Standard' ELSE CASE c_custkey % 3 WHEN 0 THEN 'Standard_' WHEN 1 THEN 'Basic_' ELSE '' END || lower(c_mktsegment) || '_v' || c_custkey END AS sku,
      c_mktsegment || ' x ' || c_name AS meter FROM customer)
      SELECT c_custkey, CASE WHEN split_part(sku, '_', 1) IN ('Standard', 'Basic') THEN split_part(sku, '_', 1) END AS tier,
      CASE WHEN split_part(sku, '_', 1) NOT IN ('Standard', 'Basic') THEN split_part(sku, '_', 1) WHEN contains(sku, '_') THEN substr(sku, strpos(sku, '_') + 1) END AS type,
      upper(sku[1]) || lower(sku[2:]) AS capital, array_to_string(list_slice(string_split(meter, ' '), 1, len(string_split(meter, ' ')) - 1), ' ') AS meter, upper(sku) AS family FROM c""",
    "regex_extract": "SELECT page_id, regexp_extract(url, '^https?://([^/]+)/', 1) AS host, regexp_extract(url, 'page=([0-9]+)', 1) AS page, split_part(url, '/', 4) AS part FROM pages",
    "json_props": f"{TICKS} SELECT event_type, CAST(sum(k) AS BIGINT) AS k, count(DISTINCT k) AS kinds, max(k) AS top FROM ticks WHERE length(props) > 0 GROUP BY ALL",
    "filter_not_contains": "SELECT p_partkey, p_name, p_type FROM part WHERE p_name NOT LIKE '%bolt%' AND split_part(trim(p_type), ' ', 1) NOT IN ('PROMO', 'LARGE') AND lower(p_brand) NOT LIKE '%#11%'",
    "region_prefix": """SELECT n_nationkey, ['us-east-1', 'ap-northeast-2', 'eu-central-1', 'us-gov-west-1', 'ap-southeast-1', 'nowhere'][n_nationkey % 6 + 1] AS region,
      ['use1', 'apne2', 'euc1', NULL, 'apse1', NULL][n_nationkey % 6 + 1] AS prefix FROM nation""",
    "display_formats": """SELECT event_id, CASE WHEN event_id % 21 = 0 THEN 'N/A' ELSE CAST(user_id AS VARCHAR) END AS shown,
      CASE WHEN event_id % 14 = 0 THEN 'soon' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS shown_time, epoch_us(ts) // 1000 AS ms FROM events""",
    "chunk_lists": """WITH d AS (SELECT DISTINCT c_nationkey, c_mktsegment FROM customer), r AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_mktsegment) - 1 AS i FROM d)
      SELECT c_nationkey, CAST(i // 2 AS INTEGER) AS chunk, string_agg(c_mktsegment, ',' ORDER BY c_mktsegment) AS items FROM r GROUP BY ALL""",
    "melted_prices": "SELECT s_suppkey, 's_acctbal' AS metric, s_acctbal AS value FROM supplier UNION ALL SELECT s_suppkey, 's_nationkey', CAST(s_nationkey AS DOUBLE) FROM supplier",
    "latest_partition": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE CAST(o_orderdate AS DATE) = (SELECT max(CAST(o_orderdate AS DATE)) FROM orders)",
    "dedup_first": "SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1",
    "dedup_last": "SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1",
    "pivot_first": "SELECT user_id, " + ", ".join(f"arg_min(value, (ts, event_id)) FILTER (event_type = '{t}') AS \"{t}\"" for t in EVENT_TYPES) + " FROM events WHERE user_id IS NOT NULL GROUP BY user_id",
    "price_formula": """WITH b AS (SELECT p_brand, max(p_retailprice) AS core, min(p_retailprice) AS mem FROM part WHERE p_size % 5 <> 0 AND p_brand NOT LIKE '%3' GROUP BY ALL),
      t AS (SELECT p_type, max(p_retailprice) AS core_new, min(CASE WHEN p_size > 25 THEN p_retailprice END) AS gpu FROM part GROUP BY ALL),
      j AS (SELECT *, coalesce(core, CASE WHEN p_size % 2 = 0 THEN core_new END) AS c FROM part LEFT JOIN b USING (p_brand) LEFT JOIN t USING (p_type))
      SELECT p_partkey, round(greatest(p_size % 4, 1) * c + p_size / 2 * coalesce(mem, 0) + p_size % 2 * coalesce(gpu, 0), 6) AS price, round(p_size + p_partkey * 1e-9, 9) AS unit FROM j""",
    "wildcard_query": "SELECT event_id, user_id, event_type, value FROM events WHERE event_type = 'click' AND ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-12' ORDER BY ts, event_id LIMIT 20000",
    "global_search": "SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE contains(lower(CAST(c_custkey AS VARCHAR)), 'auto') OR contains(lower(c_name), 'auto') OR contains(lower(c_mktsegment), 'auto')",
    "page_sort": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 100",
    "selector_union": "SELECT user_id, event_type FROM events WHERE user_id % 2 = 0 AND event_type <> 'error' UNION SELECT user_id, event_type FROM events WHERE user_id % 3 = 0 AND event_type <> 'error'",
    "union_all_regions": """SELECT n_name, kind, count(*) AS n, max(balance) AS top FROM (SELECT c_nationkey AS nation, 'customer' AS kind, c_acctbal AS balance FROM customer UNION ALL
      SELECT s_nationkey, 'supplier', s_acctbal FROM supplier) JOIN nation ON nation = n_nationkey GROUP BY ALL""",
    "set_ops": """WITH a AS (SELECT user_id FROM events WHERE event_type = 'click'), b AS (SELECT user_id FROM events WHERE event_type = 'purchase')
      SELECT *, 'intersect' AS op FROM (SELECT * FROM a INTERSECT SELECT * FROM b) UNION ALL SELECT *, 'except' FROM (SELECT * FROM a EXCEPT SELECT * FROM b)""",
    "set_functions": f"""WITH g AS (SELECT n_nationkey, n_name, {GPU_NAMES}[n_nationkey % {len(GPU_NAMES)} + 1] AS gpu FROM nation),
      m AS (SELECT *, string_split(gpu, '-') AS parts, list_distinct(string_split(n_name, '')) AS a, list_distinct(string_split('GERMANY', '')) AS b FROM g),
      x AS (SELECT *, CASE WHEN regexp_matches(gpu, '[0-9]') THEN upper(array_to_string(parts[list_position(list_transform(parts, lambda t: regexp_matches(t, '[0-9]')), true):], '')) ELSE '' END AS own FROM m),
      c AS (SELECT unnest({GPU_MODELS}) AS name, generate_subscripts({GPU_MODELS}, 1) AS i),
      s AS (SELECT n_nationkey, name, i, len(list_intersect(list_distinct(string_split(own, '')), list_distinct(string_split(name, '')))) * 1.0 /
        len(list_distinct(list_concat(string_split(own, ''), string_split(name, '')))) AS v FROM x, c WHERE own <> '' AND own[1:2] = name[1:2]),
      t AS (SELECT n_nationkey, name FROM s WHERE v > 0 QUALIFY row_number() OVER (PARTITION BY n_nationkey ORDER BY v DESC, i) = 1)
      SELECT n_nationkey, round(len(list_intersect(a, b)) * 1.0::DOUBLE / len(list_distinct(list_concat(a, b))), 6) AS "like", coalesce(name, gpu) AS best FROM x LEFT JOIN t USING (n_nationkey)""",
    "assoc_index": "SELECT c_mktsegment, string_agg(DISTINCT n, ',' ORDER BY n) AS nations FROM (SELECT c_mktsegment, CAST(c_nationkey AS VARCHAR) AS n FROM customer WHERE c_nationkey <> 3) GROUP BY ALL",
    "asof_forward": """SELECT a.event_id, a.user_id, b.ts AS next_ts FROM (SELECT * FROM events WHERE event_type = 'view') a ASOF JOIN (SELECT user_id, ts FROM events WHERE event_type = 'click') b
      ON a.user_id = b.user_id AND b.ts > a.ts""",
    "asof_pairs": """WITH e AS (SELECT *, date_trunc('hour', ts) AS hour FROM events), a AS (SELECT DISTINCT user_id, hour, value AS price FROM e WHERE event_type = 'signup'),
      b AS (SELECT user_id, hour AS next_ts, value AS score FROM e WHERE event_type = 'view'),
      bridge AS (SELECT h.hour, min(n.next_ts) AS next_ts FROM (SELECT DISTINCT hour FROM a) h JOIN (SELECT DISTINCT next_ts FROM b) n ON n.next_ts > h.hour GROUP BY ALL)
      SELECT a.user_id, a.hour, bridge.next_ts, price, score FROM a JOIN bridge USING (hour) JOIN b ON b.next_ts = bridge.next_ts AND b.user_id = a.user_id""",
    "prefix_join": "SELECT s_suppkey, z.n_name AS zone, p.n_nationkey FROM supplier JOIN nation z ON z.n_nationkey = s_nationkey JOIN nation p ON starts_with(z.n_name, p.n_name[1:1])",
    "lookup_replace": "SELECT s_suppkey, coalesce(n_name, CAST(s_nationkey AS VARCHAR)) AS place FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey AND n_nationkey % 2 = 0",
    "cross_chunks": """WITH r AS (SELECT DISTINCT n_name AS x FROM nation), t AS (SELECT DISTINCT p_brand AS x FROM part),
      rc AS (SELECT g, string_agg(x, ',' ORDER BY x) AS regions FROM (SELECT x, (row_number() OVER (ORDER BY x) - 1) // 8 AS g FROM r) GROUP BY g),
      tc AS (SELECT g, string_agg(x, ',' ORDER BY x) AS types FROM (SELECT x, (row_number() OVER (ORDER BY x) - 1) // 5 AS g FROM t) GROUP BY g) SELECT regions, types FROM rc CROSS JOIN tc""",
    "az_counts": f"{SIGNALS} SELECT InstanceType, count(*) AS regions, CAST(sum(z) AS BIGINT) AS zones FROM (SELECT InstanceType, Region, count(*) AS z FROM scores GROUP BY ALL) GROUP BY ALL",
    "signal_counts": f"""{SIGNALS} SELECT count(*) AS n, count("IF") AS frequencies, count(*) FILTER (OndemandPrice IS NOT NULL AND SpotPrice IS NOT NULL) AS prices,
      count(*) FILTER ("IF" IS NOT NULL AND OndemandPrice IS NOT NULL AND SpotPrice IS NOT NULL) AS "full"
      FROM scores LEFT JOIN frequencies USING (InstanceType, Region) LEFT JOIN ondemand USING (InstanceType, Region) LEFT JOIN spot USING (InstanceType, AZ)""",
    "capacity_rollup": f"{TICKS} SELECT k % 5 AS capacity, count(*) AS n, CAST(grouping(k % 5) AS INTEGER) AS whole FROM ticks WHERE k <> 0 GROUP BY ROLLUP (k % 5)",
    "dup_key_count": "SELECT CAST(sum(n - 1) AS BIGINT) AS duplicates, count(*) FILTER (n > 1) AS keys FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)",
    "value_counts": "SELECT o_orderstatus, count(*) AS n, count(DISTINCT o_custkey) AS customers, min(o_orderdate) AS \"first\", max(o_orderdate) AS \"last\" FROM orders GROUP BY ALL",
    "topk_per_group": "SELECT * FROM (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY n DESC, c_mktsegment) <= 2",
    "first_match": "SELECT o_custkey, o_orderkey FROM orders WHERE o_orderpriority LIKE '%HIGH%' OR o_orderpriority LIKE '%URGENT%' QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1",
    "invalid_filtered": "SELECT c_custkey, c_nationkey AS nation FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1 OR n_nationkey % 7 = 0)",
    "last_wins": "SELECT o_custkey, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS price FROM orders GROUP BY ALL",
    "record_export": "SELECT s_name AS name, CAST(s_nationkey AS VARCHAR) AS nation, CAST(s_suppkey AS VARCHAR) AS measure, CAST(epoch_ms(TIMESTAMP '2025-02-15 00:10:00') AS VARCHAR) AS time FROM supplier",
    "numbered_latest": "SELECT s_suppkey, s_name, CAST(row_number() OVER (ORDER BY s_suppkey) AS INTEGER) AS id FROM supplier",
    "newest_versions": "SELECT l_linenumber AS line, count(*) AS n, CAST(sum(v) AS BIGINT) AS versions FROM (SELECT l_orderkey, l_linenumber, max(l_partkey) AS v FROM lineitem GROUP BY ALL) GROUP BY ALL",
}
