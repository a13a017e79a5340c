"""Queries on what vendors publish: price lists, eviction rates, hardware, catalogues of units.  The given tables stand in
for their answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import merge
from ..sources import readers
from .tables import read


def _pick(values: list[str], by: Column) -> Column:
    return F.element_at(F.lit(values), (by % len(values) + 1).cast("int"))


LOCATIONS = ["US East", "Gov East", "EU West", " ", "AP South"]
METERS = ["x Spot", "x", "x", "x Low Priority", "x Expired"]
RATES = ["0-5", "5-10", "20+", "none"]


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retail items: parts by location, with meters that are spot, on demand or not offered."""
    k = F.col("p_partkey")
    sku = F.concat(_pick(["Standard_", "Basic_", ""], F.col("p_size")), F.lit("B"), (F.col("p_size") % 5).cast("string"), F.lit("_v2"))
    return read(spark, sf_dir, "part").select(
        _pick(LOCATIONS, k).alias("location"), F.concat(F.lit("r"), (k % 5).cast("string")).alias("armRegionName"), sku.alias("armSkuName"), F.col("p_retailprice").alias("retailPrice"),
        _pick(METERS, F.floor(k / 5)).alias("meterName"), F.when(F.col("p_size") % 11 == 0, "Machines Windows").otherwise("Machines").alias("productName"), F.concat(F.lit("2025-01-"), (10 + k % 19).cast("string")).alias("effectiveStartDate"),
    )


def _evictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    return s.select(F.concat(F.lit("r"), (k % 4).cast("string")).alias("location"), F.concat(F.lit("standard_b"), (k % 6).cast("string"), F.lit("_v2")).alias("skuName"), _pick(RATES, F.floor(k / 3)).alias("evictionRate"))


def retail_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = merge.retail_prices(_items(spark, sf_dir))
    return out.withColumn("Savings", F.round("Savings", 6))


def prices_with_evictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = merge.with_evictions(merge.retail_prices(_items(spark, sf_dir)), _evictions(spark, sf_dir))
    return out.select("InstanceTier", "InstanceType", "Region", "armRegionName", "SpotPrice", "IF")


def inputs_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices and evictions, each of them alone, and neither: rows and scores of each."""
    prices, evictions = merge.retail_prices(_items(spark, sf_dir)), _evictions(spark, sf_dir)
    cases = {"both": (prices, evictions), "prices": (prices, None), "evictions": (None, evictions), "neither": (None, None)}
    counts = [merge.prices_at_hand(*v).agg(F.count("*").alias("n"), F.sum("IF").alias("score"), F.count("InstanceTier").alias("tiers")).select(F.lit(k).alias("case"), "*") for k, v in cases.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3])


def price_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested price-list documents; free offers are dropped."""
    p = read(spark, sf_dir, "part")
    usd = F.when(F.col("p_size") % 9 == 0, "0.0000000000").otherwise(F.col("p_retailprice").cast("string"))
    dimension = F.create_map(F.lit("d1"), F.struct(F.struct(usd.alias("USD")).alias("pricePerUnit")))
    terms = F.struct(F.create_map(F.lit("t1"), F.struct(dimension.alias("priceDimensions"))).alias("OnDemand"))
    product = F.struct(F.struct(F.concat(F.lit("m."), F.col("p_partkey").cast("string")).alias("instanceType")).alias("attributes"))
    docs = p.select(F.to_json(F.struct(product.alias("product"), terms.alias("terms"))).alias("value"), F.concat(F.lit("r"), (F.col("p_size") % 3).cast("string")).alias("place"))
    return readers.ondemand_prices(docs, F.col("place"))


def spot_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    stamp = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit(" "), F.lpad(F.col("event_id").cast("string"), 12, "0"))
    what = F.when(F.col("event_id") % 3 == 0, "Windows").otherwise("Linux/UNIX")
    rows = e.select(F.col("event_type").alias("InstanceType"), F.concat(F.lit("az"), (F.col("user_id") % 20).cast("string")).alias("AZ"), stamp.alias("Timestamp"), F.col("value").cast("string").alias("SpotPrice"), what.alias("ProductDescription"))
    return readers.spot_history(rows)


def eviction_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a resource graph: types in any case, properties as JSON, blanks dropped."""
    c = read(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    kind = F.when(k % 7 == 0, "Microsoft.Compute/disks").when(k % 2 == 0, "Microsoft.Compute/skuSpotEvictionRate/location").otherwise("microsoft.compute/skuspotevictionrate/location")
    props = F.to_json(F.struct(F.concat(F.lit("sku"), k.cast("string")).alias("skuName"), F.when(k % 5 == 0, "").otherwise(_pick(RATES, k)).alias("evictionRate")))
    rows = c.select(kind.alias("type"), F.when(k % 11 == 0, "").otherwise(F.concat(F.lit("r"), F.col("c_nationkey").cast("string"))).alias("location"), props.alias("properties"))
    return readers.eviction_resources(rows)


def machine_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "supplier")
    zone = F.concat(F.lit("r"), (F.col("s_nationkey") % 6).cast("string"), F.lit("-x-"), _pick(["a", "b", "c"], F.col("s_suppkey")))
    name = F.concat(_pick(["n1", "e2", "a2"], F.col("s_suppkey")), F.lit("-standard-"), (F.col("s_suppkey") % 8).cast("string"))
    machines = s.select(zone.alias("zone"), name.alias("machineType"), ((F.col("s_suppkey") % 8 + 1) * 1024).alias("memoryMb"))
    out = readers.machine_types(machines, machines.select("zone").where("zone not like '%c'").distinct())
    return out.select("region", "machineType", "machineFamily", "memory")


def hardware_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part")
    use = F.when(F.col("p_size") % 4 == 0, F.array(F.lit("on-demand"))).otherwise(F.array(F.lit("on-demand"), F.lit("spot")))
    gpu = F.when(F.col("p_size") % 3 == 0, F.struct(F.array(F.struct(F.col("p_brand").alias("Name"), F.col("p_size").alias("Count"))).alias("Gpus")))
    rows = p.select(
        F.col("p_partkey").cast("string").alias("InstanceType"), use.alias("SupportedUsageClasses"), F.struct(F.array(F.lit("x86_64"), F.lit("i386")).alias("SupportedArchitectures")).alias("ProcessorInfo"),
        F.struct(F.col("p_size").alias("DefaultVCpus")).alias("VCpuInfo"), F.struct((F.col("p_size") * 1024).alias("SizeInMiB")).alias("MemoryInfo"),
        F.when(F.col("p_size") % 2 == 0, F.struct((F.col("p_size") * 10).alias("TotalSizeInGB"))).alias("InstanceStorageInfo"), F.struct(F.lit("Up to 5").alias("NetworkPerformance")).alias("NetworkInfo"), gpu.alias("GpuInfo"),
    )
    return readers.hardware_aws(rows)


def hardware_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capabilities as a list of names and values, some names twice in different case."""
    p = read(spark, sf_dir, "part")
    cap = lambda n, v: F.struct(F.lit(n).alias("name"), v.cast("string").alias("value"))
    caps = F.array(cap("vCPUs", F.col("p_size")), cap("MemoryGB", F.col("p_size") * 2), cap("VCPUS", F.col("p_size") + 1))
    rows = p.select(F.col("p_name").alias("name"), F.when(F.col("p_size") % 5 == 0, "disks").otherwise("virtualMachines").alias("resourceType"), F.concat(F.lit("f"), F.lpad(F.col("p_partkey").cast("string"), 9, "0")).alias("family"), caps.alias("capabilities"))
    return readers.hardware_azure(rows, ["vCPUs", "MemoryGB", "GPUs"])


def scraped_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read(spark, sf_dir, "nation")
    page = F.concat(F.lit('var x={"a":"'), F.col("n_name"), F.lit('","b":"'), F.col("n_regionkey").cast("string"), F.lit('","a":"last '), F.col("n_name"), F.lit('"};'))
    out = readers.scraped_map(n.select("n_nationkey", page.alias("text")), "text")
    return out.select("n_nationkey", F.col("pairs")["a"].alias("a"), F.col("pairs")["b"].alias("b"), F.size("pairs").alias("n"))


FAMILIES = ["N1", "N2", "E2"]


def _skus(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part").withColumn("f", _pick(FAMILIES, F.floor(F.col("p_partkey") / 8)))
    cats = lambda *parts: F.array(F.lit("GCP"), F.lit("Compute"), *(x if isinstance(x, Column) else F.lit(x) for x in parts))
    k = F.col("p_partkey") % 8
    found = (
        F.when(k == 0, cats("GCE", "VMs On Demand", "Cores: Per Core", F.col("f"))).when(k == 1, cats("GCE", "VMs On Demand", "Memory: Per GB", F.col("f")))
        .when(k == 2, cats("GCE", "VMs Preemptible", "Cores: Per Core", F.col("f"))).when(k == 3, cats("GCE", "VMs Preemptible", "Memory: Per GB", F.col("f")))
        .when(k == 4, cats("GPUs", "GPUs On Demand", F.concat(F.lit("G"), F.col("f")))).when(k == 5, cats("GPUs", "GPUs Preemptible", F.concat(F.lit("G"), F.col("f"))))
        .when(k == 6, cats("GCE", "VMs On Demand", "Cores: Per Core", "Cross VM")).otherwise(cats("Storage"))
    )
    name = F.when(F.col("p_size") % 10 == 0, "Custom machine").otherwise("machine")
    return p.select(F.lpad(F.col("p_partkey").cast("string"), 9, "0").alias("skuId"), name.alias("displayName"), found.alias("cats"), F.array(F.lit("r0"), F.concat(F.lit("r"), (1 + F.col("p_size") % 3).cast("string"))).alias("regions"))


def unit_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.catalogue_units(_skus(spark, sf_dir))


def machine_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices of machines from unit prices: parts are units and, by supplier, machines."""
    prices = read(spark, sf_dir, "part").select(F.lpad(F.col("p_partkey").cast("string"), 9, "0").alias("skuId"), F.explode(F.array(F.lit(1), F.lit(2))).alias("page"), F.col("p_retailprice").alias("price"))
    prices = prices.withColumn("price", F.col("price") * F.col("page"))
    k = F.col("s_suppkey")
    machines = read(spark, sf_dir, "supplier").select(
        F.concat(F.lit("m"), k.cast("string")).alias("machineType"), _pick([*FAMILIES, "Z9"], k).alias("machineFamily"), F.concat(F.lit("r"), (k % 5).cast("string")).alias("region"), (k % 16).cast("double").alias("vcpus"), (k % 64).cast("double").alias("memory"),
        F.when(k % 3 == 0, F.concat(F.lit("G"), _pick(FAMILIES, F.floor(k / 3)))).alias("gpuType"), F.when(k % 3 == 0, (k % 4).cast("double")).alias("gpuCount"),
    )
    out = merge.machine_prices(machines, merge.catalogue_units(_skus(spark, sf_dir)), prices, F.lit("2025-02-15 00:10:00"))
    return out.withColumns({c: F.round(c, 6) for c in ("OndemandPrice", "SpotPrice", "Savings")})


_NAMES = (
    retail_prices, prices_with_evictions, inputs_missing, price_documents, spot_history, eviction_documents, machine_regions, hardware_nested, hardware_listed, scraped_pairs, unit_catalogue, machine_prices,
)
QUERIES = {f.__name__: f for f in _NAMES}

_ITEMS = f"""WITH items AS (SELECT {LOCATIONS}[p_partkey % 5 + 1] AS location, 'r' || p_partkey % 5 AS armRegionName, CASE p_size % 3 WHEN 0 THEN 'Standard' WHEN 1 THEN 'Basic' END AS InstanceTier,
    CASE WHEN p_size % 3 < 2 THEN 'B' || p_size % 5 || '_v2' ELSE 'B' || p_size % 5 END AS InstanceType, p_retailprice AS price, {METERS}[p_partkey // 5 % 5 + 1] AS meter, p_size % 11 = 0 AS windows, '2025-01-' || (10 + p_partkey % 19) AS since FROM part),
  prices AS (SELECT InstanceTier, InstanceType, location AS Region, armRegionName, nullif(arg_max(price, (since, price)) FILTER (NOT contains(meter, 'Spot')), 0) AS OndemandPrice, arg_max(price, (since, price)) FILTER (contains(meter, 'Spot')) AS SpotPrice
    FROM items WHERE NOT windows AND NOT contains(meter, 'Priority') AND NOT contains(meter, 'Expired') AND trim(location) <> '' AND upper(split_part(trim(location), ' ', 1)) <> 'GOV' GROUP BY ALL HAVING SpotPrice IS NOT NULL),
  evictions AS (SELECT 'r' || s_suppkey % 4 AS code, 'b' || s_suppkey % 6 || '_v2' AS type, max(CASE s_suppkey // 3 % 4 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 2.5 WHEN 2 THEN 1.0 END) AS score FROM supplier GROUP BY ALL),
  joined AS (SELECT p.*, e.score AS "IF" FROM prices p LEFT JOIN evictions e ON e.code = p.armRegionName AND e.type = lower(p.InstanceType))"""
_UNITS = f"""WITH s AS (SELECT lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS skuId, p_partkey % 8 AS k, {FAMILIES}[p_partkey // 8 % 3 + 1] AS f, unnest(['r0', 'r' || (1 + p_size % 3)]) AS region, p_size % 10 = 0 AS custom, p_retailprice AS price FROM part),
  units AS (SELECT skuId, CASE WHEN k < 4 THEN 'VMs' ELSE 'GPUs' END AS kind, CASE WHEN k < 4 THEN f ELSE 'G' || f END AS family, CASE WHEN k IN (0, 1, 4) THEN 'ondemand' ELSE 'preemptible' END AS model,
    CASE WHEN k IN (0, 2) THEN 'Cores' WHEN k IN (1, 3) THEN 'Memory' ELSE 'GPU' END AS resource, region, price FROM s WHERE k IN (4, 5) OR k < 4 AND NOT custom)"""
_FIRST = ", ".join(f"arg_min(price, skuId) FILTER (model = '{m}' AND resource = '{r}') AS {m}{r}" for m in ("ondemand", "preemptible") for r in ("Cores", "Memory", "GPU"))


def _cost(model: str) -> str:
    unit = lambda r: f"coalesce(v.{model}{r}, g.{model}{r})"
    return f"greatest(vcpus, 1) * {unit('Cores')} + coalesce(memory, 0) * coalesce({unit('Memory')}, 0) + coalesce(gpus, 0) * coalesce(g.{model}GPU, 0)"


ORACLE_SQL = {
    "retail_prices": f"{_ITEMS} SELECT *, round((OndemandPrice - SpotPrice) / OndemandPrice * 100, 6) AS Savings FROM prices",
    "prices_with_evictions": f'{_ITEMS} SELECT InstanceTier, InstanceType, Region, armRegionName, SpotPrice, "IF" FROM joined',
    "inputs_missing": f"""{_ITEMS} SELECT 'both' AS "case", count(*) AS n, sum("IF") AS score, count(InstanceTier) AS tiers FROM joined UNION ALL SELECT 'prices', count(*), -count(*), count(InstanceTier) FROM prices
      UNION ALL SELECT 'evictions', count(*), sum(CASE s_suppkey // 3 % 4 WHEN 0 THEN 3.0 WHEN 1 THEN 2.5 WHEN 2 THEN 1.0 END), 0 FROM supplier UNION ALL SELECT 'neither', 0, NULL, 0""",
    "price_documents": "SELECT 'r' || p_size % 3 AS Region, 'm.' || p_partkey AS InstanceType, p_retailprice AS OndemandPrice FROM part WHERE p_size % 9 <> 0",
    "spot_history": "SELECT event_type AS InstanceType, 'az' || user_id % 20 AS AZ, arg_max(value, (ts, event_id)) AS SpotPrice FROM events WHERE event_id % 3 <> 0 GROUP BY ALL",
    "eviction_documents": f"SELECT 'r' || c_nationkey AS location, 'sku' || c_custkey AS skuName, {RATES}[c_custkey % 4 + 1] AS evictionRate FROM customer WHERE c_custkey % 7 <> 0 AND c_custkey % 5 <> 0 AND c_custkey % 11 <> 0",
    "machine_regions": """SELECT DISTINCT 'r' || s_nationkey % 6 || '-x' AS region, ['n1', 'e2', 'a2'][s_suppkey % 3 + 1] || '-standard-' || s_suppkey % 8 AS machineType, ['N1', 'E2', 'A2'][s_suppkey % 3 + 1] AS machineFamily,
      CAST(s_suppkey % 8 + 1 AS DOUBLE) AS memory FROM supplier WHERE s_suppkey % 3 < 2""",
    "hardware_nested": """SELECT CAST(p_partkey AS VARCHAR) AS InstanceType, 'x86_64' AS architecture, p_size AS vcpus, p_size * 1024 AS memory_mib, CASE WHEN p_size % 2 = 0 THEN p_size * 10 END AS storage_gb, 'Up to 5' AS network,
      CASE WHEN p_size % 3 = 0 THEN p_brand END AS gpu, CASE WHEN p_size % 3 = 0 THEN p_size END AS gpus FROM part WHERE p_size % 4 <> 0""",
    "hardware_listed": """SELECT p_name AS name, 'f' || lpad(CAST(max(p_partkey) AS VARCHAR), 9, '0') AS family, CAST(arg_max(p_size, p_partkey) + 1 AS VARCHAR) AS vCPUs, CAST(arg_max(p_size, p_partkey) * 2 AS VARCHAR) AS MemoryGB, CAST(NULL AS VARCHAR) AS GPUs
      FROM part WHERE p_size % 5 <> 0 GROUP BY p_name""",
    "scraped_pairs": "SELECT n_nationkey, 'last ' || n_name AS a, CAST(n_regionkey AS VARCHAR) AS b, 2 AS n FROM nation",
    "unit_catalogue": f"{_UNITS} SELECT skuId, kind, family, model, resource, region FROM units",
    "machine_prices": f"""{_UNITS}, v AS (SELECT family, region, {_FIRST} FROM units WHERE kind = 'VMs' GROUP BY ALL), g AS (SELECT family, region, {_FIRST} FROM units WHERE kind = 'GPUs' GROUP BY ALL),
      m AS (SELECT 'm' || s_suppkey AS InstanceType, ['N1', 'N2', 'E2', 'Z9'][s_suppkey % 4 + 1] AS mf, 'r' || s_suppkey % 5 AS Region, CAST(s_suppkey % 16 AS DOUBLE) AS vcpus, CAST(s_suppkey % 64 AS DOUBLE) AS memory,
        CASE WHEN s_suppkey % 3 = 0 THEN 'G' || {FAMILIES}[s_suppkey // 3 % 3 + 1] END AS gt, CASE WHEN s_suppkey % 3 = 0 THEN CAST(s_suppkey % 4 AS DOUBLE) END AS gpus FROM supplier),
      p AS (SELECT m.InstanceType, m.Region, {_cost('ondemand')} AS od, {_cost('preemptible')} AS sp FROM m LEFT JOIN v ON v.family = m.mf AND v.region = m.Region LEFT JOIN g ON g.family = m.gt AND g.region = m.Region)
      SELECT '2025-02-15 00:10:00' AS Time, InstanceType, Region, round(od, 6) AS OndemandPrice, round(sp, 6) AS SpotPrice, round((od - sp) / od * 100, 6) AS Savings FROM p WHERE od IS NOT NULL AND sp IS NOT NULL""",
}
