"""Merging of signals into one wide snapshot per vendor."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..schemas import VENDORS


def with_sentinels(df: DataFrame, vendor: str) -> DataFrame:
    """Nulls become what stands for a missing value in published snapshots."""
    return df.fillna({c: v for c, v in VENDORS[vendor].sentinels.items() if c in df.columns})


def with_columns_of(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """The named columns in order, as null where ``df`` lacks them."""
    return df.select(*(F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in types.items()))


def first_column(df: DataFrame, *names: str) -> Column:
    """The first of several spellings of a column that isn't null."""
    return F.coalesce(*(F.col(n) for n in names if n in df.columns))


def merge_zonal(scores: DataFrame, interruptions: DataFrame, ondemand: DataFrame, spot: DataFrame, time: Column) -> DataFrame:
    """One row per (InstanceType, Region, AZ) of the scores, with frequency and prices (5 decimals) and whole savings.

    Outer joins of the four signals, without rows that lack a part of the key, leave the rows of the scores; they are
    written as left joins, so the scores are shuffled once for the two joins that share a key.
    """
    prices = ondemand.withColumn("OndemandPrice", F.round("OndemandPrice", 5)).select("InstanceType", "Region", "OndemandPrice")
    spots = spot.withColumn("SpotPrice", F.round("SpotPrice", 5)).select("InstanceType", "AZ", "SpotPrice")
    out = scores.dropna(subset=["InstanceType", "Region", "AZ"]).join(interruptions.select("InstanceType", "Region", "IF"), ["InstanceType", "Region"], "left")
    out = out.join(prices, ["InstanceType", "Region"], "left").join(spots, ["InstanceType", "AZ"], "left")
    out = out.withColumn("Savings", S.savings_truncated(F.col("OndemandPrice"), F.col("SpotPrice"))).withColumn("Time", time)
    return with_sentinels(out, "aws").select("Time", "InstanceType", "Region", "AZ", "SPS", "T3", "T2", "IF", "OndemandPrice", "SpotPrice", "Savings")


def merge_zonal_outer(scores: DataFrame, interruptions: DataFrame, ondemand: DataFrame, spot: DataFrame, time: Column) -> DataFrame:
    """The same rows as ``merge_zonal`` by full outer joins, for data whose scores may lack keys the others have."""
    out = scores.join(interruptions.select("InstanceType", "Region", "IF"), ["InstanceType", "Region"], "full_outer")
    out = out.join(ondemand.select("InstanceType", "Region", F.round("OndemandPrice", 5).alias("OndemandPrice")), ["InstanceType", "Region"], "full_outer")
    out = out.join(spot.select("InstanceType", "AZ", F.round("SpotPrice", 5).alias("SpotPrice")), ["InstanceType", "AZ"], "full_outer")
    out = out.withColumn("Savings", S.savings_truncated(F.col("OndemandPrice"), F.col("SpotPrice"))).withColumn("Time", time)
    out = with_sentinels(out, "aws").dropna(subset=["InstanceType", "Region", "AZ"])
    return out.select("Time", "InstanceType", "Region", "AZ", "SPS", "T3", "T2", "IF", "OndemandPrice", "SpotPrice", "Savings")


#: What ``retail_prices`` gives.
RETAIL_PRICES = "InstanceTier string, InstanceType string, Region string, armRegionName string, OndemandPrice double, SpotPrice double, Savings double"
# Meters and places that aren't offers to the public.
NOT_METERS, NOT_PRODUCTS = ("Priority", "Expired"), ("Windows",)
GOVERNMENT = "GOV"


def retail_prices(items: DataFrame) -> DataFrame:
    """On-demand and spot price of each (tier, type, region) from retail items; rows without a spot price are dropped.

    One conditional aggregation takes the place of a split into two tables and their join.
    """
    words = F.split(F.trim("location"), r"\s+")
    shown = ~F.contains("productName", F.lit("Windows")) & reduce(lambda a, b: a & b, (~F.contains("meterName", F.lit(w)) for w in NOT_METERS))
    shown &= (F.upper(F.get(words, F.lit(0))) != GOVERNMENT) & (F.length(F.trim("location")) > 0)
    spot = F.contains("meterName", F.lit("Spot"))
    priced = items.where(shown).withColumns({"InstanceTier": S.sku_tier(F.col("armSkuName")), "InstanceType": S.sku_type(F.col("armSkuName"))})
    newest = lambda keep: F.max_by("retailPrice", F.when(keep, F.struct("effectiveStartDate", "retailPrice")))
    out = priced.groupBy("InstanceTier", "InstanceType", F.col("location").alias("Region"), "armRegionName").agg(
        newest(~spot).alias("OndemandPrice"), newest(spot).alias("SpotPrice")
    )
    out = out.where(F.col("SpotPrice").isNotNull()).withColumn("OndemandPrice", F.nullif(F.col("OndemandPrice"), F.lit(0.0)))
    return out.withColumn("Savings", S.savings_exact(F.col("OndemandPrice"), F.col("SpotPrice")))


def with_evictions(prices: DataFrame, evictions: DataFrame, *, parity: bool = False) -> DataFrame:
    """Prices with the eviction score ``IF`` of their region code and type.

    The eviction source writes types in another case; they are compared in lower case, or with ``parity`` as spelled.
    Without any prices the evictions stand alone, with prices -1 and savings 1; which of the two it is shows when the
    result is computed, no job runs here.
    """
    rates = evictions.select(F.col("location").alias("_code"), S.interruption_type(F.col("skuName")).alias("_type"), S.mapped(F.col("evictionRate"), S.EVICTION_SCORES).alias("IF"))
    case = (lambda c: c) if parity else F.lower
    bare = rates.select(
        F.lit(None).cast("string").alias("InstanceTier"), F.col("_type").alias("InstanceType"), F.col("_code").alias("Region"), F.col("_code").alias("armRegionName"),
        F.lit(-1.0).alias("OndemandPrice"), F.lit(-1.0).alias("SpotPrice"), F.lit(1.0).alias("Savings"), "IF",
    )
    any_price = F.broadcast(prices.select(F.lit(True).alias("_any")).limit(1))  # one row at most
    bare = bare.join(any_price, F.col("_any"), "left_anti")
    rates = rates.groupBy("_code", case(F.col("_type")).alias("_type")).agg(F.max("IF").alias("IF"))
    out = prices.withColumn("_t", case(F.col("InstanceType")))
    return out.join(rates, (out["armRegionName"] == rates["_code"]) & (out["_t"] == rates["_type"]), "left").drop("_code", "_type", "_t").unionByName(bare, allowMissingColumns=True)


def prices_at_hand(prices: DataFrame | None, evictions: DataFrame | None) -> DataFrame:
    """Prices with evictions when a source may have failed: prices alone have ``IF`` -1, evictions alone their own rows, and
    with neither there is an empty table of the same columns."""
    types = {"InstanceTier": "string", "InstanceType": "string", "Region": "string", "armRegionName": "string", "OndemandPrice": "double", "SpotPrice": "double", "Savings": "double", "IF": "double"}
    if prices is not None and evictions is not None:
        return with_columns_of(with_evictions(prices, evictions), types)
    if prices is not None:
        return with_columns_of(prices.withColumn("IF", F.lit(-1.0)), types)
    if evictions is not None:
        return with_columns_of(with_evictions(evictions.sparkSession.createDataFrame([], RETAIL_PRICES), evictions), types)
    return SparkSession.active().createDataFrame([], ", ".join(f"{c} {t}" for c, t in types.items()))


def merge_regional(prices: DataFrame, scores: DataFrame) -> DataFrame:
    """Prices and scores in one row per (tier, type, region, zone, count), without rows that lack one of the two.

    Rows whose four price signals are all missing go, as do government regions and rows without score and zone.  A row's time
    is that of its score, or else of its price, if prices have a ``time``, or N/A.
    """
    keys = {k: f"_s_{k}" for k in ("InstanceTier", "InstanceType", "Region")}
    priced_at = F.col("time").cast("string") if "time" in prices.columns else F.lit(None).cast("string")
    p = prices.select(*keys, "OndemandPrice", "SpotPrice", "Savings", "IF", priced_at.alias("_priced_at"))
    s = scores.select(*(F.col(k).alias(v) for k, v in keys.items()), "DesiredCount", "AvailabilityZone", "Score", F.col("time").cast("string").alias("_scored_at"), "T2", "T3")
    out = p.join(s, reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(v)) for k, v in keys.items())), "full_outer")
    out = out.select(*(F.coalesce(k, v).alias(k) for k, v in keys.items()), "OndemandPrice", "SpotPrice", "Savings", "IF", "DesiredCount", "AvailabilityZone", "Score", F.coalesce("_scored_at", "_priced_at", F.lit("N/A")).alias("Time"), "T2", "T3")
    return regional_filters(with_sentinels(out, "azure"))


def regional_filters(merged: DataFrame) -> DataFrame:
    """Drops rows that a published regional snapshot doesn't have; sentinels are in place."""
    priceless = reduce(lambda a, b: a & b, (F.col(c) == -1 for c in ("OndemandPrice", "SpotPrice", "Savings", "IF")))
    government = F.contains(F.lower(F.coalesce("Region", F.lit(""))), F.lit("gov"))
    scoreless = (F.col("Score") == -1) & (F.col("AvailabilityZone") == "N/A")
    return merged.where(~priceless & ~government & ~scoreless)


def latest_partition(df: DataFrame, time: str = "time") -> DataFrame:
    """Rows of the newest time; the maximum is a scalar subquery, pruned to one column."""
    newest = df.agg(F.max(time).alias("_newest"))
    return df.join(F.broadcast(newest), df[time] == newest["_newest"], "left_semi")  # a single row


# Names in the catalogue of units.
PRICE_MODELS = {"VMs On Demand": "ondemand", "VMs Preemptible": "preemptible", "GPUs On Demand": "ondemand", "GPUs Preemptible": "preemptible"}
PIVOTED = tuple(f"{m}{r}" for m in ("ondemand", "preemptible") for r in ("Cores", "Memory", "GPU"))


def catalogue_units(skus: DataFrame) -> DataFrame:
    """Unit ``kind`` (VMs, GPUs, GPUs_with_Core_and_Memory), family, model and resource of catalogue entries, by region.

    ``skus`` has skuId, displayName, ``cats`` (array of category names), ``regions`` (array).  Entries of other kinds,
    custom machines, sole tenancy and slices of GPUs are dropped.
    """
    cat = lambda i: F.get("cats", F.lit(i))
    n = F.size("cats")
    base = (cat(0) == "GCP") & (cat(1) == "Compute")
    plain = ~F.contains("displayName", F.lit("Custom")) & ~F.contains("displayName", F.lit("Sole Tenancy"))
    unit = cat(4).isin("Memory: Per GB", "Cores: Per Core", "Cores: 1 to 64")
    vms = (n == 6) & base & (cat(2) == "GCE") & cat(3).isin("VMs On Demand", "VMs Preemptible") & unit & plain & (cat(5) != "Cross VM")
    gpus = base & (cat(2) == "GPUs") & cat(3).isin("GPUs On Demand", "GPUs Preemptible")
    kind = F.when(vms, "VMs").when(gpus & (n == 5), "GPUs").when(gpus & (n == 6), "GPUs_with_Core_and_Memory")
    resource = F.when(kind == "VMs", F.split_part(cat(4), F.lit(":"), F.lit(1))).when(kind == "GPUs", "GPU").otherwise(F.split_part(cat(5), F.lit(":"), F.lit(1)))
    family = F.when(kind == "VMs", F.when(cat(4) == "Cores: 1 to 64", "A2").otherwise(cat(5))).otherwise(cat(4))
    out = skus.select("skuId", kind.alias("kind"), family.alias("family"), S.mapped(cat(3), PRICE_MODELS).alias("model"), resource.alias("resource"), F.explode("regions").alias("region"))
    return out.where(F.col("kind").isNotNull() & (F.col("resource") != "GPU slice"))


def pivot_first(df: DataFrame, index: list[str], label: Column, values: list[str], value: str, *order: str) -> DataFrame:
    """The first value that isn't null by ``order`` for each label, labels as columns; rows with a null index are dropped."""
    first = lambda v: F.min_by(value, F.when((F.col("_label") == v) & F.col(value).isNotNull(), F.struct(*order))).alias(v)
    return df.dropna(subset=index).withColumn("_label", label).groupBy(*index).agg(*(first(v) for v in values))


def machine_prices(machines: DataFrame, units: DataFrame, prices: DataFrame, time: Column) -> DataFrame:
    """On-demand and spot price of each machine type and region from unit prices; rows with any null are dropped.

    ``prices`` (skuId, page, price): of several the first page's counts.  Prices of machines with a GPU family fill in
    those that the machine family lacks.
    """
    once = prices.groupBy("skuId").agg(F.min_by("price", "page").alias("price"))
    priced = units.join(once, "skuId", "left")
    label = F.concat("model", "resource")
    family = pivot_first(priced.where("kind = 'VMs'"), ["family", "region"], label, list(PIVOTED), "price", "skuId")
    gpu = pivot_first(priced.where("kind <> 'VMs'"), ["family", "region"], label, list(PIVOTED), "price", "skuId")
    gpu = gpu.select(F.col("family").alias("gpuType"), "region", *(F.col(c).alias(f"gpu_{c}") for c in PIVOTED))
    rows = machines.join(family.withColumnRenamed("family", "machineFamily"), ["machineFamily", "region"], "left").join(gpu, ["gpuType", "region"], "left")

    def price(model: str) -> Column:
        unit = lambda r: F.coalesce(f"{model}{r}", f"gpu_{model}{r}")
        return S.machine_price(F.col("vcpus"), F.col("memory"), F.col("gpuCount"), unit("Cores"), unit("Memory"), F.col(f"gpu_{model}GPU"))

    rows = rows.withColumns({"OndemandPrice": price("ondemand"), "SpotPrice": price("preemptible"), "Time": time})
    rows = rows.withColumn("Savings", F.try_divide(F.col("OndemandPrice") - F.col("SpotPrice"), "OndemandPrice") * 100)
    return rows.select("Time", F.col("machineType").alias("InstanceType"), F.col("region").alias("Region"), "OndemandPrice", "SpotPrice", "Savings").dropna("any")
