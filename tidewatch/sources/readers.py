"""Readers of landed files, with fixed schemas; what isn't there is an empty table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "parquet", **options) -> DataFrame:
    """Any format Spark reads; an absent path gives an empty table of the schema, if one is given."""
    reader = spark.read.format(fmt).options(**options)
    try:
        return (reader.schema(schema) if schema else reader).load(path)
    except AnalysisException as e:
        if schema is None or "PATH_NOT_FOUND" not in str(e.getCondition()):
            raise
        return spark.createDataFrame([], schema)


def json_records(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A file that is one JSON array of records."""
    return table(spark, path, schema, "json", multiLine=True)


def csv_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return table(spark, path, schema, "csv", header=True)


def banner_csv(spark: SparkSession, path: str, fields: dict[int, tuple[str, str]], *, skip: int = 2, least: int = 6) -> DataFrame:
    """Comma-separated text under a banner and a header: the chosen fields of lines with at least ``least`` fields.

    Files are read as lines with their number in the file, so each file loses its own first ``skip`` lines.
    """
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\r?\n")).alias("line", "text"))
    parts = F.split("text", ",")
    rows = lines.where((F.col("line") >= skip) & (F.size(parts) >= least))
    return rows.select(*(F.trim(parts[i]).cast(t).alias(n) for i, (n, t) in fields.items()))


def line_list(spark: SparkSession, path: str) -> DataFrame:
    """Lines up to the first blank one of each file."""
    lines = spark.read.text(path, wholetext=True).select(F.split("value", "\r?\n").alias("lines"))
    first_blank = F.array_position(F.transform("lines", lambda x: F.trim(x) == ""), F.lit(True))
    kept = F.when(first_blank > 0, F.slice("lines", 1, (first_blank - 1).cast("int"))).otherwise(F.col("lines"))
    return lines.select(F.explode(kept).alias("value"))


def with_path_facts(df: DataFrame) -> DataFrame:
    """``path_ts`` and ``path_capacity`` from paths such as .../2025/02/15/00-10_sps_50.parquet, a file or a folder of files."""
    path = F.col("_metadata.file_path")
    day, minute = F.regexp_extract(path, r"(\d{4}/\d{2}/\d{2})/\d{2}-\d{2}", 1), F.regexp_extract(path, r"/(\d{2}-\d{2})[_.]", 1)
    capacity = F.regexp_extract(path, r"/\d{2}-\d{2}[^/]*_(\d+)(?:\.[^/]*)?(?:/[^/]*)?$", 1)
    return df.withColumns({"path_ts": F.try_to_timestamp(F.concat_ws(" ", day, minute), F.lit("yyyy/MM/dd HH-mm")), "path_capacity": capacity.try_cast("int")})


def listed(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """Path, size and time of files with a suffix, at any depth, without reading them."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}").load(path)
    return files.select("path", "length", "modificationTime")


def partition(df: DataFrame, day: str, tick: str | None = None) -> DataFrame:
    """One day (and tick) of a table partitioned by ``dt`` and ``hm``: pruned before any file is opened."""
    out = df.where(F.col("dt") == day)
    return out if tick is None else out.where(F.col("hm") == tick)


def required(spark: SparkSession, paths: dict[str, str], fmt: str = "parquet", schemas: dict[str, T.StructType] | None = None) -> dict[str, DataFrame]:
    """The tables of all named signals; ValueError that names those that aren't there or have no row."""
    found, missing = {}, []
    for name, path in paths.items():
        try:
            reader = spark.read.format(fmt)
            df = (reader.schema(schemas[name]) if schemas and name in schemas else reader).load(path)
            found[name] = df
            missing += [name] if df.isEmpty() else []
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e.getCondition()) and "UNABLE_TO_INFER_SCHEMA" not in str(e.getCondition()):
                raise
            missing.append(name)
    if missing:
        raise ValueError(f"signals are missing: {', '.join(sorted(missing))}")
    return found


def latest(spark: SparkSession, folder: str, vendor: str) -> DataFrame:
    """The latest snapshot of a vendor, as ``sinks.write_latest`` leaves it, and a view ``latest_<vendor>`` of it."""
    out = spark.read.json(f"{folder}/latest_{vendor}.json")
    out.createOrReplaceTempView(f"latest_{vendor}")
    return out


def external_table(spark: SparkSession, name: str, path: str, ddl: str) -> DataFrame:
    """A table of the catalogue over CSV files with a header that stay where they are; replaced if there is one."""
    drop(spark, name)
    spark.sql(f"CREATE TABLE {name} ({ddl}) USING csv OPTIONS (header true) LOCATION '{path}'")
    return spark.table(name)


def external_csv(spark: SparkSession, name: str, path: str, ddl: str) -> None:
    """A view over CSV files with a header, replaced if there is one."""
    drop(spark, name)
    spark.read.schema(ddl).option("header", True).csv(path).createOrReplaceTempView(name)


def drop(spark: SparkSession, name: str) -> None:
    spark.catalog.dropTempView(name)
    spark.sql(f"DROP TABLE IF EXISTS {name}")


ONDEMAND_TERMS = T.MapType(T.StringType(), T.StructType([T.StructField("priceDimensions", T.MapType(T.StringType(), T.StructType([T.StructField("pricePerUnit", T.StructType([T.StructField("USD", T.StringType())]))])))]))
PRICE_LIST = T.StructType([
    T.StructField("product", T.StructType([T.StructField("attributes", T.StructType([T.StructField("instanceType", T.StringType())]))])),
    T.StructField("terms", T.StructType([T.StructField("OnDemand", ONDEMAND_TERMS)])),
])


def ondemand_prices(lines: DataFrame, region: Column) -> DataFrame:
    """Price-list documents (``value``, JSON text) as prices: the first dimension of the first term; free ones are dropped."""
    d = F.from_json("value", PRICE_LIST)
    first = lambda m: F.get(F.map_values(m), F.lit(0))
    usd = first(first(d["terms"]["OnDemand"])["priceDimensions"])["pricePerUnit"]["USD"].try_cast("double")
    out = lines.select(region.alias("Region"), d["product"]["attributes"]["instanceType"].alias("InstanceType"), usd.alias("OndemandPrice"))
    return out.where(F.col("OndemandPrice") != 0)


def spot_history(history: DataFrame) -> DataFrame:
    """Spot prices of Linux machines, the newest of each type and zone."""
    linux = history.where(F.col("ProductDescription") == "Linux/UNIX")
    return linux.groupBy("InstanceType", "AZ").agg(F.max_by(F.col("SpotPrice").try_cast("double"), "Timestamp").alias("SpotPrice"))


def eviction_resources(resources: DataFrame) -> DataFrame:
    """Location, SKU and eviction rate from a resource graph: type in any case, rates from JSON properties, blanks dropped."""
    of = lambda name: F.get_json_object("properties", f"$.{name}")
    sku = F.coalesce(of("skuName"), F.get_json_object("sku", "$.name")) if "sku" in resources.columns else of("skuName")
    own = F.lower("type") == "microsoft.compute/skuspotevictionrate/location"
    out = resources.where(own).select("location", sku.alias("skuName"), of("evictionRate").alias("evictionRate"))
    return out.where((F.length("evictionRate") > 0) & (F.length("skuName") > 0) & (F.length("location") > 0))


def machine_types(machines: DataFrame, zones: DataFrame) -> DataFrame:
    """Machine types by region: zones are told by the region's name as prefix; a type counts once for each region."""
    regions = zones.withColumn("region", F.regexp_extract("zone", "^(.*)-[^-]*$", 1)).select("zone", "region")
    out = machines.join(regions, "zone").withColumn("memory", F.col("memoryMb") / 1024)
    return out.withColumn("machineFamily", F.upper(F.split_part("machineType", F.lit("-"), F.lit(1)))).dropDuplicates(["region", "machineType"])


def hardware_aws(rows: DataFrame) -> DataFrame:
    """Hardware of machine types that are sold both ways, from nested descriptions; what is missing is null."""
    both = F.array(F.lit("on-demand"), F.lit("spot"))
    gpu = F.get("GpuInfo.Gpus", F.lit(0))
    return rows.where(F.col("SupportedUsageClasses") == both).select(
        "InstanceType", F.get("ProcessorInfo.SupportedArchitectures", F.lit(0)).alias("architecture"), F.col("VCpuInfo.DefaultVCpus").alias("vcpus"),
        F.col("MemoryInfo.SizeInMiB").alias("memory_mib"), F.col("InstanceStorageInfo.TotalSizeInGB").alias("storage_gb"),
        F.col("NetworkInfo.NetworkPerformance").alias("network"), gpu["Name"].alias("gpu"), gpu["Count"].alias("gpus"),
    )


def hardware_azure(rows: DataFrame, wanted: list[str]) -> DataFrame:
    """Capabilities by name as columns, names in lower case; of a name's several values the last wins, of repeated machines
    the last by name of family."""
    named = F.transform("capabilities", lambda c: F.lower(c["name"]))
    last = F.filter("capabilities", lambda c, i: F.array_position(F.slice(named, i + 2, F.size("capabilities")), F.lower(c["name"])) == 0)
    entries = F.transform(last, lambda c: F.struct(F.lower(c["name"]).alias("k"), c["value"].alias("v")))
    out = rows.where(F.col("resourceType") == "virtualMachines").withColumn("_m", F.map_from_entries(entries))
    return out.groupBy("name").agg(F.max("family").alias("family"), *(F.max_by(F.col("_m")[w.lower()], "family").alias(w) for w in wanted))


def scraped_map(pages: DataFrame, text: str, pattern: str = r'"([^"]+)":"([^"]*)"') -> DataFrame:
    """Keys and values that a pattern with two groups finds in scripts, as a map; of repeated keys the last wins."""
    keys, values = F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), F.regexp_extract_all(text, F.lit(pattern), F.lit(2))
    pairs = F.arrays_zip(keys.alias("k"), values.alias("v"))
    last = F.filter(pairs, lambda p, i: F.array_position(F.slice(F.transform(pairs, lambda x: x["k"]), i + 2, F.size(pairs)), p["k"]) == 0)
    return pages.withColumn("pairs", F.map_from_entries(last))
