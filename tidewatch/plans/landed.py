"""Queries that write with a sink and read back with a reader: archives, logs, snapshots, exports, lists."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import query
from ..sources import readers, sinks
from .tables import read, shared_folder, stored


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/landed-{uuid.uuid4().hex}"


def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest snapshot as JSON records with an id; a null stays one."""
    base = _folder(spark)
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_name", F.when(F.col("c_custkey") % 10 != 0, F.col("c_acctbal")).alias("balance"))
    sinks.write_latest(c, f"{base}/latest_shop.json", ["c_custkey"], also_parquet=f"{base}/latest_shop.parquet")
    out = readers.latest(spark, base, "shop")
    return out.select("id", "c_custkey", "c_name", "balance")


def raw_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks archived as gzipped CSV by day in two writes, read back by day."""
    base = f"{_folder(spark)}/raw"
    e = read(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    sinks.write_raw(e.where("event_type = 'view'"), base, "ts")
    sinks.write_raw(e.where("event_type <> 'view'"), base, "ts")
    back = spark.read.schema("event_id long, user_id long, event_type string, ts timestamp, dt string").option("header", True).csv(base)
    one = readers.partition(back, "2024-01-07").withColumn("part", F.lit("day"))
    return back.withColumn("part", F.lit("all")).unionByName(one).groupBy("part", "dt").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"), F.count_distinct("event_type").alias("types"))


def log_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change log of two batches, one of which is written again: its rows are there once."""
    base = f"{_folder(spark)}/log"
    e = read(spark, sf_dir, "events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    for part in (0, 1, 0):
        sinks.append_changes(e.where(F.col("event_id") % 2 == part), base, batch=f"b{part}")
    back = spark.read.parquet(base)
    return back.groupBy(F.col("batch").cast("string").alias("batch"), F.date_format("dt", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("n"), F.max("event_id").alias("top"))


def selector_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All keys ever seen, kept in a table that is read and replaced."""
    base = f"{_folder(spark)}/selector"
    e = read(spark, sf_dir, "events")
    keys = ["user_id", "event_type"]
    sinks.write_selector(e.where("user_id % 5 = 0"), e.where("user_id % 5 = 1"), base, keys)
    sinks.write_selector(spark.read.parquet(base), e.where("event_type = 'error'"), base, keys)
    return spark.read.parquet(base)


def observed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of complete signals, gathered while a table is written."""
    o = read(spark, sf_dir, "orders").withColumns({"price": F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice")), "state": F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))})
    seen_rows, seen = sinks.observed(o, "signals", {"prices": ["price"], "states": ["state"], "full": ["price", "state"]})
    stored(seen_rows.select("o_orderkey", "price", "state"), "observed")
    return spark.createDataFrame([tuple(seen.get[c] for c in ("rows", "prices", "states", "full"))], "rows long, prices long, states long, full long")


def state_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A small state that is written, replaced and read."""
    path = f"{_folder(spark)}/state"
    top = read(spark, sf_dir, "region").agg(F.max("r_regionkey").alias("last"), F.max("r_name").alias("name")).first()
    sinks.write_state(spark, path, last=-1, name="none")
    sinks.write_state(spark, path, last=top["last"], name=top["name"])
    state = sinks.read_state(spark, path)
    return spark.createDataFrame([(state["last"], state["name"])], "last long, name string")


def export_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month of the archive by vendor and day, one CSV file each; written twice, the second time it is left as it is."""
    base = f"{_folder(spark)}/months"
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.col("o_orderstatus").alias("vendor"), F.col("o_orderdate").cast("timestamp").alias("ts"))
    for _ in range(2):
        sinks.export_month(o, base, "1995-03")
    back = spark.read.schema("o_orderkey long, o_totalprice double, ts timestamp, vendor string, day string").option("header", True).csv(f"{base}/1995-03")
    return back.groupBy("day", "vendor").agg(F.count("*").alias("n"), F.max("o_totalprice").alias("top"))


def exported_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page of a result as one CSV file, and the features of it as text, None for what is missing."""
    base = _folder(spark)
    p = query.page(read(spark, sf_dir, "part").select("p_partkey", "p_brand", F.when(F.col("p_size") > 20, F.col("p_size")).alias("p_size")), 1, 100, F.col("p_partkey"))
    sinks.export_csv(p, f"{base}/page")
    sinks.export_features(readers.csv_table(spark, f"{base}/page", p.schema), f"{base}/features")
    return spark.read.option("header", True).csv(f"{base}/features").select("p_partkey", "p_brand", "p_size")


def external_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files with a header as a view and as a table of the catalogue; either is replaced when made again."""
    base, ddl = f"{_folder(spark)}/csv", "s_suppkey long, s_name string, s_nationkey int"
    read(spark, sf_dir, "supplier").select("s_suppkey", "s_name", F.col("s_nationkey").cast("int").alias("s_nationkey")).write.option("header", True).csv(base)
    name = f"suppliers_{uuid.uuid4().hex}"
    for _ in range(2):
        readers.external_csv(spark, name, base, ddl)
    view = spark.table(name).withColumn("how", F.lit("view"))
    for _ in range(2):
        table = readers.external_table(spark, f"{name}_t", base, ddl)
    return view.unionByName(table.withColumn("how", F.lit("table")))


def formats_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows landed as JSON records, gzipped CSV, Parquet and ORC; a path that isn't there is an empty table."""
    base = _folder(spark)
    n = read(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("k"), F.col("n_name").alias("name"))
    n.coalesce(1).write.json(f"{base}/lines")
    lines = spark.read.text(f"{base}/lines").agg(F.array_join(F.array_sort(F.collect_list("value")), ",").alias("all"))  # 25 rows
    lines.select(F.concat(F.lit("["), "all", F.lit("]"))).coalesce(1).write.text(f"{base}/json")
    n.write.option("header", True).option("compression", "gzip").csv(f"{base}/csv")
    n.write.parquet(f"{base}/parquet")
    n.write.orc(f"{base}/orc")
    found = {
        "json": readers.json_records(spark, f"{base}/json", n.schema), "csv": readers.csv_table(spark, f"{base}/csv", n.schema), "parquet": readers.table(spark, f"{base}/parquet", n.schema),
        "orc": readers.table(spark, f"{base}/orc", n.schema, "orc"), "none": readers.table(spark, f"{base}/none", n.schema),
    }
    out = None
    for kind, df in found.items():
        df = df.select("k", "name", F.lit(kind).alias("kind"))
        out = df if out is None else out.unionByName(df)
    return out


def text_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines up to a blank one, and chosen fields under a banner, of files that are text."""
    base = _folder(spark)
    names = read(spark, sf_dir, "nation").agg(F.array_sort(F.collect_list("n_name")).alias("all"))  # 25 rows
    listed = names.select(F.array_join(F.concat(F.slice("all", 1, 10), F.array(F.lit(" ")), F.slice("all", 11, 15)), "\n"))
    listed.coalesce(1).write.text(f"{base}/list")
    fields = F.transform("all", lambda n, i: F.concat_ws(",", F.lit("x"), n, F.lit(" y "), i.cast("string"), F.when(i % 5 != 0, "z"), F.lit("w")))
    banner = names.select(F.array_join(F.concat(F.array(F.lit("banner"), F.lit("a,b,c,d,e,f")), fields), "\r\n"))
    banner.coalesce(1).write.text(f"{base}/banner")
    one = readers.line_list(spark, f"{base}/list").select(F.col("value").alias("name"), F.lit(None).cast("int").alias("i"), F.lit("list").alias("kind"))
    two = readers.banner_csv(spark, f"{base}/banner", {1: ("name", "string"), 3: ("i", "int")}).select("name", "i", F.lit("banner").alias("kind"))
    return one.unionByName(two)


def path_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time and capacity of ticks from where they landed, folders that Spark has written."""
    base = _folder(spark)
    e = read(spark, sf_dir, "events").select("event_id", "event_type")
    for i, kind in enumerate(("view", "click", "purchase")):
        e.where(F.col("event_type") == kind).coalesce(2).write.parquet(f"{base}/2025/02/1{i}/0{i}-10_sps_{5 * i + 5}.parquet")
    back = spark.read.schema("event_id long, event_type string").option("recursiveFileLookup", True).parquet(base)
    facts = readers.with_path_facts(back).groupBy("event_type", "path_ts", "path_capacity").agg(F.count("*").alias("n"))
    files = readers.listed(spark, base, ".parquet").agg(F.count_if(F.col("length") > 0).alias("files")).select((F.col("files") > 0).alias("listed"))
    return facts.select("event_type", F.col("path_ts").cast("timestamp_ntz").alias("path_ts"), "path_capacity", "n").crossJoin(F.broadcast(files))  # one row


def signals_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signals that are all asked for: what is missing is named."""
    names = ("nation", "region", "supplier")
    found = readers.required(spark, {n: f"{sf_dir}/{n}.parquet" for n in names})
    try:
        readers.required(spark, {"nation": f"{sf_dir}/nation.parquet", "scores": f"{_folder(spark)}/none", "prices": f"{_folder(spark)}/none"})
        told = None
    except ValueError as e:
        told = str(e)
    out = [df.agg(F.count("*").alias("n")).select(F.lit(n).alias("signal"), "n") for n, df in found.items()]
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(spark.createDataFrame([(told, 0)], "signal string, n long"))


_NAMES = (
    latest_snapshot, raw_archive, log_replayed, selector_table, observed_counts, state_kept, export_month, exported_page, external_tables, formats_read, text_lists, path_facts, signals_required,
)
QUERIES = {f.__name__: f for f in _NAMES}

_DAYS = "SELECT strftime(ts, '%Y-%m-%d') AS dt, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids, count(DISTINCT event_type) AS types FROM events GROUP BY ALL"

ORACLE_SQL = {
    "latest_snapshot": "SELECT CAST(row_number() OVER (ORDER BY c_custkey) AS BIGINT) AS id, c_custkey, c_name, CASE WHEN c_custkey % 10 <> 0 THEN c_acctbal END AS balance FROM customer",
    "raw_archive": f"WITH d AS ({_DAYS}) SELECT 'all' AS part, * FROM d UNION ALL SELECT 'day', * FROM d WHERE dt = '2024-01-07'",
    "log_replayed": "SELECT 'b' || (event_id % 2) AS batch, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n, max(event_id) AS top FROM events GROUP BY ALL",
    "selector_table": "SELECT DISTINCT user_id, event_type FROM events WHERE (user_id % 5 IN (0, 1) OR event_type = 'error') AND user_id IS NOT NULL AND event_type IS NOT NULL",
    "observed_counts": """SELECT count(*) AS rows, count(*) FILTER (o_orderkey % 3 <> 0) AS prices, count(*) FILTER (o_orderstatus <> 'P') AS states,
      count(*) FILTER (o_orderkey % 3 <> 0 AND o_orderstatus <> 'P') AS "full" FROM orders""",
    "state_kept": "SELECT CAST(max(r_regionkey) AS BIGINT) AS last, max(r_name) AS name FROM region",
    "export_month": """SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderstatus AS vendor, count(*) AS n, max(o_totalprice) AS top FROM orders
      WHERE o_orderdate >= TIMESTAMP '1995-03-01' AND o_orderdate < TIMESTAMP '1995-04-01' GROUP BY ALL""",
    "exported_page": "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_brand, CASE WHEN p_size > 20 THEN CAST(p_size AS VARCHAR) ELSE 'None' END AS p_size FROM part ORDER BY part.p_partkey LIMIT 100 OFFSET 100",
    "external_tables": "SELECT s_suppkey, s_name, CAST(s_nationkey AS INTEGER) AS s_nationkey, how FROM supplier, (SELECT unnest(['view', 'table']) AS how)",
    "formats_read": "SELECT CAST(n_nationkey AS BIGINT) AS k, n_name AS name, kind FROM nation, (SELECT unnest(['json', 'csv', 'parquet', 'orc']) AS kind)",
    "text_lists": """WITH n AS (SELECT n_name AS name, CAST(row_number() OVER (ORDER BY n_name) - 1 AS INTEGER) AS i FROM nation)
      SELECT name, CAST(NULL AS INTEGER) AS i, 'list' AS kind FROM n WHERE i < 10 UNION ALL SELECT name, i, 'banner' FROM n WHERE i % 5 <> 0""",
    "path_facts": """SELECT event_type, CASE event_type WHEN 'view' THEN TIMESTAMP '2025-02-10 00:10:00' WHEN 'click' THEN TIMESTAMP '2025-02-11 01:10:00' ELSE TIMESTAMP '2025-02-12 02:10:00' END AS path_ts,
      CASE event_type WHEN 'view' THEN 5 WHEN 'click' THEN 10 ELSE 15 END AS path_capacity, count(*) AS n, true AS listed FROM events WHERE event_type IN ('view', 'click', 'purchase') GROUP BY ALL""",
    "signals_required": """SELECT 'nation' AS signal, count(*) AS n FROM nation UNION ALL SELECT 'region', count(*) FROM region UNION ALL SELECT 'supplier', count(*) FROM supplier
      UNION ALL SELECT 'signals are missing: prices, scores', 0""",
}
