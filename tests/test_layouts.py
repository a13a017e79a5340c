"""Plans of tables that are laid out for their joins and queries."""

import json
import uuid

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import diff, query, state
from tidewatch.plans import services
from tidewatch.sources import sinks


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def merged_joins(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_laid_out_joins_shuffle_nothing(merged_joins, sf_dir):
    for df in (services.laid_out_diff(merged_joins, sf_dir), services.laid_out_step(merged_joins, sf_dir)):
        assert "Exchange" not in plan_of(df)
        assert "SortMergeJoin" in plan_of(df)
        assert df.count() > 0


def test_removals_of_laid_out_tables(merged_joins, tmp_path):
    rows = [(i % 50, f"e{i % 3}", i) for i in range(150)]
    schema = "k int, e string, v int"
    one, two = (merged_joins.createDataFrame(r, schema) for r in (rows, rows[30:] + [(99, "x", 1)]))
    a, b = (sinks.write_laid_out(df, f"t_{uuid.uuid4().hex}", str(tmp_path / n), ["k", "e"], 4) for df, n in ((one, "a"), (two, "b")))
    gone = diff.removed_rows(a, b, ["k", "e"], ["v"], nulls=False)
    assert "Exchange" not in plan_of(gone)
    assert {(r.k, r.e) for r in gone.collect()} == {x[:2] for x in rows} - {x[:2] for x in rows[30:]}


def scanned(df):
    """Files and rows that the scans of a query have read."""
    df.collect()
    plan, files, rows, parts = df._jdf.queryExecution().executedPlan(), 0, 0, 0
    todo = [plan]
    while todo:
        p = todo.pop()
        todo += [p.children().apply(i) for i in range(p.children().length())]
        if p.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(p.executedPlan())
        if p.nodeName().endswith("QueryStage"):
            todo.append(p.plan())
        if p.nodeName().startswith("Scan parquet"):
            files += p.metrics().apply("numFiles").value()
            rows += p.metrics().apply("numOutputRows").value()
            parts += p.metrics().apply("numPartitions").value()
    return files, rows, parts


def test_a_query_of_the_clustered_log_reads_little(spark, tmp_path):
    n, path = 200_000, str(tmp_path / "log")
    rows = spark.range(n).select((F.col("id") % 20).cast("string").alias("kind"), (F.col("id") * 7919 % 5000).alias("user"), F.timestamp_seconds(1_704_067_200 + F.col("id") * 5).alias("ts"), F.col("id").alias("value"))
    sinks.append_clustered(rows, path, ["kind", "user"], files=120)
    log = spark.read.parquet(path)
    whole = scanned(log.select("value"))
    start, end = (F.lit(f"2024-01-0{d} 00:00:00").cast("timestamp") for d in (3, 4))
    found = query.wildcard_by_day(log, {"kind": "7", "user": "*"}, start, end)
    files, read, days = scanned(found)
    assert found.count() == rows.where((F.col("kind") == "7") & F.col("ts").between(start, end)).count() > 0
    assert days <= 2 and files < whole[0] / 3 and read < n / 20
    # a value that no file has, though it lies between those that files have: Bloom filters tell
    assert scanned(query.wildcard_by_day(log, {"kind": "70", "user": "*"}, start, end))[1] == 0


def test_unknown_scores(spark):
    prev = spark.createDataFrame([("a", None, 5, 5), ("b", 2, 0, 5)], "k string, SPS int, T3 int, T2 int")
    cur = spark.createDataFrame([("a", None, 0, 0, 1), ("b", None, 0, 0, 5), ("c", None, 0, 0, 1)], "k string, SPS int, T3 int, T2 int, TargetCapacity int")
    got = {r.k: (r.SPS, r.T3, r.T2) for r in state.capacity_step(prev, cur, ["k"], unknown=-1).collect()}
    assert got == {"a": (-1, 0, 0), "b": (2, 0, 1), "c": (-1, 0, 0)}
    assert json.dumps(got)
