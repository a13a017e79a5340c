"""The queries of op12 and op13 against DuckDB."""

import duckdb
import pytest

import __spark_entry__ as entry_points


@pytest.mark.parametrize("name", ["op12_centroid_clustering", "op13_vector_codes"])
def test_sql(spark, sf_dir, name):
    c = duckdb.connect()
    c.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    rel = c.execute(entry_points.oracle_sql()[name])
    names = [d[0] for d in rel.description]
    df = entry_points.queries()[name](spark, sf_dir)
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(tuple, df.select(names).collect())) == sorted(rel.fetchall())
