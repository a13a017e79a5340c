"""Every query with SQL gives the rows that DuckDB gives; every other one runs."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_points

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, ORACLE = entry_points.queries(), entry_points.oracle_sql()
CORE = [n for n in QUERIES if not n.startswith("op") and n != "pipeline"]


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        return round(float(v), 6)
    return str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    c.sql("SET TimeZone='UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return c


@pytest.mark.parametrize("name", CORE)
def test_query(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    if name in ORACLE:
        rel = duck.execute(ORACLE[name])
        names = [d[0] for d in rel.description]
        assert sorted(names) == sorted(df.columns)
        want = rows_of(names, rel.fetchall())
        assert len(got) == len(want)
        assert got == want
    assert df.schema


def test_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    assert entry_points.entry(spark).count() >= 0
