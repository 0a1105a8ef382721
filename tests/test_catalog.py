"""Every query with SQL gives what DuckDB gives, on the smallest tables."""

import glob
import math
import os
import re

import duckdb
import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS FROM read_parquet('{p}')")
    return con


def plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 5)
    return str(x) if not isinstance(x, int | str | bool | type(None)) else x


@pytest.mark.parametrize("name", sorted(set(entry.queries()) & set(entry.oracle_sql())))
def test_query(spark, db, name):
    cursor = db.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    want = sorted(repr([plain(r[columns.index(c)]) for c in sorted(columns)]) for r in cursor.fetchall())
    df = entry.queries()[name](spark, DATA)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(repr([plain(r[c]) for c in sorted(columns)]) for r in df.collect()) == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("rows", [[], [(None, None, None)], [(i % 700 if i % 9 else None, i % 30, None) for i in range(3000)]])
def test_approx_distinct_keeps_no_sketch_per_value(spark, tmp_path, rows):
    """Sketches belong to the whole table: grouped by distinct values they need some 40 KB for each of them."""
    spark.createDataFrame(rows, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint").write.parquet(f"{tmp_path}/lineitem.parquet")
    df = entry.queries()["approx_distinct"](spark, str(tmp_path))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "approx_count_distinct" in plan and not re.search(r"keys=\[[^\]]+\], functions=\[[^\]]*approx_count_distinct", plan)
    assert [tuple(r) for r in df.collect()] == [(True, True, True)]
