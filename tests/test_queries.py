"""Every query with SQL gives the rows that DuckDB gives."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def plain(v):
    if v is None:
        return "null"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v + 0.0:.6g}"
    return str(v)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_as_sql(spark, con, name):
    got = entry.queries()[name](spark, SF)
    want = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    order = sorted(names)
    rows = lambda it: sorted(tuple(plain(r[n]) for n in order) for r in it)
    assert rows(r.asDict() for r in got.collect()) == rows(dict(zip(names, r, strict=True)) for r in want.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_filters_reach_the_scan(spark):
    plan = entry.queries()["q_parquet_bbox_scan"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_extendedprice,20000.0)" in plan and "l_discount" not in plan
