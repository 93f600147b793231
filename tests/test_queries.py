"""Registered queries: every SQL form against DuckDB at the smallest scale, and plan shapes."""

import math
import os
import re

import duckdb
import pytest

import __spark_entry__ as entry_points
from larder.operators import calendar as C
from larder.operators import features as X
from larder.plans.views import Views

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
ORACLES = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return str(v)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf_dir, duck, name):
    df = entry_points.queries()[name](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    at = [names.index(c) for c in df.columns]
    want = [tuple(r[i] for i in at) for r in cursor.fetchall()]
    assert sorted(tuple(map(plain, r)) for r in got) == sorted(tuple(map(plain, r)) for r in want)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_workers(spark, sf_dir):
    v = Views(spark, sf_dir)
    for name in ("J1_waste_table", "W2_rolling_means", "W2b_rolling_means_hot_products", "A7_regression_metrics", "C6_stratified_kfold"):
        text = plan(entry_points.queries()[name](spark, sf_dir))
        assert "EvalPython" not in text and "InPandas" not in text
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    days = C.join_calendar(v.moves, v.cal.select("event_name", "start_date", "end_date"), "dt")
    assert "BroadcastNestedLoopJoin" not in plan(days)


def test_lags_shuffle_the_series_once(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr("l_partkey id", "cast(l_shipdate as date) d", "l_orderkey t", "l_quantity x")
    text = plan(X.add_lag_rolling(rows, ["id"], ["d", "t"], "x"))
    assert text.count("Exchange hashpartitioning") == 1
    assert "l_tax" not in re.findall(r"ReadSchema: .*", text)[0]


def test_entry(spark):
    if not os.path.isdir(entry_points.SMOKE_DIR):
        pytest.skip("test tables are not here")
    assert entry_points.entry(spark).count() > 0
