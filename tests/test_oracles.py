"""Registered queries beside their oracle statements, and the shape of their plans."""

import datetime as dt
import math
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as spark_entry
from wayline.workload.registry import ORACLES, QUERIES
from wayline.workload.views import TABLES

SAMPLE = ["mart_airline_performance", "mart_city_revenue", "mart_user_cohorts", "stg_listings", "dim_airports",
          "dash_occupancy_grid", "window_named_count", "agg_median_quantile", "join_nth_candidate",
          "join_null_tolerant_or", "fx_daily_rates", "scd2_snapshot", "enrich_classify", "embed_batches",
          "sql_guard_batch", "vector_search_topk", "check_severity_warn"]


def cell(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return repr(float(v) + 0.0) if isinstance(v, (float, Decimal)) else repr(v)


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def oracle(small_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{small_dir}/{name}.parquet'")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES) and len(QUERIES) >= 183
    assert set(QUERIES) <= set(spark_entry.queries()) and set(ORACLES) <= set(spark_entry.oracle_sql())


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_oracle(spark, small_dir, oracle, name):
    df = spark_entry.queries()[name](spark, small_dir)
    want = oracle.sql(spark_entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert table(df.columns, df.collect()) == table(want.columns, want.fetchall())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0
