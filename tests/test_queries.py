"""Every bound query against its DuckDB counterpart on the smallest tables."""

from __future__ import annotations

import datetime as dt
import math

import duckdb
import pytest

from fieldspark.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(spark, duck, small, name):
    got = registry.queries()[name](spark, small)
    want = duck.sql(registry.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got.columns, got.collect()) == rows_of(want.columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_query_without_sql_has_rows(spark, small, name):
    assert registry.queries()[name](spark, small).count() > 0


def test_no_cartesian_in_spatial_joins(spark, small):
    for name in ("j_11_match_edges", "j_12_radius_lag_join", "j_14_purged_rows", "j_15_nearest_match"):
        plan = registry.queries()[name](spark, small)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan, name


def test_a_value_like_the_fallback_is_still_the_feeds_own(spark, duck, small, tmp_path):
    duck.execute(f"COPY (SELECT * REPLACE (48.5 AS value) FROM '{small}/events.parquet') TO '{tmp_path}/events.parquet'")
    want = duck.sql(registry.oracle_sql()["c_05_priority_feed"].replace("FROM events", f"FROM '{tmp_path}/events.parquet'"))
    got = registry.queries()["c_05_priority_feed"](spark, str(tmp_path))
    assert rows_of(got.columns, got.collect()) == rows_of(want.columns, want.fetchall())
