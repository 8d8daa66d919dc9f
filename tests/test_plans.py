"""Operators of orders, evaluation designs and feeds against brute force."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from fieldspark.functions import text
from fieldspark.operators import graph, ordering, research
from fieldspark.sources import readers


def test_running_sums_over_ranges_equal_one_pass(spark):
    rng = random.Random(3)
    rows = [(k, x, rng.randint(0, 9)) for k in "ab" for x in rng.sample(range(10000), 500)]
    got = ordering.running_sums(spark.createDataFrame(rows, "k string, x long, v long"), "x", {"upto": F.col("v")}, ["k"]).collect()
    want = {(k, x): sum(v for j, y, v in rows if j == k and y <= x) for k, x, _ in rows}
    assert {(r["k"], r["x"]): r["upto"] for r in got} == want


def test_running_sums_of_no_rows(spark):
    assert ordering.running_sums(spark.createDataFrame([], "x long, v long"), "x", {"upto": F.col("v")}).count() == 0


def test_as_of_takes_the_last_row_at_or_before(spark):
    left = spark.createDataFrame([("a", 5, 1), ("a", 1, 2), ("b", 9, 3), (None, 4, 4)], "k string, t long, id long")
    right = spark.createDataFrame([("a", 2, 10), ("a", 5, 20), ("a", 5, 15), ("b", 10, 30), (None, 1, 40)], "k string, t long, v long")
    got = {r["id"]: r["v"] for r in ordering.as_of_join(left, right, ["k"], "t", ["v"]).collect()}
    assert got == {1: 20, 2: None, 3: None, 4: 40}


def test_conformal_p_values_leave_the_own_fold_out(spark):
    rng = random.Random(6)
    rows = [(i, i % 3, rng.choice("ab"), rng.randint(0, 20) / 20) for i in range(90)]
    frame = spark.createDataFrame([(i, f, c, p, 1 - p) for i, f, c, p in rows], "id long, fold long, label string, p_a double, p_b double")
    got = {(r["id"], r["class"]): r["p_value"] for r in research.cross_fitted_conformal(frame, ["a", "b"]).collect()}
    for i, f, _, p in rows:
        for c in "ab":
            s = 1 - (p if c == "a" else 1 - p)
            others = [1 - (q if c == "a" else 1 - q) for _, g, d, q in rows if d == c and g != f]
            assert got[i, c] == pytest.approx((sum(o >= s for o in others) + 1) / (len(others) + 1))


def test_connected_components(spark):
    rng = random.Random(7)
    edges = [(rng.randrange(50), rng.randrange(50)) for _ in range(35)] + [(i, i + 1) for i in range(100, 125)]
    label = {x: x for e in edges for x in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    linked = {x for a, b in edges if a != b for x in (a, b)}
    got = graph.connected(spark.createDataFrame(edges, "src long, dst long")).collect()
    assert {r["node"]: r["component"] for r in got} == {x: label[x] for x in linked}


def test_feeds_give_their_list_under_known_names():
    assert readers.feed_items('[{"id": 1}]') == readers.feed_items({"results": [{"id": 1}], "n": 1}) == [{"id": 1}]
    with pytest.raises(ValueError):
        readers.feed_items({"rows": []})


def test_universes_are_checked(spark):
    cells = lambda *x: spark.createDataFrame([(c,) for c in x], "hex_id string")
    assert readers.universe_cells(cells("8a", "8b")).count() == 2
    for bad in (cells("8a", "8a"), cells(), spark.createDataFrame([("8a",)], "other string")):
        with pytest.raises(ValueError):
            readers.universe_cells(bad)
    with pytest.raises(ValueError):
        readers.universe_cells(cells("8a", "zz"), valid="[0-9a-f]+")


def test_first_paragraph_of_a_field_wins(spark):
    html = "<p>Pods:</p><P class='x'>PODS: K</P><p>no label</p>"
    got = spark.range(1).select(text.paragraph_fields(F.lit(html), {"pods": "pods"}).alias("x")).first()["x"]
    assert got == {"pods": ""}


def test_blends_prefer_the_smaller_weight_of_equal_ones(spark):
    rows = spark.createDataFrame([("a", 0.5, 0.5, 1, 1.0), ("b", 0.9, 0.1, 0, 1.0)], "k string, p double, q double, y int, w double")
    got = {r["k"]: r["weight"] for r in research.best_blend(rows, ["k"]).collect()}
    assert got == {"a": 0.0, "b": 1.0}


def test_wide_joins_are_narrowed_where_the_result_allows_it(spark, small, monkeypatch):
    from fieldspark.plans import registry, spatial, stages

    plan = lambda name: registry.queries()[name](spark, small)._jdf.queryExecution().optimizedPlan().toString()
    asked, join = [], stages.band_join
    monkeypatch.setattr(stages, "band_join", lambda *a, **k: asked.append(k) or join(*a, **k))
    plan("j_13_same_day_radius")
    assert all(k["radius_km"] == 3 or k["equal"] == ("user",) for k in asked) and all(k["minutes"] == 360 for k in asked)
    monkeypatch.setattr(spatial, "band_join", lambda *a, **k: pytest.fail("rows are paired"))
    plan("j_15_nearest_match")
    plan("a_15_window_support")
    assert "count(distinct" not in plan("a_37_approximate_aggregates")
    assert plan("c_22_archive_dates").count("gettimestamp") <= 4


def test_movement_pairs_places_and_not_rows(spark, small, monkeypatch):
    from fieldspark.plans import registry, stages

    asked, join = [], stages.band_join
    monkeypatch.setattr(stages, "band_join", lambda *a, **k: asked.append(a) or join(*a, **k))
    registry.queries()["a_16_movement_speeds"](spark, small)
    assert all("l_id" not in a.columns and "r_id" not in b.columns for a, b in asked) and asked
