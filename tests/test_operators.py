"""Operators on small fixtures, against brute force and stated invariants."""

from __future__ import annotations

import itertools
import math
import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from fieldspark.functions import temporal, text
from fieldspark.functions.geo import Box, haversine_km, repair_coordinates
from fieldspark.functions.stats import noisy_or, wilson_upper
from fieldspark.operators import cdc, counts, entity, graph, imputation, metrics, quality
from fieldspark.operators.spatial_join import band_join


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def km(a, b):
    la, lb, d = math.radians(a[0]), math.radians(b[0]), math.radians(b[1] - a[1])
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin(d / 2) ** 2
    return 2 * 6371.0088 * math.asin(math.sqrt(h))


def test_band_join_equals_nested_loop(spark):
    rng = random.Random(1)
    side = lambda n: [(i, rng.uniform(47, 48), rng.uniform(-124, -123), date(2024, 1, rng.randint(1, 9))) for i in range(n)]
    a, b = side(120), side(150)
    schema = "id int, lat double, lon double, day date"
    left, right = (spark.createDataFrame(x, ", ".join(f"{p}_{c}" for c in schema.split(", "))) for p, x in (("l", a), ("r", b)))
    got = {(r["l_id"], r["r_id"]) for r in band_join(left, right, radius_km=6, lag_days=2).collect()}
    want = {(x[0], y[0]) for x, y in itertools.product(a, b) if km(x[1:3], y[1:3]) <= 6 and abs((x[3] - y[3]).days) <= 2}
    assert got == want and want
    assert {r["l_id"] for r in band_join(left, right, radius_km=6, lag_days=2, how="left_anti").collect()} == {x[0] for x in a} - {p for p, _ in want}


@pytest.mark.parametrize("radius", [20, 700])
def test_band_join_holds_at_the_poles_and_the_date_line(spark, radius):
    rng = random.Random(radius)
    places = [(lat, lon) for lat in (82.0, 89.9, -89.95, 0.0, 60.0) for lon in (-179.99, 179.99, 0.0, 0.15)]
    places += [(rng.choice([-1, 1]) * rng.uniform(80, 90), rng.uniform(-180, 180)) for _ in range(200)]
    places += [(rng.uniform(-90, 90), rng.choice([-180, 180]) + rng.uniform(-3, 3)) for _ in range(150)]
    rows = [(i, lat, (lon + 180) % 360 - 180, date(2024, 1, 1)) for i, (lat, lon) in enumerate(places)]
    left, right = (spark.createDataFrame(rows, f"{p}_id int, {p}_lat double, {p}_lon double, {p}_day date") for p in "lr")
    got = [(r["l_id"], r["r_id"]) for r in band_join(left, right, radius_km=radius, lag_days=0).collect()]
    want = {(x[0], y[0]) for x, y in itertools.product(rows, rows) if km(x[1:3], y[1:3]) <= radius}
    assert len(got) == len(set(got)) and set(got) == want


def test_haversine_of_antipodes_is_finite(spark):
    assert one(spark, haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0))) == pytest.approx(math.pi * 6371.0088)


def test_coordinates_need_one_place(spark):
    box = Box(40, 60, -130, -110)
    fix = lambda lat, lon, west: one(spark, repair_coordinates(F.lit(lat), F.lit(lon), box, F.lit(west)))
    assert fix(48.0, -123.0, False)["transform"] == "NONE"
    assert fix(-123.0, 48.0, False)["transform"] == "SWAPPED_LAT_LON"
    assert fix(48.0, 123.0, True)["transform"] == "WEST_SIGN_INFERRED"
    assert fix(48.0, 123.0, False) is None


def test_wall_clock_times_that_a_zone_skips_or_repeats_are_null(spark):
    utc = lambda t: one(spark, temporal.local_to_utc(F.lit(t).cast("timestamp"), "America/Los_Angeles"))
    assert utc("2024-03-10 02:30:00") is None
    assert utc("2024-11-03 01:30:00") is None
    assert utc("2024-07-01 12:00:00") == datetime(2024, 7, 1, 19)


def test_missing_tokens(spark):
    assert one(spark, text.first_present(F.lit("NaN"), F.lit(" "), F.lit(" x "))) == " x "
    assert one(spark, text.source_text(F.lit("N/A"))) is None
    assert one(spark, text.labelled_notes(F.array(F.lit("Pods: J"), F.lit("pods: K"), F.lit("z: 1")), {"pods": "pods"})) == {"pods": "K"}


def test_noisy_or_keeps_certain_causes(spark):
    rows = spark.createDataFrame([("a", 0.5), ("a", 0.5), ("b", 1.0), ("b", 0.1), ("c", 0.0)], "k string, p double")
    got = {r["k"]: r["x"] for r in rows.groupBy("k").agg(noisy_or(F.col("p")).alias("x")).collect()}
    assert got == {"a": pytest.approx(0.75), "b": 1.0, "c": 0.0}


def test_wilson_bound_of_nothing_is_one(spark):
    assert one(spark, wilson_upper(F.lit(0), F.lit(0))) == 1.0
    assert one(spark, wilson_upper(F.lit(0), F.lit(100))) == pytest.approx(0.0370, abs=1e-3)


def test_unit_mass_is_kept(spark):
    rows = [(1, "MIXED", "OTHER", 0.25, 0.25, 0.25, 0.25), (2, "OFFSHORE", "OTHER", 0.0, 0.0, 0.0, 0.0)]
    obs = spark.createDataFrame(rows, "observation_id int, detail string, bucket string, expected_srkw double, expected_transient double, expected_unknown double, expected_other double")
    parts = counts.expected_contributions(obs).collect()
    by = {i: sum(r["expected_count"] for r in parts if r["observation_id"] == i) for i in (1, 2)}
    assert by == {1: 1.0, 2: 1.0}
    assert {(r["detail"], r["bucket"]) for r in parts if r["observation_id"] == 1} == {("SRKW", "SRKW"), ("TRANSIENT", "TRANSIENT"), ("UNKNOWN", "OTHER"), ("MIXED", "OTHER")}


def test_bad_masses_are_counted(spark):
    rows = [(float("nan"), 0.0), (float("inf"), 0.0), (1.1, -0.1), (0.4, 0.4), (0.5, 0.5)]
    got = counts.mass_violations(spark.createDataFrame(rows, "a double, b double"), ["a", "b"]).first()
    assert (got["not_finite"], got["outside"], got["not_unit"]) == (2, 1, 1)


def test_unverified_coverage_never_reports_zero(spark):
    assert one(spark, counts.reporting_state(F.lit(0), F.lit(False))) == "UNAVAILABLE"
    with pytest.raises(ValueError, match="coverage"):
        counts.dense_grid(None, None, None, [], verified=False)


def test_bounded_distances(spark):
    edges = graph.undirected(spark.createDataFrame([("a", "b", 2.0), ("a", "c", 10.0), ("b", "c", 2.0), ("c", "d", 1.0)], "src string, dst string, weight double"))
    got = graph.within(edges, spark.createDataFrame([("a",), ("z",)], "node string"), 4.0).collect()
    assert {(r["origin"], r["node"]): r["distance"] for r in got} == {("a", "a"): 0, ("a", "b"): 2, ("a", "c"): 4, ("z", "z"): 0}


def test_alias_cycles_are_refused(spark):
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "alias string, target string")
    with pytest.raises(ValueError, match="cycle"):
        graph.resolve_chains(links)
    got = graph.resolve_chains(links.filter("alias <> 'c'")).collect()
    assert {r["alias"]: r["target"] for r in got} == {"a": "c", "b": "c"}


def greedy(records, links):
    groups, out = [], {}
    for r in records:
        whole = [g for g in groups if all(x in links.get(r, set()) for x in g)]
        if len(whole) == 1:
            whole[0].append(r)
        else:
            groups.append([r])
    for g in groups:
        out.update(dict.fromkeys(g, g[0]))
    return out


def test_complete_link_equals_the_greedy_rule(spark):
    rng = random.Random(4)
    pairs = {tuple(sorted(rng.sample(range(40), 2))) for _ in range(70)}
    links = {}
    for a, b in pairs:
        links.setdefault(a, set()).add(b)
        links.setdefault(b, set()).add(a)
    obs = spark.createDataFrame([(i,) for i in range(40)], "observation_id long")
    got = entity.complete_link(obs, spark.createDataFrame(sorted(pairs), "l_id long, r_id long"), ["observation_id"]).collect()
    assert {r["observation_id"]: r["group_id"] for r in got} == greedy(range(40), links)


def test_encounters_join_the_largest_group_that_fits(spark):
    rng = random.Random(9)
    pairs = {tuple(sorted(rng.sample(range(30), 2))) for _ in range(160)}
    links = {i: {b for p in pairs for b in p if i in p} for i in range(30)}
    groups = []
    for i in range(30):
        whole = [g for g in groups if links[i].issuperset(g)]
        if whole:
            min(whole, key=lambda g: (-len(g), g)).append(i)
        else:
            groups.append([i])
    obs = spark.createDataFrame([(i,) for i in range(30)], "observation_id long")
    got = entity.encounters(obs, spark.createDataFrame(sorted(pairs), "l_id long, r_id long")).collect()
    of = {}
    for r in got:
        of.setdefault(r["encounter"], []).append(r["observation_id"])
    assert sorted(map(sorted, of.values())) == sorted(map(sorted, groups)) and all(r["size"] == len(of[r["encounter"]]) for r in got)


def test_only_trusted_associations_link(spark):
    rows = [("1", "member", "j35", "Strong", False), ("1", "POD", "J", "WEAK", False), ("2", "POD", "K", "EXPLICIT", True), ("2", "ECOTYPE", "SRKW", "EXPLICIT", False), ("3", "SOCIAL_GROUP", "T65A", "EXPLICIT", None), ("4", "POD", "L", "STRONG", False)]
    got = entity.trusted_keys(spark.createDataFrame(rows, "observation_id string, kind string, value string, confidence string, conflicting boolean")).collect()
    assert sorted(map(tuple, got)) == [("1", "MEMBER", "J35"), ("4", "POD", "L")]


def test_chains_are_not_merged_and_need_review(spark):
    obs = spark.createDataFrame([(1,), (2,), (3,)], "observation_id long")
    got = entity.complete_link(obs, spark.createDataFrame([(1, 2), (2, 3)], "l_id long, r_id long"), ["observation_id"]).collect()
    assert {r["observation_id"]: (r["group_id"], r["status"]) for r in got} == {1: (1, "ORIGINAL"), 2: (1, "MERGED"), 3: (3, "REVIEW_REQUIRED")}


def test_identities_merge_and_split(spark):
    groups = spark.createDataFrame([("r1", 1), ("r2", 1), ("r3", 2), ("r4", 3), ("r5", 4)], "record_id string, group_id long")
    known = spark.createDataFrame([("r1", "A", 0), ("r2", "B", 1), ("r3", "C", 2), ("r4", "C", 2)], "record_id string, observation_id string, rank int")
    ids, lineage = entity.resolve_identities(groups, known, "obs:")
    of = {r["record_id"]: r["observation_id"] for r in ids.collect()}
    assert of["r1"] == of["r2"] == "A" and of["r3"] != of["r4"] and "C" not in of.values() and of["r5"].startswith("obs:")
    assert sorted((r["old_id"], r["kind"]) for r in lineage.collect()) == [("B", "MERGE"), ("C", "SPLIT"), ("C", "SPLIT")]


def test_negated_mentions_are_no_evidence(spark):
    rows = spark.createDataFrame([(1, "x", "not a transient, J35 seen"), (2, "x", "transients"), (3, "x", None)], "record_id long, source string, d string")
    facts = entity.evidence(rows, {"d": False}).collect()
    assert {(r["record_id"], r["kind"], r["value"]) for r in facts} == {(1, "MEMBER", "J35"), (1, "POD", "J"), (1, "ECOTYPE", "SRKW"), (2, "ECOTYPE", "TRANSIENT")}


def history(spark, rows):
    return cdc.with_checksum(spark.createDataFrame(rows, "record_id string, source string, retrieval_id string, retrieved_at date, arrival int, payload string"))


def test_a_changed_payload_is_one_transition_and_replay_adds_none(spark):
    old = history(spark, [("a", "s", "1", date(2024, 1, 1), 0, '{"value":1}')])
    new = history(spark, [("a", "s", "2", date(2024, 1, 2), 0, '{"value":2}'), ("a", "s", "3", date(2024, 1, 3), 0, '{"value":2}')])
    delta = cdc.transitions(new, old)
    assert [r["retrieval_id"] for r in delta.collect()] == ["2"]
    both = old.unionByName(delta.select(old.columns))
    assert cdc.transitions(new, both).count() == 0
    assert cdc.corrections(both).first()["versions"] == 2


def test_older_snapshots_are_refused(spark):
    old = history(spark, [("a", "s", "1", date(2024, 1, 2), 0, "x")])
    with pytest.raises(ValueError, match="older"):
        cdc.refuse_older(history(spark, [("a", "s", "0", date(2024, 1, 1), 0, "x")]), old)


def test_first_failing_gate_is_named(spark):
    rows = spark.createDataFrame([(1, 1), (2, None), (30, 3)], "a int, b int")
    accepted, rejected = quality.split_by_gates(rows, [("A", F.col("a") < 10), ("B", F.col("b").isNotNull())])
    assert accepted.count() == 1 and {r["reject_reason"] for r in rejected.collect()} == {"A", "B"}


def test_auc_counts_ties_by_half(spark):
    rows = spark.createDataFrame([(1, 0.9), (0, 0.9), (1, 0.2), (0, 0.1)], "y int, p double").withColumn("w", F.lit(1.0))
    assert metrics.auc(rows).first()["auc"] == pytest.approx(0.625)


def test_sources_sinks_and_releases(spark, tmp_path):
    from pyspark.sql import types as T

    from fieldspark.sources import readers, sinks

    (tmp_path / "a.csv").write_text("ID,Date,Latitude,Longitude,Pod\n1,2024-05-01,48.5,-123.1,J pod\n,2024-05-02,48.6,-123.2,\n")
    rows = readers.adapt("csv", readers.read_text_csv(spark, f"{tmp_path}/a.csv"), "TWM", ["id", "date", "latitude", "longitude", "pod"])
    got = sorted(r["record_id"] for r in rows.collect())
    assert got[0] == "TWM:1" and got[1].startswith("TWM:sha256:") and rows.columns == readers.SOURCE_RECORD.names
    with pytest.raises(ValueError, match="declared"):
        readers.require_complete(rows, 3, "record_id")
    assert readers.retry_after("7") == 7 and readers.retry_after("-1") == 0 and readers.retry_after("x") is None

    pages = [{"total_results": 3, "results": [{"id": 1}, {"id": 2}]}, {"total_results": 1, "results": [{"id": 5}]}]
    api = readers.PagedApi(lambda params: pages[0 if params["id_above"] == 0 else 1], page_size=2)
    assert api.land(spark, {}, f"{tmp_path}/landed").count() == 3

    contract = quality.Contract(T.StructType([T.StructField("k", T.LongType(), False), T.StructField("v", T.StringType())]), ("k",))
    table = spark.createDataFrame([(1, "a"), (2, None)], "k long, v string")
    assert sinks.write_validated(table, f"{tmp_path}/t", contract).count() == 2
    with pytest.raises(ValueError, match="repeated key"):
        sinks.write_validated(table.union(table), f"{tmp_path}/t", contract)
    assert spark.read.parquet(f"{tmp_path}/t").count() == 2
    assert [sinks.append_new(table, f"{tmp_path}/log", ["k"]) for _ in range(2)] == [2, 0]
    assert sinks.content_hash(table) == sinks.content_hash(table.orderBy(F.desc("k")))
    manifest = sinks.promote(tmp_path / "r", {"t": sinks.content_hash(table)}, {"coverage": True}, {})
    assert sinks.validate_release(manifest) == []
    manifest.write_text(manifest.read_text().replace('"coverage": true', '"coverage": false'))
    assert len(sinks.validate_release(manifest)) == 2
    with pytest.raises(ValueError, match="gates"):
        sinks.promote(tmp_path / "r", {}, {"mass": False}, {})
    assert [sinks.retention(*x) for x in ((None, 1), (10, 9), (100, 105), (100, 200))] == ["KEEP_NO_BASELINE", "KEEP_SHRUNK", "PRUNE", "KEEP_GREW_TOO_MUCH"]


def test_configuration_documents(tmp_path):
    from fieldspark.plans import config

    (tmp_path / "a.json").write_text('{"x": {"p": 1, "q": 2}, "token": "${env:T}"}')
    (tmp_path / "b.json").write_text('{"extends": "a.json", "x": {"q": 3}, "name": "n-${x.q}"}')
    got = config.resolve(config.load(tmp_path / "b.json"), {"T": "s"})
    assert got == {"x": {"p": 1, "q": 3}, "token": "s", "name": "n-3"} and config.redact(got)["token"] == "***"
    (tmp_path / "a.json").write_text('{"extends": "b.json"}')
    with pytest.raises(ValueError, match="extend"):
        config.load(tmp_path / "b.json")
    with pytest.raises(ValueError, match="unknown"):
        config.strict({"z": 1}, {"a": 1})


def test_streams(spark, tmp_path):
    from fieldspark.streaming import stateful

    src = f"{tmp_path}/in"
    rows = [(i, datetime(2024, 1, 1 + i % 5, 12), i % 3, "view", 1.0) for i in range(60)]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double").write.parquet(src)
    schema = spark.read.parquet(src).schema
    q = stateful.run_to_parquet(stateful.windowed_counts(stateful.read_events(spark, src, schema), ["event_type"]), f"{tmp_path}/out", f"{tmp_path}/c1")
    q.awaitTermination(120)
    done = spark.read.parquet(f"{tmp_path}/out").collect()
    assert all(r["events"] == 12 for r in done) and 1 <= len(done) <= 5

    history = [("a", "s", "1", date(2024, 1, 1), 0, "x"), ("a", "s", "2", date(2024, 1, 2), 1, "x"), ("a", "s", "3", date(2024, 1, 3), 2, "y")]
    spark.createDataFrame(history, "record_id string, source string, retrieval_id string, retrieved_at date, arrival int, payload string").write.parquet(f"{tmp_path}/h")
    for c in ("c2", "c3"):  # the second run replays all files against the history
        stream = stateful.read_events(spark, f"{tmp_path}/h", spark.read.parquet(f"{tmp_path}/h").schema)
        stateful.upsert_history(stream, f"{tmp_path}/history", f"{tmp_path}/{c}").awaitTermination(120)
    assert sorted(r["retrieval_id"] for r in spark.read.parquet(f"{tmp_path}/history").collect()) == ["1", "3"]


def test_query_facade(spark):
    from fieldspark.plans.query import Request, count_products, query_observations
    from fieldspark.sources.readers import SOURCE_RECORD, source_records

    rows = [
        ("1", "TWM", "J pod", "2024-05-01T10:00:00", "2024-05-01", "48.500", "-123.100"),
        ("2", "CWR", "SRKW", "2024-05-01T10:05:00", "2024-05-01", "48.501", "-123.100"),
        ("3", "CWR", "transients", "2024-05-01T10:05:00", "2024-05-01", "48.501", "-123.100"),
        ("4", "CWR", None, None, "not a date", "48.5", "-123.1"),
    ]
    raw = spark.createDataFrame(rows, "id string, s string, label_raw string, observed_at_raw string, observed_date_raw string, latitude_raw string, longitude_raw string").withColumn("payload", F.col("id"))
    records = source_records(raw.filter("s = 'TWM'"), "TWM", "id").unionByName(source_records(raw.filter("s = 'CWR'"), "CWR", "id"))
    assert records.columns == SOURCE_RECORD.names
    request = Request(date(2024, 4, 29), date(2024, 5, 12))
    obs = query_observations(spark, records, request)
    assert sorted((r["detail"], tuple(r["sources"])) for r in obs.collect()) == [("SRKW", ("CWR", "TWM")), ("TRANSIENT", ("CWR",))]
    products = count_products(obs, request)
    assert products["weekly"].count() == 2 and {r["reporting_state"] for r in products["totals"].collect()} == {"REPORTED", "UNAVAILABLE"}
    with pytest.raises(ValueError, match="window"):
        Request(date(2024, 5, 2), date(2024, 5, 1))


def test_report_and_command_line(spark, small, tmp_path, capsys):
    import json

    from fieldspark import cli
    from fieldspark.plans import report
    from fieldspark.plans.base import sightings

    obs = sightings(spark, small)
    got = report.build(obs)
    assert got["extent"]["observations"] == obs.count() == sum(x["observations"] for x in got["sources"]) == sum(x["observations"] for x in got["days"])
    with pytest.raises(ValueError, match="repeated"):
        report.build(obs.union(obs))
    with pytest.raises(ValueError, match="missing"):
        report.build(obs.drop("lat"))
    assert cli.main(["list"]) == 0 and "a_04_weekly_counts" in capsys.readouterr().out
    assert cli.main(["run", "a_20_source_summary", small, f"{tmp_path}/out", "--format", "json"]) == 0
    assert spark.read.json(f"{tmp_path}/out").count() == 6
    obs.write.parquet(f"{tmp_path}/obs")
    assert cli.main(["report", f"{tmp_path}/obs", f"{tmp_path}/r.json"]) == 0
    assert json.loads((tmp_path / "r.json").read_text())["extent"]["observations"] == obs.count()


def test_acceptance_tries_quantiles_and_all_regimes(spark):
    # Right above 0.955 only: no fixed threshold but 0.975 meets the target, and it accepts less than the quantile does.
    rows = [(int(i >= 400), 0.9 + 0.0001 * i, "high") for i in range(900)] + [(1, 0.9, "few")] * 5 + [(0, 0.2, f"r{i:04}") for i in range(1005) for _ in range(2)]
    rows = [(y, min(p, 0.9899), r) for y, p, r in rows]
    scored = spark.createDataFrame(rows, "y int, p double, regime string")
    rules = {(r["class"], r["regime"]): r for r in imputation.acceptance_rules(scored, ("A", "B"), target=0.05).collect()}
    high = rules["A", "high"]
    assert high["status"] == "OK" and 0.93 < high["threshold"] < 0.945 and high["threshold"] not in (0.925, 0.95)
    assert len(rules) == 2 * 1007 + 2 and rules["B", "r1004"]["status"] == "CLASS_OK" and rules["A", "few"]["status"].startswith("CLASS_")
    new = spark.createDataFrame([(1, 0.1, "unseen"), (2, 0.9, "few")], "id int, p double, regime string")
    got = {r["id"]: r for r in imputation.decide(new, scored.transform(imputation.acceptance_rules, ("A", "B"), target=0.05), ("A", "B")).collect()}
    assert got[1]["accepted"] and not got[2]["accepted"]
    assert {r["status"] for r in imputation.acceptance_rules(scored.filter("regime = 'few'"), ("A", "B")).collect()} == {"CLASS_TOO_FEW"}


def test_groups_without_stored_matches_equal_those_of_the_edges(spark):
    rng = random.Random(12)
    labels = ["UNKNOWN", "SRKW", "TRANSIENT", None]
    rows = []
    for i in range(700):
        spot = (rng.uniform(47, 47.5), rng.uniform(-123, -122.5)) if i % 3 else (rng.uniform(-1, 1), rng.choice([179.9, -179.9]) + rng.uniform(-0.09, 0.09))
        at = datetime(2024, 1, rng.randint(1, 2), rng.randint(0, 23), rng.randint(0, 59)) if i % 13 else None
        rows.append((i * 7919 % 1009, rng.randint(0, 4) if i % 17 else None, rng.choice(labels), *spot, date(2024, 1, at.day if at else 1), at))
    obs = spark.createDataFrame(rows, "observation_id long, source int, detail string, lat double, lon double, sighting_date date, event_at timestamp")
    near = {"distance_m": 15000, "minutes": 90}
    edges = entity.match_edges(obs, **near)
    assert edges.count() > 500
    order = ["sighting_date", "event_at", "observation_id"]
    same = lambda a, b: sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert same(entity.complete_link_near(obs, order, **near), entity.complete_link(obs, edges, order))
    assert same(entity.encounters_near(obs, **near), entity.encounters(obs, edges))


def test_busy_groups_store_no_matches(spark, monkeypatch):
    monkeypatch.setattr(entity, "match_edges", lambda *a, **k: pytest.fail("a table of all matches grows with the square of a day"))
    from fieldspark.plans import registry

    for name in ("e_01_complete_link_groups", "e_02_encounters"):
        assert registry.queries()[name](spark, "/root/testdata/sf0.001").count() > 0


@pytest.mark.parametrize("moved", [False, True])
def test_support_without_pairs_equals_brute_force_and_leaves_the_own_anchor_out(spark, moved):
    rng = random.Random(3)
    spots = [(47 + rng.uniform(0, 0.3), -123 + rng.uniform(0, 0.3)) for _ in range(25)]
    anchors = [(i, *rng.choice(spots), date(2024, 1, rng.randint(1, 6)), rng.choice("AB"), rng.choice([1.0, 0.5]), rng.randint(0, 4)) for i in range(150)]
    shift = 0.01 if moved else 0.0
    targets = [(i, la + (shift if i % 9 == 0 else 0), lo, d) for i, la, lo, d, *_ in anchors if i % 3] + [(1000 + i, *rng.choice(spots), date(2024, 1, rng.randint(1, 6))) for i in range(40)]
    left = spark.createDataFrame(targets, "l_id int, l_lat double, l_lon double, l_day date")
    right = spark.createDataFrame(anchors, "r_id int, r_lat double, r_lon double, r_day date, r_label string, r_weight double, r_encounter int")
    got = {r["id"]: r for r in imputation.support_features(left, right, ("A", "B"), radius_km=10, lag_days=2).collect()}
    moves = {(r["id"], r["kernel"], r["label"], r["direction"]): r["support"] for r in imputation.transport_support(left, right, [("k", 9.0, 2.0, 20.0)], radius_km=10, lag_days=2).collect()}
    assert len(got) == len(targets)
    walked = {}
    for i, la, lo, d in targets:
        units, days = {}, {}
        for j, lb, lp, e, label, w, enc in anchors:
            x, lag = km((la, lo), (lb, lp)), (e - d).days
            if i != j and x <= 10 and abs(lag) <= 2:
                u = units.setdefault((label, enc), [0.0, 99.0])
                u[0], u[1] = max(u[0], w * math.exp(-x / 5) * math.exp(-abs(lag))), min(u[1], x)
                days[label] = max(days.get(label, 0), int(lag == 0))
                k = (i, "k", label, "PAST" if lag < 0 else "FUTURE" if lag else "SAME_DAY", enc)
                walked[k] = max(walked.get(k, 0.0), w * math.exp(-x / 9 - abs(lag) / 2 - x / max(abs(lag), 1) / 20))
        for c in "AB":
            mine = [u for (label, _), u in units.items() if label == c]
            r, s = got[i], sum(u[0] for u in mine)
            assert (r[f"{c}_units"], r[f"{c}_same_day"]) == (len(mine), days.get(c, 0)) and r[f"{c}_support"] == pytest.approx(s)
            assert r[f"{c}_effective"] == pytest.approx(s * s / sum(u[0] ** 2 for u in mine) if mine else 0)
            assert r[f"{c}_nearest"] == (pytest.approx(min(u[1] for u in mine), abs=1e-9) if mine else None)
    want = {}
    for k, w in walked.items():
        want[k[:4]] = want.get(k[:4], 0.0) + w
    assert moves == pytest.approx(want)


def test_surroundings_are_gathered_by_place_and_not_by_row(spark):
    from fieldspark.operators.spatial_join import gather

    left = spark.range(400).selectExpr("id l_id", "47.0D + (id % 2) / 100 l_lat", "-123.0D l_lon", "date'2024-01-01' l_day")
    right = spark.range(300).selectExpr("id r_id", "47.0D r_lat", "-123.0D + (id % 3) / 100 r_lon", "date'2024-01-02' r_day", "id % 5 r_unit")
    got = gather(left, right, ["r_unit"], {"n": F.count("r_id"), "km": F.min("km")}, radius_km=5, lag_days=1).collect()
    assert len(got) == 2 * 5 and {(r["lag"], r["n"]) for r in got} == {(1, 60)}


def test_chains_with_heavy_targets_are_dealt_by_number_of_links(spark, monkeypatch):
    monkeypatch.setattr(graph, "TASK_ROWS", 300)
    links = spark.range(1, 2000).selectExpr("id alias", "id div 3 target").unionByName(spark.range(5000, 5400).selectExpr("id alias", "7 target"))
    seen = []
    cut = graph.cut
    monkeypatch.setattr(graph, "cut", lambda df: seen.append(cut(df)) or seen[-1])
    got = graph.resolve_chains(links).collect()
    assert len(got) == 2399 and {r["target"] for r in got} == {0}
    assert min(df.rdd.getNumPartitions() for df in seen) >= 8


def test_labels_of_facts_are_found_in_one_pass(spark):
    facts = spark.createDataFrame([("a", "X", "ECOTYPE", "SRKW", 2), ("a", "X", "ECOTYPE", "TRANSIENT", 1), ("b", "G", "ECOTYPE", "SRKW", 1), ("b", "G", "ECOTYPE", "NRKW", 3), ("c", "X", "ECOTYPE", "SRKW", 1), ("c", "Y", "ECOTYPE", "NRKW", 1)], "record_id string, source string, kind string, value string, priority int")
    got = entity.classify(facts, "G")
    assert {r["record_id"]: r["detail"] for r in got.collect()} == {"a": "TRANSIENT", "b": "MIXED", "c": "MIXED"}
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
