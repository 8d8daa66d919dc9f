"""Evaluation designs, graphs, sinks and published-table checks bound to the tables."""

from __future__ import annotations

from datetime import date
from math import sqrt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldspark.functions.geo import haversine_km, polygon_covers
from fieldspark.functions.temporal import period_fields, week_start
from fieldspark.operators import counts as C
from fieldspark.operators import graph, imputation, research
from fieldspark.operators.lineage import workspace
from fieldspark.operators.quality import Contract
from fieldspark.plans.base import sightings, table, with_sightings
from fieldspark.plans.evaluation import SCORED, scored
from fieldspark.plans.registry import Registry
from fieldspark.plans.spatial import EDGES, REACH, _edges
from fieldspark.sources import readers, sinks

REGISTRY = Registry.new()
bind = REGISTRY.bind


# Evaluation designs


@bind(
    "m_09_cross_fitted_conformal",
    f"""WITH {SCORED}, r AS (SELECT id, id % 5 AS fold, CASE y WHEN 1 THEN 'a' ELSE 'b' END AS label, p FROM d), l AS (SELECT id, fold, label, 'a' AS class, 1 - p AS s FROM r UNION ALL SELECT id, fold, label, 'b', 1 - (1 - p) FROM r)
SELECT x.id, x.class, round((count(c.id) FILTER (c.s >= x.s) + 1) / (count(c.id) + 1), 9) AS p_value, (count(c.id) FILTER (c.s >= x.s) + 1) / (count(c.id) + 1) > 0.1 AS in_set
FROM l x LEFT JOIN l c ON c.class = x.class AND c.label = x.class AND c.fold <> x.fold GROUP BY x.id, x.class""",
)
def conformal(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scored(spark, sf_dir).select("id", (F.col("id") % 5).alias("fold"), F.when(F.col("y") == 1, "a").otherwise("b").alias("label"), F.col("p").alias("p_a"), (1 - F.col("p")).alias("p_b"))
    return research.cross_fitted_conformal(rows, ["a", "b"], 0.1).withColumn("p_value", F.round("p_value", 9))


@bind(
    "r_14_cross_fitted_propensities",
    f"""WITH {SCORED}, f AS (SELECT id, lang, id % 5 AS fold, y FROM d), r AS (SELECT x.id, (sum(o.y) FILTER (o.fold <> x.fold) + (SELECT avg(y) FROM f)) / (count(o.y) FILTER (o.fold <> x.fold) + 1) AS rate FROM f x JOIN f o ON o.lang IS NOT DISTINCT FROM x.lang GROUP BY x.id),
w AS (SELECT id, rate, 1 / greatest(0.05, rate) AS raw FROM r) SELECT id, round(rate, 9) AS rate, round(raw / avg(raw) OVER (), 9) AS weight FROM w""",
)
def propensities(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scored(spark, sf_dir).select("id", F.coalesce("lang", F.lit("")).alias("lang"), (F.col("id") % 5).alias("fold"), "y")
    rated = research.inverse_propensity(research.cross_fitted_rate(rows, "lang", "fold", "y"), "rate")
    return rated.select("id", F.round("rate", 9).alias("rate"), F.round("weight", 9).alias("weight"))


@bind(
    "r_12_rolling_origins",
    with_sightings("""SELECT split, role, count(*) AS n, min(sighting_date) AS first_day, max(sighting_date) AS last_day FROM (SELECT sighting_date, CAST(k AS INTEGER) AS split, CASE WHEN sighting_date < o THEN 'TRAIN' WHEN sighting_date < o + 5 THEN 'TEST' END AS role
 FROM s, (VALUES (0, DATE '2024-01-08'), (1, DATE '2024-01-15'), (2, DATE '2024-01-22')) v(k, o)) WHERE role IS NOT NULL GROUP BY ALL"""),
)
def origins(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = research.rolling_origins(sightings(spark, sf_dir).select("observation_id", "sighting_date"), "sighting_date", [date(2024, 1, 8), date(2024, 1, 15), date(2024, 1, 22)], 5)
    return split.groupBy("split", "role").agg(F.count(F.lit(1)).alias("n"), F.min("sighting_date").alias("first_day"), F.max("sighting_date").alias("last_day"))


@bind("r_18_source_held_out", with_sightings("SELECT source AS held_out, (SELECT count(*) FROM s) - count(*) AS train, count(*) AS test FROM s GROUP BY 1"))
def source_held_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    return research.held_out(sightings(spark, sf_dir), "source")


@bind("z_82_block_held_out", with_sightings("SELECT floor(lat)::BIGINT || ':' || floor(lon)::BIGINT AS held_out, (SELECT count(*) FROM s) - count(*) AS train, count(*) AS test FROM s GROUP BY 1"))
def block_held_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sightings(spark, sf_dir).select(F.concat_ws(":", F.floor("lat").cast("string"), F.floor("lon").cast("string")).alias("block"))
    return research.held_out(rows, "block")


@bind(
    "r_11_group_robust_weights",
    f"""WITH {SCORED}, g AS (SELECT source, sum(w * -(y * ln(greatest(1e-6, least(1 - 1e-6, p))) + (1 - y) * ln(1 - greatest(1e-6, least(1 - 1e-6, p))))) / sum(w) AS loss FROM d GROUP BY 1),
r AS (SELECT *, exp(0.35 * loss) / sum(exp(0.35 * loss)) OVER () AS q, count(*) OVER () AS k FROM g), f AS (SELECT source, loss, greatest(q, 0.01 / k) AS q FROM r)
SELECT source, round(loss, 6) AS loss, round(q / sum(q) OVER (), 9) AS q FROM f""",
)
def robust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return research.group_robust_step(scored(spark, sf_dir), "source", 0.35).select("source", F.round("loss", 6).alias("loss"), F.round("q", 9).alias("q"))


@bind("r_16_hierarchical_masses", f"WITH {SCORED} SELECT id, round(q * p, 9) AS a, round(q * (1 - p), 9) AS b, round(1 - q, 9) AS other FROM d")
def masses(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = research.hierarchical_masses(F.col("q"), F.col("p"), ("a", "b", "other"))
    return scored(spark, sf_dir).select("id", *[F.round(c, 9).alias(k) for k, c in m.items()])


@bind("r_03_direct_probability", with_sightings("SELECT user_id, round((sum((detail = 'SRKW')::INT) + 2 * 0.3) / (sum((detail IN ('SRKW', 'TRANSIENT'))::INT) + 2), 9) AS p FROM s GROUP BY 1"))
def direct(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = F.sum(F.when(F.col("detail") == "SRKW", 1).otherwise(0))
    both = F.sum(F.when(F.col("detail").isin("SRKW", "TRANSIENT"), 1).otherwise(0))
    return sightings(spark, sf_dir).groupBy("user_id").agg(F.round(imputation.direct_probability(own, both, 0.3, 2.0), 9).alias("p"))


BLEND = "SELECT {k} count(*) AS n, sum(w * (q - p) * (q - p)) / sum(w) AS dd, sum(w * (q - p) * (p - y)) / sum(w) AS de, sum(w * (p - y) * (p - y)) / sum(w) AS ee FROM d {g}"
TRIED = "SELECT {k} n, round(ee + 2 * (t / 20.0::DOUBLE) * de + (t / 20.0::DOUBLE) * (t / 20.0::DOUBLE) * dd, 12) AS brier, t / 20.0::DOUBLE AS weight FROM {b}, range(21) r(t)"


@bind("z_76_best_blend", f"WITH {SCORED}, b AS ({BLEND.format(k='lang,', g='GROUP BY lang')}), t AS ({TRIED.format(k='lang,', b='b')}) SELECT lang, n, weight, round(brier, 9) AS brier FROM t QUALIFY row_number() OVER (PARTITION BY lang ORDER BY brier, weight) = 1")
def blend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return research.best_blend(scored(spark, sf_dir), ["lang"]).withColumn("brier", F.round("brier", 9))


@bind(
    "r_06_shrunk_blend",
    f"""WITH {SCORED}, b AS ({BLEND.format(k='lang,', g='GROUP BY lang')}), t AS ({TRIED.format(k='lang,', b='b')}), l AS (SELECT lang, n, weight FROM t QUALIFY row_number() OVER (PARTITION BY lang ORDER BY brier, weight) = 1),
c AS ({BLEND.format(k='', g='')}), u AS ({TRIED.format(k='', b='c')}), o AS (SELECT weight AS overall FROM u ORDER BY brier, weight LIMIT 1)
SELECT lang, n, weight, round(CASE WHEN n >= 50 THEN least(overall, n / (n + 200.0::DOUBLE) * weight + (1 - n / (n + 200.0::DOUBLE)) * overall) ELSE 0 END, 9)::DOUBLE AS shrunk FROM l, o""",
)
def shrunk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scored(spark, sf_dir)
    local = research.best_blend(rows, ["lang"]).select("lang", "n", "weight")
    return research.shrunk_blend(local, research.best_blend(rows, []), 50).withColumn("shrunk", F.round("shrunk", 9))


@bind("z_43_usable_folds", with_sightings("SELECT CAST(least(10, min(n)) AS INTEGER) AS folds FROM (SELECT count(*) AS n FROM s WHERE value > 380 GROUP BY detail, source)"))
def usable(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sightings(spark, sf_dir).filter("value > 380").select(F.concat_ws(":", "detail", "source").alias("class"))
    return research.usable_folds(rows, "class", 10)


@bind("z_65_strongest_per_encounter", with_sightings("SELECT detail, round(sum(m), 6) AS support, count(*) AS encounters FROM (SELECT detail, user_id, max(value / 500.0) AS m FROM s GROUP BY ALL) GROUP BY 1"))
def strongest(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = sightings(spark, sf_dir).groupBy("detail", "user_id").agg(F.max(F.col("value") / 500.0).alias("m"))
    return units.groupBy("detail").agg(F.round(F.sum("m"), 6).alias("support"), F.count(F.lit(1)).alias("encounters"))


@bind(
    "z_86_metrics_under_two_weightings",
    f"WITH {SCORED} SELECT source, round(sum((p - y) * (p - y)) / count(*), 9) AS plain, round(sum((p - y) * (p - y) / greatest(0.05, q)) / sum(1 / greatest(0.05, q)), 9) AS reweighted FROM d GROUP BY 1",
)
def two_weightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    loss, w = (F.col("p") - F.col("y")) * (F.col("p") - F.col("y")), 1 / F.greatest(F.lit(0.05), F.col("q"))
    return scored(spark, sf_dir).groupBy("source").agg(F.round(F.avg(loss), 9).alias("plain"), F.round(F.sum(loss * w) / F.sum(w), 9).alias("reweighted"))


@bind("m_22_domain_support", with_sightings("SELECT observation_id, lat BETWEEN 47.5 AND 49 AND lon BETWEEN -124 AND -122 AS srkw, lat BETWEEN 47 AND 50 AND lon BETWEEN -125 AND -123 AS transient FROM s"))
def domain_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = lambda s, n, w, e: [[(s, w), (s, e), (n, e), (n, w)]]
    lat, lon = F.col("lat"), F.col("lon")
    return sightings(spark, sf_dir).select("observation_id", polygon_covers(lat, lon, box(47.5, 49, -124, -122)).alias("srkw"), polygon_covers(lat, lon, box(47, 50, -125, -123)).alias("transient"))


@bind("m_25_imputation_report", with_sightings("SELECT context_status, detail, count(*) AS rows, count(*) FILTER (imputation_applied) AS imputed, round(sum(expected_srkw), 6) AS srkw_mass, round(sum(expected_unknown), 6) AS unknown_mass FROM s GROUP BY ALL"))
def imputation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sightings(spark, sf_dir).groupBy("context_status", "detail").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("imputation_applied").alias("imputed"), F.round(F.sum("expected_srkw"), 6).alias("srkw_mass"), F.round(F.sum("expected_unknown"), 6).alias("unknown_mass")
    )


# Graphs and grids


@bind("g_03_bounded_routes", REACH + ", m AS (SELECT origin, node, min(distance) AS distance FROM r GROUP BY ALL), n AS (SELECT DISTINCT src AS node FROM e) SELECT a.node AS origin, b.node AS destination, m.distance FROM n a CROSS JOIN n b LEFT JOIN m ON m.origin = a.node AND m.node = b.node WHERE (a.node + b.node) % 3 = 0")
def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounded distances of asked pairs; a pair without a route has none."""
    edges = _edges(spark, sf_dir)
    nodes = edges.select(F.col("src").alias("node")).distinct()
    asked = nodes.select(F.col("node").alias("origin")).crossJoin(F.broadcast(nodes.select(F.col("node").alias("destination")))).filter("(origin + destination) % 3 = 0")  # a graph of 25 nodes
    return graph.routes(edges, asked, 6.0)


@bind("g_07_kernel_geometry", "SELECT r_regionkey, round((r_regionkey + 1) * sqrt(3), 9) AS step_km, CAST(greatest(1, ceil(20 / ((r_regionkey + 1) * sqrt(3)))) AS INTEGER) AS rings, round(20 * (1 - power(0.5, 1 / 2.0::DOUBLE)), 9) AS half_weight_km FROM region")
def geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distance between centres of hexagons by their edge, rings within a radius, and where a kernel has fallen by half."""
    step = (F.col("r_regionkey") + 1) * sqrt(3)
    return table(spark, sf_dir, "region").select("r_regionkey", F.round(step, 9).alias("step_km"), F.greatest(F.lit(1), F.ceil(20 / step)).cast("int").alias("rings"), F.round(F.lit(20 * (1 - 0.5 ** (1 / 2.0))), 9).alias("half_weight_km"))


@bind("g_09_sub_graph", f"WITH RECURSIVE {EDGES} SELECT src, dst, weight FROM e WHERE src % 2 = 0 AND dst % 2 = 0")
def sub_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = _edges(spark, sf_dir)
    return graph.sub_graph(edges, edges.filter("src % 2 = 0").select(F.col("src").alias("node")).distinct()).select("src", "dst", "weight")


@bind(
    "g_10_candidate_grid",
    with_sightings(""", c AS (SELECT DISTINCT lat, lon FROM s WHERE source = 0), g AS (SELECT 47 + r * 0.25::DOUBLE AS lat, -125 + q * 0.25::DOUBLE AS lon FROM range(13) a(r), range(17) b(q))
SELECT DISTINCT round(g.lat, 6) AS lat, round(g.lon, 6) AS lon FROM g JOIN c ON 2 * 6371.0088 * asin(least(1.0, sqrt(power(sin((radians(c.lat) - radians(g.lat)) / 2), 2) + cos(radians(g.lat)) * cos(radians(c.lat)) * power(sin((radians(c.lon) - radians(g.lon)) / 2), 2)))) <= 3"""),
)
def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cell centres of a box that lie within a radius of any context point, by the band join."""
    from fieldspark.operators.spatial_join import band_join

    day = F.lit("2024-01-01").cast("date")
    grid = spark.range(13 * 17).select((47 + F.floor(F.col("id") / 17) * 0.25).alias("l_lat"), (-125 + F.col("id") % 17 * 0.25).alias("l_lon"), day.alias("l_day"))
    points = sightings(spark, sf_dir).filter("source = 0").select(F.col("lat").alias("r_lat"), F.col("lon").alias("r_lon"), day.alias("r_day")).distinct()
    near = band_join(grid, points, radius_km=3, lag_days=0, how="left_semi")
    return near.select(F.round("l_lat", 6).alias("lat"), F.round("l_lon", 6).alias("lon"))


@bind("z_13_centre_distances", with_sightings("SELECT DISTINCT floor(lat)::BIGINT AS r, floor(lon)::BIGINT AS c, round(2 * 6371.0088 * asin(sqrt(power(sin((radians(48.5) - radians(floor(lat) + 0.5)) / 2), 2) + cos(radians(floor(lat) + 0.5)) * cos(radians(48.5)) * power(sin((radians(-123.5) - radians(floor(lon) + 0.5)) / 2), 2))), 6) AS km FROM s"))
def centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = sightings(spark, sf_dir).select(F.floor("lat").alias("r"), F.floor("lon").alias("c")).distinct()
    return cells.select("r", "c", F.round(haversine_km(F.col("r") + 0.5, F.col("c") + 0.5, F.lit(48.5), F.lit(-123.5)), 6).alias("km"))


@bind("z_11_period_columns", "SELECT DISTINCT CAST(date_trunc('week', ts) AS DATE) AS period_start, CAST(year(date_trunc('week', ts)) AS INTEGER) AS year, CAST(isoyear(date_trunc('week', ts)) AS INTEGER) AS iso_year, CAST(week(date_trunc('week', ts)) AS INTEGER) AS iso_week, CAST(date_trunc('week', ts) AS DATE) + 6 AS period_end FROM events")
def period_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    weeks = table(spark, sf_dir, "events").select(week_start(F.col("ts")).alias("period_start")).distinct()
    f = period_fields(F.col("period_start"), "weekly")
    return weeks.select("period_start", *[f[k].cast("int").alias(k) for k in ("year", "iso_year", "iso_week")], f["period_end"].alias("period_end"))


@bind("v_08_reporting_states", with_sightings(", d AS (SELECT CAST(t AS DATE) AS period_start FROM generate_series(DATE '2023-12-28', DATE '2024-02-02', INTERVAL 1 DAY) g(t)) SELECT period_start, count(observation_id) AS n, CASE WHEN count(observation_id) > 0 THEN 'REPORTED' WHEN period_start <= DATE '2024-01-31' THEN 'NO_REPORT' ELSE 'UNAVAILABLE' END AS state FROM d LEFT JOIN s USING (period_start) GROUP BY 1"))
def reporting_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = C.periods(spark, date(2023, 12, 28), date(2024, 2, 2), "daily", verified=True).select("period_start")
    filled = C.fill_calendar(sightings(spark, sf_dir).groupBy("period_start").agg(F.count(F.lit(1)).alias("n")), days, ["n"])
    return filled.withColumn("state", C.reporting_state(F.col("n"), F.col("period_start") <= F.lit(date(2024, 1, 31))))


# Readers and sinks: written to the shared folder and read again


def _contract() -> Contract:
    schema = T.StructType([T.StructField("o_orderkey", T.LongType(), False), T.StructField("o_totalprice", T.DoubleType(), True), T.StructField("status", T.StringType(), False)])
    return Contract(schema, ("o_orderkey",), (("price", F.col("o_totalprice") >= 0),))


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.col("o_orderstatus").alias("status"))


@bind("k_01_validated_write", "SELECT o_orderkey, o_totalprice, o_orderstatus AS status FROM orders")
def validated_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.write_validated(_orders(spark, sf_dir), workspace(spark, "orders"), _contract())


@bind("k_02_idempotent_append", "SELECT 'first' AS write, (SELECT count(*) FROM orders WHERE o_orderkey % 3 <> 0) AS added UNION ALL SELECT 'all', (SELECT count(*) FROM orders WHERE o_orderkey % 3 = 0) UNION ALL SELECT 'replay', 0")
def idempotent_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appends of a part, of all rows, and of all again: only new keys are added."""
    path, rows = workspace(spark, "state"), _orders(spark, sf_dir)
    added = [("first", sinks.append_new(rows.filter("o_orderkey % 3 <> 0"), path, ["o_orderkey"])), ("all", sinks.append_new(rows, path, ["o_orderkey"])), ("replay", sinks.append_new(rows, path, ["o_orderkey"]))]
    return spark.createDataFrame(added, "write string, added long")


@bind("k_04_partitioned_write", "SELECT o_orderkey, o_totalprice, o_orderstatus AS status FROM orders")
def partitioned_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partition columns stay in the files as well as in the folders' names."""
    path = workspace(spark, "partitioned")
    sinks.write_validated(_orders(spark, sf_dir), path, _contract(), ["status"])
    return readers.read_table(spark, path).select("o_orderkey", "o_totalprice", "status")


@bind("k_05_partition_manifest", "SELECT o_orderstatus AS status, count(*) AS rows, count(DISTINCT o_custkey) AS cells, min(o_orderdate)::DATE AS first_period, max(o_orderdate)::DATE AS last_period FROM orders GROUP BY 1")
def partition_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each partition of a written table holds, from its files."""
    path = workspace(spark, "manifest")
    rows = table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("day"), F.col("o_orderstatus").alias("status"))
    rows.withColumn("_status", F.col("status")).repartition("status").write.partitionBy("_status").parquet(path)
    report = sinks.partition_report(spark, path, "o_custkey", "day")
    named = report.withColumn("status", F.regexp_extract("file", "_status=([^/]*)/", 1))
    return named.groupBy("status").agg(F.sum("rows").alias("rows"), F.sum("cells").alias("cells"), F.min("first_period").alias("first_period"), F.max("last_period").alias("last_period"))


@bind("k_03_unchanged_artifacts", "SELECT 'same' AS candidate, true AS reused UNION ALL SELECT 'reordered', true UNION ALL SELECT 'changed', false")
def unchanged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An artifact of equal content is referred to instead of written again, whatever the order of its rows."""
    rows = _orders(spark, sf_dir)
    known = sinks.content_hash(rows)
    tried = {"same": rows, "reordered": rows.orderBy(F.desc("o_orderkey")), "changed": rows.withColumn("o_totalprice", F.col("o_totalprice") + 1)}
    return spark.createDataFrame([(k, sinks.content_hash(v) == known) for k, v in tried.items()], "candidate string, reused boolean")


@bind("k_08_prediction_files", f"WITH {SCORED} SELECT CAST(id AS VARCHAR) AS id, CAST(y AS VARCHAR) AS y, coalesce(lang, '') AS lang FROM d")
def prediction_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions written as CSV and read back as text."""
    path = workspace(spark, "predictions") + ".csv"
    scored(spark, sf_dir).select("id", "y", "lang").write.option("header", True).csv(path)
    return readers.read_table(spark, path)


@bind("s_14_text_csv", "SELECT CAST(n_nationkey AS VARCHAR) AS n_key, n_name AS name, CASE WHEN n_regionkey = 2 THEN '' ELSE CAST(n_regionkey AS VARCHAR) END AS region FROM nation")
def text_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns as text under lower-case names, blanks as empty text."""
    path = workspace(spark, "nation")
    rows = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias(" N_Key"), F.col("n_name").alias("NAME"), F.when(F.col("n_regionkey") != 2, F.col("n_regionkey")).alias("Region"))
    rows.write.option("header", True).csv(path)
    return readers.read_text_csv(spark, path)


@bind("s_16_table_reader", "SELECT n_nationkey, n_name FROM nation")
def table_reader(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark, "nation") + ".jsonl"
    table(spark, sf_dir, "nation").select("n_nationkey", "n_name").write.json(path)
    return readers.read_table(spark, path).select(F.col("n_nationkey").cast("int").alias("n_nationkey"), "n_name")


@bind("s_17_count_files", with_sightings("SELECT sighting_date, count(*) AS n FROM s GROUP BY 1"))
def count_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts in many files as one table; folders' names are not read as columns."""
    path = workspace(spark, "counts")
    counted = sightings(spark, sf_dir).groupBy("sighting_date").agg(F.count(F.lit(1)).alias("n"))
    counted.withColumn("part", F.dayofmonth("sighting_date") % 3).write.partitionBy("part").parquet(path)
    return readers.read_table(spark, path).select("sighting_date", "n")


@bind("s_01_paged_api", "SELECT n_nationkey::BIGINT AS id, n_name AS name FROM nation")
def paged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of a service in order of id, landed as JSON lines; the service is an injected function."""
    records = [{"id": int(r["n_nationkey"]), "name": r["n_name"]} for r in table(spark, sf_dir, "nation").orderBy("n_nationkey").collect()]

    def fetch(params: dict) -> dict:
        rest = [r for r in records if r["id"] >= params["id_above"] + bool(params["id_above"])]
        return {"total_results": len(rest), "results": rest[: params["per_page"]]}

    landed = readers.PagedApi(fetch, page_size=7).land(spark, {}, workspace(spark, "pages"))
    return landed.select(F.get_json_object("payload", "$.id").cast("long").alias("id"), F.get_json_object("payload", "$.name").alias("name"))


@bind("v_02_file_contract", "SELECT 'null o_orderkey' AS \"check\", 0 AS rows UNION ALL SELECT 'null status', 0 UNION ALL SELECT 'rule price', 0 UNION ALL SELECT 'rows', count(*) FROM orders UNION ALL SELECT 'repeated key', 0")
def file_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract of a table that lies in many files: one schema for all, keys from a projection."""
    from fieldspark.operators.quality import violations

    path = workspace(spark, "contract")
    _orders(spark, sf_dir).repartition(6).write.parquet(path)
    return violations(spark.read.option("mergeSchema", False).parquet(path), _contract())


@bind("v_16_retention_decisions", "SELECT n_nationkey, CASE WHEN n_nationkey = 0 THEN 'KEEP_NO_BASELINE' WHEN n_nationkey < 3 THEN 'KEEP_EMPTY_BASELINE' WHEN n_nationkey < 100 AND 100 + n_nationkey - 10 < 100 THEN 'KEEP_SHRUNK' WHEN n_nationkey - 10 <= 10 THEN 'PRUNE' ELSE 'KEEP_GREW_TOO_MUCH' END AS decision FROM nation")
def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [r["n_nationkey"] for r in table(spark, sf_dir, "nation").collect()]
    before = lambda k: None if k == 0 else 0 if k < 3 else 100
    return spark.createDataFrame([(k, sinks.retention(before(k), 100 + k - 10)) for k in rows], "n_nationkey int, decision string")


@bind("h_15_semantic_hashes", "SELECT 'retrieved later' AS candidate, true AS equal UNION ALL SELECT 'another row', false")
def semantic_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content is compared without when it was retrieved, and without order."""
    rows = _orders(spark, sf_dir).withColumn("retrieved_at", F.lit("2024-01-01"))
    known = sinks.content_hash(rows, exclude=("retrieved_at",))
    tried = {"retrieved later": rows.withColumn("retrieved_at", F.lit("2024-02-01")), "another row": rows.union(rows.limit(1))}
    return spark.createDataFrame([(k, sinks.content_hash(v, exclude=("retrieved_at",)) == known) for k, v in tried.items()], "candidate string, equal boolean")
