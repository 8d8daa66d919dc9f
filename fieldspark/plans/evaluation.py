"""Metrics, validation, cleaning and set operations bound to the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldspark.functions import text as X
from fieldspark.functions.policies import ObservationPolicy
from fieldspark.functions.stats import entropy, logit, ring_weight, wilson_upper
from fieldspark.functions.temporal import first_date
from fieldspark.operators import entity, metrics, quality
from fieldspark.plans.base import sightings, table, with_sightings
from fieldspark.plans.registry import Registry

REGISTRY = Registry.new()
bind = REGISTRY.bind


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with a made-up score, weight and strata."""
    d = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars"), "doc_id")
    p = (F.col("n_chars") % 1000) / 1000.0
    return d.select(F.col("doc_id").alias("id"), "lang", "source", F.col("quality").cast("int").alias("y"), p.alias("p"), (1.0 + F.col("doc_id") % 3).alias("w"), ((F.col("doc_id") * 7919 % 1000) / 1000.0).alias("q"))


SCORED = """d AS (SELECT doc_id AS id, lang, source, CAST(quality AS INTEGER) AS y, (n_chars % 1000) / CAST(1000.0 AS DOUBLE) AS p, CAST(1.0 + doc_id % 3 AS DOUBLE) AS w, (doc_id * 7919 % 1000) / CAST(1000.0 AS DOUBLE) AS q
  FROM labels JOIN documents USING (doc_id))"""
R = lambda c, n=9: F.round(c, n).alias(c)

SUMMARY = """a AS (SELECT {k} count(*) AS n, sum(w * y) / sum(w) AS prevalence, sum(w * -(y * ln(greatest(1e-15, least(1 - 1e-15, p))) + (1 - y) * ln(1 - greatest(1e-15, least(1 - 1e-15, p))))) / sum(w) AS log_loss,
  sum(w * (p - y) * (p - y)) / sum(w) AS brier, sum(CASE WHEN p >= 0.5 AND y = 1 THEN w ELSE 0 END) AS tp, sum(CASE WHEN p >= 0.5 AND y = 0 THEN w ELSE 0 END) AS fp,
  sum(CASE WHEN p < 0.5 AND y = 1 THEN w ELSE 0 END) AS fn, sum(CASE WHEN p < 0.5 AND y = 0 THEN w ELSE 0 END) AS tn FROM d {g})"""
SUMMARY_SELECT = "n, round(prevalence, 9) AS prevalence, round(log_loss, 6) AS log_loss, round(brier, 9) AS brier, tp, fp, fn, tn, round((tp + tn) / (tp + fp + fn + tn), 9) AS accuracy, round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 9) AS precision, round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 9) AS recall"


def _summary(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*keys, "n", R("prevalence"), R("log_loss", 6), R("brier"), "tp", "fp", "fn", "tn", R("accuracy"), R("precision"), R("recall"))


@bind("a_29_metric_bundle", f"WITH {SCORED}, {SUMMARY.format(k='', g='')} SELECT {SUMMARY_SELECT} FROM a")
def bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary(metrics.summary(scored(spark, sf_dir)), [])


@bind("a_30_metrics_by_regime", f"WITH {SCORED}, {SUMMARY.format(k='lang,', g='GROUP BY lang')} SELECT lang, {SUMMARY_SELECT} FROM a")
def regimes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary(metrics.summary(scored(spark, sf_dir), ["lang"]), ["lang"])


@bind("a_29_auc", f"WITH {SCORED} SELECT a.lang, round(avg(CASE WHEN a.p > b.p THEN 1.0 WHEN a.p = b.p THEN 0.5 ELSE 0.0 END), 9) AS auc FROM d a JOIN d b ON a.lang = b.lang WHERE a.y = 1 AND b.y = 0 GROUP BY 1")
def auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.auc(scored(spark, sf_dir), ["lang"]).filter("auc is not null").select("lang", R("auc"))


@bind(
    "a_29_average_precision",
    f"""WITH {SCORED}, b AS (SELECT lang, p, sum(y) AS pos, count(*) AS n FROM d GROUP BY ALL), c AS (SELECT lang, pos, sum(pos) OVER k AS tp, sum(n) OVER k AS seen FROM b WINDOW k AS (PARTITION BY lang ORDER BY p DESC))
SELECT lang, round(sum(pos * tp / seen) / sum(pos), 9) AS average_precision FROM c GROUP BY 1""",
)
def ap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.average_precision(scored(spark, sf_dir), ["lang"]).select("lang", R("average_precision"))


BINS = "greatest(0, least(9, CAST(ceil(p * 10) AS INTEGER) - 1))"


@bind("a_25_reliability_bins", f"WITH {SCORED} SELECT {BINS} AS bin, count(*) AS n, round(avg(p), 9) AS confidence, round(avg(y), 9) AS frequency FROM d GROUP BY 1")
def reliability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.reliability(scored(spark, sf_dir)).select("bin", "n", R("confidence"), R("frequency"))


@bind("z_25_calibration_error", f"WITH {SCORED}, b AS (SELECT {BINS} AS bin, count(*) AS n, avg(p) AS c, avg(y) AS f FROM d GROUP BY 1) SELECT round(sum(n * abs(c - f)) / sum(n), 9) AS ece FROM b")
def ece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.calibration_error(scored(spark, sf_dir)).select(R("ece"))


@bind("a_26_equal_mass_error", f"WITH {SCORED}, t AS (SELECT *, ntile(10) OVER (ORDER BY p, id) AS bin FROM d), b AS (SELECT bin, sum(w) AS w, sum(w * p) / sum(w) AS c, sum(w * y) / sum(w) AS f FROM t GROUP BY 1) SELECT round(sum(w * abs(c - f)) / sum(w), 9) AS equal_mass_ece FROM b")
def equal_mass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.equal_mass_error(scored(spark, sf_dir), "id").select(R("equal_mass_ece"))


STEPS = [i / 20 for i in range(10, 20)]
WILSON = "least(1.0, ({e} / {n}::DOUBLE + 3.8414588206941236 / (2 * {n}) + 1.9599639845400536 * sqrt({e} / {n}::DOUBLE * (1 - {e} / {n}::DOUBLE) / {n} + 3.8414588206941236 / (4.0 * {n} * {n}))) / (1 + 3.8414588206941236 / {n}))"


@bind(
    "a_27_risk_coverage",
    f"""WITH {SCORED}, t AS (SELECT unnest([{', '.join(map(str, STEPS))}])::DOUBLE AS threshold), c AS (SELECT threshold, count(id) AS accepted, coalesce(sum(CASE WHEN (p >= 0.5)::INTEGER <> y THEN 1 ELSE 0 END) FILTER (WHERE id IS NOT NULL), 0)::BIGINT AS errors
  FROM t LEFT JOIN d ON greatest(p, 1 - p) >= threshold GROUP BY 1)
SELECT threshold, accepted, errors, round(accepted / (SELECT count(*) FROM d), 9) AS coverage, round(CASE WHEN accepted > 0 THEN errors / accepted END, 9) AS risk, round(CASE WHEN accepted > 0 THEN {WILSON.format(e='errors', n='accepted')} ELSE 1.0 END, 9) AS upper FROM c""",
)
def risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.risk_coverage(scored(spark, sf_dir), STEPS).select("threshold", "accepted", "errors", R("coverage"), R("risk"), R("upper"))


@bind("a_28_wilson_bounds", f"WITH {SCORED}, c AS (SELECT source, count(*) AS n, sum(1 - y)::BIGINT AS e FROM d GROUP BY 1) SELECT source, n, e AS errors, round({WILSON.format(e='e', n='n')}, 9) AS upper FROM c")
def wilson(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = scored(spark, sf_dir).groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum(1 - F.col("y")).alias("errors"))
    return by.withColumn("upper", F.round(wilson_upper(F.col("errors"), F.col("n")), 9))


@bind(
    "a_24_grouping_sets",
    f"""WITH {SCORED} SELECT concat_ws('+', CASE WHEN grouping(lang) = 0 THEN 'lang' END, CASE WHEN grouping(source) = 0 THEN 'source' END) AS dimensions, lang, source, count(*) AS n, round(avg(y), 9) AS prevalence, round(avg((p - y) * (p - y)), 9) AS brier
FROM d GROUP BY GROUPING SETS ((lang), (source), (lang, source))""",
)
def grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.stratified(scored(spark, sf_dir), [["lang"], ["source"], ["lang", "source"]]).select("dimensions", "lang", "source", "n", R("prevalence"), R("brier"))


@bind(
    "a_31_poststratification",
    f"WITH {SCORED}, s AS (SELECT lang, count(*) AS s FROM d GROUP BY 1), r AS (SELECT lang, count(*) AS r FROM documents GROUP BY 1), b AS (SELECT * FROM s JOIN r USING (lang)) SELECT lang, round((r / (SELECT sum(r) FROM b)) / (s / (SELECT sum(s) FROM b)), 9) AS weight FROM b",
)
def poststratified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.poststratification(scored(spark, sf_dir), table(spark, sf_dir, "documents"), ["lang"]).select("lang", R("weight"))


@bind("a_32_robust_weights", f"WITH {SCORED}, b AS (SELECT lang, sum(w) AS total FROM d GROUP BY 1) SELECT lang, round(greatest(0.25, least(4.0, (SELECT exp(avg(ln(total))) FROM b) / total)), 9) AS factor FROM b")
def robust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.robust_weights(scored(spark, sf_dir), "lang").select("lang", R("factor"))


@bind("a_33_review_priority", f"WITH {SCORED} SELECT id, lang, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY abs(p - 0.5), id) AS rank FROM d) WHERE rank <= 20")
def review(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.review_priority(scored(spark, sf_dir), "lang", 20).select("id", "lang", "rank")


@bind(
    "a_34_model_gates",
    f"""WITH {SCORED}, m AS (SELECT lang, 'base' AS model, count(*) AS n, avg((p - y) * (p - y)) AS brier FROM d GROUP BY 1 UNION ALL SELECT lang, 'other', count(*), avg((q - y) * (q - y)) FROM d GROUP BY 1)
SELECT o.model, count(*) AS strata, sum(CASE WHEN o.brier > b.brier THEN 1 ELSE 0 END)::BIGINT AS failed, round(max(o.brier - b.brier), 9) AS largest FROM m o JOIN m b ON o.lang = b.lang AND b.model = 'base' WHERE o.model <> 'base' AND o.n >= 5 GROUP BY 1""",
)
def gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scored(spark, sf_dir)
    loss = lambda c, m: rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.avg((F.col(c) - F.col("y")) * (F.col(c) - F.col("y"))).alias("brier")).withColumn("model", F.lit(m))
    return metrics.gate(loss("p", "base").unionByName(loss("q", "other")), ["lang"], "model", "base", 5).select("model", "strata", "failed", R("largest"))


@bind(
    "r_04_constrained_blend",
    f"""WITH {SCORED}, g AS (SELECT i / CAST(20 AS DOUBLE) AS share FROM range(21) t(i)), b AS (SELECT share, lang, count(*) AS n, sum(power(p * (1 - share) + q * share - y, 2)) AS l, sum(power(p - y, 2)) AS l0 FROM d CROSS JOIN g GROUP BY ALL)
SELECT share, round(sum(l) / sum(n), 9) AS brier, round(max((l - l0) / n), 9) AS worst FROM b GROUP BY 1""",
)
def blend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.blend_search(scored(spark, sf_dir), "p", "q", "lang", 0.01).select("share", R("brier"), R("worst"))


@bind(
    "m_08_conformal_p_values",
    f"""WITH {SCORED}, c AS (SELECT y AS label, p AS score FROM d WHERE id % 2 = 0), q AS (SELECT id, y AS label, p AS score FROM d WHERE id % 2 = 1)
SELECT q.id, q.label, round((count(c.score) FILTER (WHERE c.score >= q.score) + 1) / (count(c.score) + 1), 9) AS p_value FROM q JOIN c USING (label) GROUP BY q.id, q.label, q.score""",
)
def conformal(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scored(spark, sf_dir).select("id", F.col("y").alias("label"), F.col("p").alias("score"))
    return metrics.conformal_p_values(rows.filter("id % 2 = 0"), rows.filter("id % 2 = 1")).select("id", "label", R("p_value"))


@bind("r_15_propensity_weights", f"WITH {SCORED}, x AS (SELECT id, 1 / greatest(q, 0.05) AS w FROM d) SELECT id, round(w / (SELECT avg(w) FROM x), 9) AS weight FROM x")
def propensity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scored(spark, sf_dir).select("id", metrics.inverse_propensity(F.col("q")).alias("w"))
    return rows.join(F.broadcast(rows.agg(F.avg("w").alias("mean")))).select("id", F.round(F.col("w") / F.col("mean"), 9).alias("weight"))


@bind("m_07_logits", f"WITH {SCORED} SELECT id, round(ln(greatest(1e-6, least(1 - 1e-6, p)) / (1 - greatest(1e-6, least(1 - 1e-6, p)))), 6) AS z FROM d")
def logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir).select("id", F.round(logit(F.col("p")), 6).alias("z"))


@bind(
    "a_17_label_entropy",
    with_sightings(", c AS (SELECT source, detail, count(*) AS n FROM s GROUP BY ALL), t AS (SELECT source, sum(n) AS total FROM c GROUP BY 1) SELECT source, round(-sum(n / total * ln(n / total)), 9) AS entropy FROM c JOIN t USING (source) GROUP BY 1"),
)
def label_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = ["UNKNOWN", "SRKW", "TRANSIENT", "OFFSHORE", "MIXED"]
    wide = sightings(spark, sf_dir).groupBy("source").pivot("detail", labels).count().fillna(0)
    total = sum((F.col(x) for x in labels), F.lit(0))
    return wide.select("source", F.round(entropy([F.col(x) / total for x in labels]), 9).alias("entropy"))


@bind("g_05_ring_weights", "SELECT CAST(i AS INTEGER) AS ring, round(0.2 + 0.8 * power(1 - i / CAST(5 AS DOUBLE), 1.5), 6) AS weight FROM range(6) t(i)")
def rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.range(6).select(F.col("id").cast("int").alias("ring"), ring_weight(F.col("id"), 5, first=1.0, last=0.2, exponent=1.5).alias("weight"))


CONTRACT = quality.Contract(
    T.StructType([T.StructField("o_orderkey", T.LongType(), False), T.StructField("o_custkey", T.LongType(), False), T.StructField("o_totalprice", T.DoubleType(), False)]),
    ("o_custkey", "o_totalprice"),
    (),
)


@bind(
    "v_01_contract_violations",
    """SELECT 'null o_orderkey' AS "check", count(*) FILTER (WHERE o_orderkey IS NULL) AS rows FROM orders UNION ALL SELECT 'null o_custkey', count(*) FILTER (WHERE o_custkey IS NULL) FROM orders UNION ALL SELECT 'null o_totalprice', count(*) FILTER (WHERE o_totalprice IS NULL) FROM orders
UNION ALL SELECT 'rule small', count(*) FILTER (WHERE o_totalprice > 400000) FROM orders UNION ALL SELECT 'rows', count(*) FROM orders
UNION ALL SELECT 'repeated key', coalesce(sum(n), 0)::BIGINT FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 1)""",
)
def contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = quality.Contract(CONTRACT.schema, ("o_custkey",), (("small", F.col("o_totalprice") <= 400000),))
    return quality.violations(table(spark, sf_dir, "orders"), c)


@bind("v_17_table_identity", "SELECT count(*) AS rows, count(DISTINCT o_orderkey) AS ids, min(o_orderdate::DATE) AS first_day, max(o_orderdate::DATE) AS last_day FROM orders")
def identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    return quality.table_identity(o, "o_orderkey", "day")


@bind(
    "a_19_null_rates",
    "SELECT 'lang' AS \"column\", count(*) - count(lang) AS nulls, round((count(*) - count(lang)) / count(*), 9) AS rate FROM documents UNION ALL SELECT 'toxic', count(*) - count(toxic), round((count(*) - count(toxic)) / count(*), 9) FROM documents LEFT JOIN labels USING (doc_id)",
)
def nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels").select("doc_id", "toxic"), "doc_id", "left")
    return quality.null_rates(d, ["lang", "toxic"]).withColumn("rate", F.round("rate", 9))


@bind(
    "c_16_first_failing_gate",
    with_sightings("""SELECT CASE WHEN source = 5 THEN 'QUARANTINED' WHEN detail = 'OFFSHORE' THEN 'NOT_ACCEPTED' WHEN sighting_date < DATE '2024-01-03' THEN 'BEFORE_MIN_DATE' WHEN lat > 49.5 THEN 'OUTSIDE_AREA' ELSE 'ACCEPTED' END AS outcome, count(*) AS rows FROM s GROUP BY 1"""),
)
def gate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted, rejected = quality.split_by_gates(
        sightings(spark, sf_dir),
        [("QUARANTINED", F.col("source") != 5), ("NOT_ACCEPTED", F.col("detail") != "OFFSHORE"), ("BEFORE_MIN_DATE", F.col("sighting_date") >= F.lit("2024-01-03").cast("date")), ("OUTSIDE_AREA", F.col("lat") <= 49.5)],
    )
    return accepted.withColumn("reject_reason", F.lit("ACCEPTED")).unionByName(rejected).groupBy(F.col("reject_reason").alias("outcome")).agg(F.count(F.lit(1)).alias("rows"))


@bind("u_07_uncovered_keys", "SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def uncovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.uncovered(table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents"), "doc_id")


@bind("u_01_relaxed_union", "SELECT doc_id AS id, quality::BIGINT AS v FROM labels UNION ALL SELECT event_id, user_id FROM events")
def relaxed(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.col("quality").cast("long").alias("v"))
    return a.unionByName(table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("user_id").alias("v")))


@bind("u_03_distinct", "SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus").distinct()


@bind("u_04_keyed_distinct_last", "SELECT o_custkey, o_orderpriority, max(o_orderkey) AS o_orderkey FROM orders GROUP BY ALL")
def keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entity.representative(table(spark, sf_dir, "orders"), ["o_custkey", "o_orderpriority"], [F.desc("o_orderkey")]).select("o_custkey", "o_orderpriority", "o_orderkey")


@bind("u_05_domain_union", "SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F' UNION SELECT c_custkey FROM customer WHERE c_nationkey = 3")
def domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k"))
    return a.union(table(spark, sf_dir, "customer").filter("c_nationkey = 3").select("c_custkey")).distinct()


@bind("u_06_intersection", "SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O'")
def intersection(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k")).intersect(o.filter("o_orderstatus = 'O'").select(F.col("o_custkey").alias("k")))


@bind("j_01_inner_fan_out", "SELECT o_orderkey, l_partkey FROM orders JOIN (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) ON o_orderkey = l_orderkey WHERE o_totalprice > 300000")
def fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey").distinct()
    return table(spark, sf_dir, "orders").filter("o_totalprice > 300000").select("o_orderkey").join(parts, "o_orderkey")


@bind("j_16_lookup", "SELECT o_orderkey, coalesce(n_name, 'UNKNOWN') AS nation FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0 LEFT JOIN nation ON c_nationkey = n_nationkey")
def lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"))
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(c, "o_custkey", "left").join(n, "n_nationkey", "left").select("o_orderkey", F.coalesce("n_name", F.lit("UNKNOWN")).alias("nation"))


@bind(
    "j_19_covariates_with_flags",
    with_sightings(", c AS (SELECT n_nationkey AS cell, n_regionkey * 1.5::DOUBLE AS depth FROM nation WHERE n_nationkey % 3 <> 0) SELECT observation_id, depth, CASE WHEN depth IS NULL THEN 1.0 ELSE 0.0 END::DOUBLE AS depth_missing FROM s LEFT JOIN c ON observation_id % 25 = cell"),
)
def covariates(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "nation").filter("n_nationkey % 3 <> 0").select(F.col("n_nationkey").cast("long").alias("cell"), (F.col("n_regionkey") * F.lit(1.5)).alias("depth"))
    obs = sightings(spark, sf_dir).select("observation_id", (F.col("observation_id") % 25).alias("cell"))
    return obs.join(c, "cell", "left").select("observation_id", "depth", F.col("depth").isNull().cast("double").alias("depth_missing"))


@bind("o_03_mixed_order_top", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50")
def mixed_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(50).select("o_orderkey", "o_totalprice")


@bind("w_09_rank_in_stratum", with_sightings("SELECT observation_id, CAST(row_number() OVER (PARTITION BY detail ORDER BY value DESC, observation_id) AS INTEGER) AS rank FROM s"))
def ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sightings(spark, sf_dir).select("observation_id", F.row_number().over(Window.partitionBy("detail").orderBy(F.desc("value"), "observation_id")).alias("rank"))


@bind(
    "c_01_first_present",
    """WITH r AS (SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'NaN' WHEN 1 THEN '  ' WHEN 2 THEN ' n/a' WHEN 3 THEN NULL WHEN 4 THEN ' x ' ELSE event_type END AS a FROM events)
SELECT event_id, CASE WHEN a IS NOT NULL AND trim(a) <> '' AND lower(trim(a)) NOT IN ('nan', 'na', 'n/a', 'none', 'null') THEN a ELSE 'fallback' END AS first, CASE WHEN a IS NOT NULL AND trim(a) <> '' AND lower(trim(a)) NOT IN ('nan', 'na', 'n/a', 'none', 'null') THEN trim(a) END AS text FROM r""",
)
def first_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id") % 6
    a = F.when(k == 0, "NaN").when(k == 1, "  ").when(k == 2, " n/a").when(k == 3, F.lit(None)).when(k == 4, " x ").otherwise(F.col("event_type"))
    return table(spark, sf_dir, "events").select("event_id", X.first_present(a, F.lit("fallback")).alias("first"), X.source_text(a).alias("text"))


@bind("c_03_record_ids", "SELECT event_id, 'EVENTS:' || CASE WHEN event_id % 4 = 0 THEN 'sha256:' || substr(sha256(props), 1, 24) ELSE event_id::VARCHAR END AS record_id FROM events")
def record_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    native = F.when(F.col("event_id") % 4 != 0, F.col("event_id").cast("string"))
    return table(spark, sf_dir, "events").select("event_id", X.record_id(F.lit("events"), native, F.col("props")).alias("record_id"))


@bind("c_08_indicator_tokens", "SELECT event_id, nullif(concat_ws('; ', CASE WHEN event_id % 2 = 0 THEN 'J pod' END, CASE WHEN event_id % 3 = 0 THEN 'K pod' END), '') AS tokens FROM events")
def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = lambda n: F.when(F.col("event_id") % n == 0, " Yes").otherwise("0")
    return table(spark, sf_dir, "events").select("event_id", X.indicator_tokens({"J pod": flag(2), "K pod": flag(3)}).alias("tokens"))


@bind("c_10_first_date", "SELECT o_orderkey, o_orderdate::DATE AS d FROM orders")
def dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey") % 3
    raw = F.when(k == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).when(k == 1, F.date_format("o_orderdate", "MM/dd/yyyy")).otherwise(F.date_format("o_orderdate", "d MMM yyyy"))
    return table(spark, sf_dir, "orders").select("o_orderkey", first_date(raw, ["yyyy-MM-dd", "MM/dd/yyyy", "d MMM yyyy"]).alias("d"))


@bind("c_12_has_clock", "SELECT event_id, event_id % 2 = 0 AS clock FROM events")
def clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.when(F.col("event_id") % 2 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).otherwise(F.date_format("ts", "yyyy-MM-dd"))
    return table(spark, sf_dir, "events").select("event_id", X.has_clock(raw).alias("clock"))


@bind(
    "c_28_html_text_length",
    r"""WITH p AS (SELECT page_id, regexp_replace(regexp_replace(html, '(?i)<br\s*/?>|</p>', chr(10), 'g'), '<[^>]*>', '', 'g') AS t FROM pages),
e AS (SELECT page_id, replace(replace(replace(replace(replace(replace(t, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&amp;', '&') AS t FROM p),
l AS (SELECT page_id, list_filter(list_transform(string_split(t, chr(10)), lambda x: trim(x)), lambda x: x <> '') AS lines FROM e)
SELECT page_id, CAST(len(lines) AS INTEGER) AS lines, CAST(length(array_to_string(lines, chr(10))) AS INTEGER) AS chars FROM l""",
)
def html(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = X.html_lines(F.col("html"))
    return table(spark, sf_dir, "pages").select("page_id", F.size(lines).alias("lines"), F.length(F.array_join(lines, "\n")).alias("chars"))


@bind("c_36_strict_integers", "SELECT p_partkey, CASE WHEN p_partkey % 3 <> 0 AND p_size BETWEEN 5 AND 40 THEN p_size::BIGINT END AS v FROM part")
def integers(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.col("p_size").cast("string"), F.lit(".5"))).otherwise(F.concat(F.lit(" "), F.col("p_size").cast("string"), F.lit(".0")))
    return table(spark, sf_dir, "part").select("p_partkey", X.strict_int(raw, 5, 40).alias("v"))


@bind("c_37_comparison_identifiers", "SELECT s_suppkey, 'J' || s_suppkey::VARCHAR || 'A' AS identifier FROM supplier")
def identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.format_string("j-%05d a", F.col("s_suppkey"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", X.comparison_identifier(raw).alias("identifier"))


@bind("c_26_coordinate_text", with_sightings("SELECT observation_id, round(lat, 6) AS lat, round(lon, 6) AS lon FROM s WHERE observation_id % 2 = 0 UNION ALL SELECT observation_id, round(lat, 6), round(lon, 6) FROM s WHERE observation_id % 2 = 1"))
def coordinate_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = lambda c, h: F.when(F.col("observation_id") % 2 == 0, F.concat(F.floor(F.abs(c)).cast("string"), F.lit(" "), F.round((F.abs(c) - F.floor(F.abs(c))) * 60, 6).cast("string"), F.lit(h))).otherwise(F.abs(c).cast("string"))
    rows = sightings(spark, sf_dir).select("observation_id", text(F.col("lat"), "' N").alias("a"), text(F.col("lon"), "' W").alias("b"))
    return rows.select("observation_id", F.round(X.coordinate_component(F.col("a"), "lat"), 6).alias("lat"), F.round(X.coordinate_component(F.col("b"), "lon"), 6).alias("lon"))


def notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    text = F.concat_ws(" ", F.when(k % 3 == 0, "seen southern residents"), F.when(k % 5 == 0, F.concat(F.lit("with J"), (k % 40).cast("string"))), F.when(k % 7 == 0, "not transients"), F.when(k % 11 == 0, "offshore group"), F.when(k % 13 == 0, "T65A nearby"))
    return table(spark, sf_dir, "events").select(k.alias("record_id"), (F.col("user_id") % 6).cast("string").alias("source"), text.alias("description"))


NOTES = """f AS (SELECT event_id AS record_id, 'SRKW' AS value, 3 AS priority FROM events WHERE event_id % 3 = 0 UNION ALL SELECT event_id, 'OFFSHORE', 3 FROM events WHERE event_id % 11 = 0
  UNION ALL SELECT event_id, 'SRKW', 2 FROM events WHERE event_id % 5 = 0 UNION ALL SELECT event_id, 'TRANSIENT', 2 FROM events WHERE event_id % 13 = 0)"""


@bind("e_08_evidence_facts", f"WITH {NOTES} SELECT record_id, value, CAST(priority AS INTEGER) AS priority FROM f")
def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entity.evidence(notes(spark, sf_dir), {"description": False}).filter("kind = 'ECOTYPE'").select("record_id", "value", "priority")


@bind("a_09_classified_labels", f"WITH {NOTES}, b AS (SELECT record_id, min(priority) AS best FROM f GROUP BY 1) SELECT record_id, CASE WHEN count(DISTINCT value) > 1 THEN 'MIXED' ELSE min(value) END AS detail FROM f JOIN b USING (record_id) WHERE priority = best GROUP BY 1")
def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entity.classify(entity.evidence(notes(spark, sf_dir), {"description": False}))


@bind("p_01_accepted_buckets", with_sightings("SELECT detail, CASE detail WHEN 'SRKW' THEN 'SRKW' WHEN 'TRANSIENT' THEN 'TRANSIENT' ELSE 'OTHER' END AS bucket, count(*) AS rows FROM s GROUP BY ALL"))
def buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sightings(spark, sf_dir).groupBy("detail", ObservationPolicy().bucket(F.col("detail")).alias("bucket")).agg(F.count(F.lit(1)).alias("rows"))
