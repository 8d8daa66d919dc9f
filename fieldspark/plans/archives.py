"""Archive dates, encounters, anchor quality, censuses and further evaluation bound to the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldspark.functions.temporal import week_start
from fieldspark.functions.text import use_class
from fieldspark.operators import archive
from fieldspark.plans.base import sightings, table, with_sightings
from fieldspark.plans.evaluation import SCORED, scored
from fieldspark.plans.registry import Registry

REGISTRY = Registry.new()
bind = REGISTRY.bind


@bind(
    "c_22_archive_dates",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 4 THEN NULL ELSE o_orderdate::DATE END AS day, CASE o_orderkey % 5 WHEN 1 THEN 'YEAR_REPAIRED' WHEN 4 THEN 'UNPARSED_DATE' ELSE '' END AS flags FROM orders""",
)
def archive_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, d = F.col("o_orderkey") % 5, F.col("o_orderdate")
    part = lambda f: F.date_format(d, f)
    raw = (
        F.when(k == 0, F.replace(part("d-MMM-yyyy"), F.lit("Sep"), F.lit("Sept")))
        .when(k == 1, F.concat(part("d/M"), F.lit("/"), F.substring(part("yyyy"), 2, 3)))
        .when(k == 2, part("d-MMMM"))
        .when(k == 3, part("d-M-yy"))
        .otherwise(F.lit("some day"))
    )
    parsed = table(spark, sf_dir, "orders").select("o_orderkey", archive.archive_date(raw, F.year(d)).alias("p"))
    return parsed.select("o_orderkey", "p.day", F.array_join("p.flags", ",").alias("flags"))


@bind(
    "c_25_plausible_starts",
    """SELECT event_id, CASE WHEN event_id % 4 = 3 THEN NULL WHEN hour(ts) * 60 + minute(ts) BETWEEN 240 AND 1260 THEN strftime(ts, '%H:%M') END AS start FROM events""",
)
def starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    k, at = F.col("event_id") % 4, F.col("ts")
    start = F.when(k == 0, F.date_format(at, "H:mm")).when(k == 1, F.date_format(at, "h:mm a")).when(k == 2, F.date_format(at, "HHmm")).otherwise(F.lit("noon"))
    return e.select("event_id", archive.encounter_start(start, F.lit(None).cast("string")).alias("start"))


@bind(
    "a_10_collapsed_encounters",
    with_sightings(""", r AS (SELECT observation_id // 6 AS encounter, CASE WHEN observation_id % 31 = 0 THEN NULL ELSE sighting_date END AS day, CASE WHEN observation_id % 17 = 0 THEN NULL ELSE lat END AS lat, lon,
  CASE WHEN observation_id % 13 = 0 THEN -1.0 WHEN observation_id % 3 = 0 THEN NULL ELSE observation_id % 900 END::DOUBLE AS uncertainty FROM s),
g AS (SELECT encounter, count(*) AS occurrences, count(DISTINCT day) AS days, count(*) - count(day) AS no_day, count(*) - count(lat) AS no_place, median(lat) AS lat, median(lon) AS lon,
  max(uncertainty) FILTER (WHERE uncertainty >= 0) AS uncertainty, count(*) FILTER (WHERE uncertainty < 0) AS bad FROM r GROUP BY 1)
SELECT encounter, occurrences, round(lat, 6) AS lat, round(lon, 6) AS lon, uncertainty, concat_ws(',', CASE WHEN no_place > 0 THEN 'COORDINATES_MISSING' END, CASE WHEN days <> 1 OR no_day > 0 THEN 'DAY_MISSING_OR_CONFLICTING' END,
  CASE WHEN uncertainty > 800 THEN 'UNCERTAINTY_EXCEEDS_LIMIT' END, CASE WHEN bad > 0 THEN 'UNCERTAINTY_INVALID' END) AS reasons FROM g"""),
)
def encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("observation_id")
    rows = sightings(spark, sf_dir).select(
        F.floor(i / 6).cast("long").alias("encounter"), F.when(i % 31 != 0, F.col("sighting_date")).alias("day"), F.when(i % 17 != 0, F.col("lat")).alias("lat"), "lon",
        F.when(i % 13 == 0, F.lit(-1.0)).when(i % 3 != 0, (i % 900).cast("double")).alias("uncertainty"), F.lit("cc0").alias("license"), F.col("detail").alias("remark"), i.alias("occurrence"),
    )
    out = archive.collapse_encounters(rows, ["encounter"], max_spread_km=10_000, max_uncertainty_m=800)
    return out.select("encounter", "occurrences", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"), "uncertainty", F.array_join("reasons", ",").alias("reasons"))


@bind(
    "a_14_anchor_quality",
    with_sightings(""", f AS (SELECT observation_id, max(CASE WHEN observation_id % 10 = 0 THEN 0.0 WHEN observation_id % 3 = 0 THEN 1.0 WHEN observation_id % 3 = 1 THEN 0.75 ELSE 0.6 END) AS w FROM s WHERE observation_id % 2 = 0 GROUP BY 1)
SELECT observation_id, CASE WHEN detail = 'MIXED' OR observation_id % 19 = 0 THEN 0.0 ELSE coalesce(w, 1.0) END::DOUBLE AS anchor_weight,
  CASE WHEN detail = 'MIXED' THEN 'CONFLICT' WHEN observation_id % 19 = 0 THEN 'LOW_QUALITY_NON_ANCHOR' WHEN w IS NULL THEN 'OBSERVED' WHEN w >= 0.99 THEN 'GOLD' WHEN w >= 0.6 THEN 'SILVER' ELSE 'CONFLICT' END AS label_quality
FROM s LEFT JOIN f USING (observation_id)"""),
)
def anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("observation_id")
    obs = sightings(spark, sf_dir).select("observation_id", "detail", F.when(i % 19 == 0, "LOW_QUALITY_NON_ANCHOR").otherwise("STANDARD").alias("tier"))
    facts = obs.filter("observation_id % 2 = 0").select(
        "observation_id", F.col("detail").alias("value"), F.when(i % 3 == 0, "STRONG").when(i % 3 == 1, "EXPLICIT").otherwise("WEAK").alias("confidence"), F.lit("description").alias("field"), (i % 10 == 0).alias("conflicting")
    )
    return archive.anchor_quality(obs, facts).select("observation_id", "anchor_weight", "label_quality")


CENSUS = "c AS (SELECT year(o_orderdate) AS census_year, count(*) FILTER (WHERE o_orderstatus = 'F') AS j, count(*) FILTER (WHERE o_orderstatus = 'O') AS k, count(*) FILTER (WHERE o_orderstatus = 'P') AS l, count(*) + (year(o_orderdate) % 3 = 0)::INTEGER AS total FROM orders GROUP BY 1)"


def census(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("census_year")).pivot("o_orderstatus", ["F", "O", "P"]).count().fillna(0)
    extra = F.when(F.col("census_year") % 3 == 0, 1).otherwise(0)
    return wide.select("census_year", F.col("F").alias("j"), F.col("O").alias("k"), F.col("P").alias("l"), (F.col("F") + F.col("O") + F.col("P") + extra).alias("total"))


@bind("v_20_annual_counts", f"WITH {CENSUS} SELECT census_year::INTEGER AS census_year, j, k, l, total, j + k + l AS part_sum, j + k + l = total AS total_matches FROM c")
def annual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive.annual_counts(census(spark, sf_dir), ["j", "k", "l"], "total")


@bind("v_21_census_summary", f"WITH {CENSUS} SELECT max(census_year)::INTEGER AS latest_year, arg_max(total, census_year) AS latest_total, count(*) AS years, array_to_string(list_sort(list(census_year) FILTER (WHERE j + k + l <> total)), ',') AS mismatched FROM c")
def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = archive.census_summary(census(spark, sf_dir), ["j", "k", "l"], "total")
    return s.select(F.col("latest.census_year").alias("latest_year"), F.col("latest.total").alias("latest_total"), "years", F.array_join(F.transform("mismatched", lambda x: x.cast("string")), ",").alias("mismatched"))


@bind(
    "v_05_weekly_differences",
    with_sightings(""", w AS (SELECT bucket, CAST(date_trunc('week', period_start) AS DATE) AS period_start, count(*) AS days FROM s GROUP BY ALL)
SELECT bucket, period_start, days + 1 AS week, days FROM w WHERE day(period_start) % 2 = 0"""),
)
def weekly_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = sightings(spark, sf_dir)
    daily = obs.groupBy("bucket", "period_start").agg(F.count(F.lit(1)).alias("n"))
    weekly = obs.groupBy("bucket", week_start(F.col("period_start")).alias("period_start")).agg(F.count(F.lit(1)).alias("n"))
    wrong = weekly.withColumn("n", F.col("n") + F.when(F.dayofmonth("period_start") % 2 == 0, 1).otherwise(0))
    return archive.weekly_differences(daily, wrong, ["bucket"], "n")


@bind(
    "v_03_total_differences",
    with_sightings(", t AS (SELECT period_start, count(*) AS n FROM s GROUP BY 1) SELECT period_start, n AS buckets, n - 1 AS total FROM t WHERE day(period_start) = 7"),
)
def total_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = sightings(spark, sf_dir)
    buckets = obs.groupBy("period_start", "bucket").agg(F.count(F.lit(1)).alias("n"))
    totals = obs.groupBy("period_start").agg((F.count(F.lit(1)) - F.max(F.when(F.dayofmonth("period_start") == 7, 1).otherwise(0))).alias("n"))
    return archive.total_differences(buckets, totals, ["period_start"], "n")


@bind("v_12_unlicensed_records", "SELECT DISTINCT l_partkey AS record_id FROM lineitem WHERE l_partkey % 4 = 0")
def unlicensed(spark: SparkSession, sf_dir: str) -> DataFrame:
    outputs = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list("l_partkey").alias("record_ids"))
    snapshots = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("record_id"), F.when(F.col("p_partkey") % 4 == 0, "INTERNAL_ONLY").otherwise("REDISTRIBUTABLE").alias("use_class"))
    return archive.unlicensed(outputs, snapshots)


@bind("c_34_use_classes", "SELECT n_nationkey, CASE n_nationkey % 4 WHEN 0 THEN 'REDISTRIBUTABLE' WHEN 1 THEN 'REDISTRIBUTABLE' ELSE 'INTERNAL_ONLY' END AS use_class FROM nation")
def use_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey") % 4
    licenses = F.when(k == 0, F.array(F.lit("CC0-1.0"))).when(k == 1, F.array(F.lit("cc-by 4.0"), F.lit("CC0"))).when(k == 2, F.array(F.lit("cc-by-nc"))).otherwise(F.array().cast("array<string>"))
    return table(spark, sf_dir, "nation").select("n_nationkey", use_class(licenses).alias("use_class"))


@bind(
    "o_05_capped_sample",
    with_sightings(""", r AS (SELECT observation_id AS id, detail, observation_id % 97 AS encounter, md5('sample|' || observation_id) AS h FROM s), t AS (SELECT *, row_number() OVER (PARTITION BY detail, encounter ORDER BY h, id) AS turn FROM r)
SELECT id, detail, encounter FROM t QUALIFY row_number() OVER (PARTITION BY detail ORDER BY turn, h, id) <= 200"""),
)
def sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sightings(spark, sf_dir).select(F.col("observation_id").alias("id"), "detail", (F.col("observation_id") % 97).alias("encounter"))
    return archive.capped_sample(rows, "detail", "encounter", 200)


@bind("o_07_paired_bootstrap")
def bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    y = F.col("y")
    rows = scored(spark, sf_dir).select("id", ((F.col("p") - y) * (F.col("p") - y)).alias("a"), ((F.col("q") - y) * (F.col("q") - y)).alias("b"))
    return archive.paired_bootstrap(rows, "a", "b", 100)


@bind("r_20_higher_quantile", f"WITH {SCORED}, o AS (SELECT lang, list_sort(list(p)) AS v FROM d GROUP BY 1) SELECT lang, v[CAST(ceil(0.9 * (len(v) - 1)) AS INTEGER) + 1] AS threshold FROM o")
def quantile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive.higher_quantiles(scored(spark, sf_dir), "lang", "p", 0.9)


@bind(
    "r_21_multiclass_losses",
    f"""WITH {SCORED}, m AS (SELECT CASE WHEN y = 1 THEN 'a' WHEN id % 2 = 0 THEN 'b' ELSE 'c' END AS label, w, 0.2 + 0.6 * p AS pa, 0.5 - 0.4 * p AS pb, 0.3 - 0.2 * p AS pc FROM d)
SELECT round(sum(w * (power(pa - (label = 'a')::INTEGER, 2) + power(pb - (label = 'b')::INTEGER, 2) + power(pc - (label = 'c')::INTEGER, 2))) / sum(w), 9) AS brier,
  round(sum(w * -ln(greatest(1e-12, CASE label WHEN 'a' THEN pa WHEN 'b' THEN pb ELSE pc END))) / sum(w), 9) AS log_loss FROM m""",
)
def multiclass(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("p")
    rows = scored(spark, sf_dir).select(
        F.when(F.col("y") == 1, "a").when(F.col("id") % 2 == 0, "b").otherwise("c").alias("label"), "w", (0.2 + 0.6 * p).alias("p_a"), (0.5 - 0.4 * p).alias("p_b"), (0.3 - 0.2 * p).alias("p_c")
    )
    return archive.multiclass_losses(rows, ["a", "b", "c"]).select(F.round("brier", 9).alias("brier"), F.round("log_loss", 9).alias("log_loss"))


@bind("m_12_block_folds", with_sightings("SELECT observation_id, observation_id % 97 AS encounter, CAST(('0x' || substr(md5(CAST(observation_id % 97 AS VARCHAR)), 1, 8))::BIGINT % 5 AS INTEGER) AS fold FROM s"))
def folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldspark.operators.imputation import block_folds

    rows = sightings(spark, sf_dir).select("observation_id", (F.col("observation_id") % 97).alias("encounter"))
    return block_folds(rows, "encounter", 5)


@bind("z_55_applied_imputations", with_sightings("SELECT count(*) AS applied FROM s WHERE imputation_applied"))
def applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sightings(spark, sf_dir).filter("imputation_applied").agg(F.count(F.lit(1)).alias("applied"))


@bind(
    "c_31_page_links",
    r"""WITH a AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<a\s[^>]*href="([^"]*)"[^>]*>(.*?)</a>', 0)) AS a FROM pages)
SELECT DISTINCT page_id, regexp_extract(a, '(?is)href="([^"]*)"', 1) AS href, trim(regexp_replace(a, '<[^>]*>', '', 'g')) AS title FROM a""",
)
def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldspark.sources.readers import page_links

    return page_links(table(spark, sf_dir, "pages"))


@bind("a_19_payload_profile")
def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldspark.operators.quality import profile_types

    return profile_types(table(spark, sf_dir, "events"), "props", ["k", "missing"])
