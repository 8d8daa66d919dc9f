"""Windows, orders, groupings and as-of joins bound to the tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldspark.functions.geo import haversine_km
from fieldspark.functions.policies import ObservationPolicy
from fieldspark.functions.temporal import week_start
from fieldspark.operators import counts as C
from fieldspark.operators import entity, ordering
from fieldspark.plans.base import HAVERSINE, sightings, table, with_sightings
from fieldspark.plans.registry import Registry

REGISTRY = Registry.new()
bind = REGISTRY.bind


@bind("a_37_cube", with_sightings("SELECT detail, source, count(*) AS n, count(DISTINCT user_id) AS users, CAST(grouping(detail) * 2 + grouping(source) AS BIGINT) AS level FROM s GROUP BY CUBE (detail, source)"))
def cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sightings(spark, sf_dir).cube("detail", "source").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("users"), F.grouping_id().alias("level"))


@bind("a_37_rollup", with_sightings("SELECT bucket, detail, sum(source_report_count)::BIGINT AS reports, CAST(grouping(bucket) * 2 + grouping(detail) AS BIGINT) AS level FROM s GROUP BY ROLLUP (bucket, detail)"))
def rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sightings(spark, sf_dir).rollup("bucket", "detail").agg(F.sum("source_report_count").alias("reports"), F.grouping_id().alias("level"))


@bind("a_37_approximate_aggregates", with_sightings("SELECT detail, count(DISTINCT user_id) AS users, true AS near, true AS middle FROM s GROUP BY 1"))
def approximate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches beside exact values: within 5 %, and a median between the exact ones around it."""
    obs = sightings(spark, sf_dir)
    # Apart, as beside a distinct count a sketch would be made for each user; the exact parts first count equal values.
    sketches = obs.groupBy("detail").agg(F.approx_count_distinct("user_id", 0.01).alias("n"), F.percentile_approx("value", 0.5, 10000).alias("m"))
    users = obs.select("detail", "user_id").distinct().groupBy("detail").agg(F.count("user_id").alias("users"))
    values = obs.groupBy("detail", "value").agg(F.count(F.lit(1)).alias("k")).groupBy("detail").agg(*[F.percentile("value", F.lit(q), F.col("k")).alias(x) for x, q in (("low", 0.45), ("high", 0.55))])
    on = lambda a, b: a.join(b.withColumnRenamed("detail", "d"), F.col("detail").eqNullSafe(F.col("d"))).drop("d")
    close = F.abs(F.col("n") - F.col("users")) <= 0.05 * F.col("users")
    return on(on(sketches, users), values).select("detail", "users", close.alias("near"), F.col("m").between(F.col("low"), F.col("high")).alias("middle"))


@bind(
    "w_12_range_frames",
    """SELECT event_id, round(sum(value) OVER (PARTITION BY user_id % 50 ORDER BY date_diff('day', DATE '2024-01-01', ts::DATE) RANGE BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS near_sum,
 count(*) OVER (PARTITION BY user_id % 50 ORDER BY date_diff('day', DATE '2024-01-01', ts::DATE) RANGE BETWEEN 1 FOLLOWING AND 3 FOLLOWING) AS ahead FROM events""",
)
def range_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_diff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date"))
    w = Window.partitionBy(F.col("user_id") % 50).orderBy(day)
    return table(spark, sf_dir, "events").select("event_id", F.round(F.sum("value").over(w.rangeBetween(-2, 0)), 6).alias("near_sum"), F.count(F.lit(1)).over(w.rangeBetween(1, 3)).alias("ahead"))


@bind(
    "w_12_rank_functions",
    """SELECT event_id, lead(event_id) OVER w AS next_id, CAST(ntile(4) OVER w AS INTEGER) AS quarter, round(percent_rank() OVER w, 9) AS percent_rank, round(cume_dist() OVER w, 9) AS cume_dist,
 CAST(dense_rank() OVER (PARTITION BY event_type ORDER BY user_id) AS INTEGER) AS user_rank FROM events WINDOW w AS (PARTITION BY event_type ORDER BY value, event_id)""",
)
def rank_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("event_type").orderBy("value", "event_id")
    return table(spark, sf_dir, "events").select(
        "event_id", F.lead("event_id").over(w).alias("next_id"), F.ntile(4).over(w).alias("quarter"), F.round(F.percent_rank().over(w), 9).alias("percent_rank"),
        F.round(F.cume_dist().over(w), 9).alias("cume_dist"), F.dense_rank().over(Window.partitionBy("event_type").orderBy("user_id")).alias("user_rank"),
    )


@bind("w_08_group_minimum", with_sightings("SELECT observation_id, min(concat_ws(':', CAST(period_start AS VARCHAR), floor(lat)::BIGINT, floor(lon)::BIGINT)) OVER (PARTITION BY user_id) AS block FROM s"))
def group_minimum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An encounter's rows share the least of their space-time blocks."""
    block = F.concat_ws(":", F.col("period_start").cast("string"), F.floor("lat").cast("string"), F.floor("lon").cast("string"))
    return sightings(spark, sf_dir).select("observation_id", F.min(block).over(Window.partitionBy("user_id")).alias("block"))


@bind("w_11_best_representative", with_sightings("SELECT user_id, observation_id, detail FROM s QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY CASE detail WHEN 'SRKW' THEN 0 WHEN 'TRANSIENT' THEN 1 ELSE 2 END, source_report_count DESC, sighting_date, observation_id) = 1"))
def best_representative(spark: SparkSession, sf_dir: str) -> DataFrame:
    rank = F.when(F.col("detail") == "SRKW", 0).when(F.col("detail") == "TRANSIENT", 1).otherwise(2)
    return entity.representative(sightings(spark, sf_dir), ["user_id"], [rank, F.desc("source_report_count"), F.col("sighting_date"), F.col("observation_id")]).select("user_id", "observation_id", "detail")


@bind(
    "o_01_record_order",
    with_sightings("SELECT observation_id, row_number() OVER (PARTITION BY sighting_date ORDER BY CASE WHEN observation_id % 4 = 0 THEN sighting_date + INTERVAL 12 HOUR ELSE event_at END, source, observation_id) AS place FROM s"),
)
def record_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order in which records are clustered: time (noon where a record has none), rank of the source, id."""
    timed = F.when(F.col("observation_id") % 4 != 0, F.col("event_at"))
    noon = F.col("sighting_date").cast("timestamp_ntz") + F.expr("INTERVAL 12 HOURS")
    order = Window.partitionBy("sighting_date").orderBy(F.coalesce(timed.cast("timestamp_ntz"), noon), "source", "observation_id")
    return sightings(spark, sf_dir).select("observation_id", F.row_number().over(order).cast("long").alias("place"))


@bind("o_02_preferred_record", with_sightings("SELECT user_id, observation_id FROM s QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY (observation_id % 3 = 0), (observation_id % 4 = 0), source, observation_id) = 1"))
def preferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a group the record with a date of its own, then one with a time, then by source: an aggregate, not a sort."""
    k = F.col("observation_id")
    return sightings(spark, sf_dir).groupBy("user_id").agg(F.min_by("observation_id", F.struct((k % 3 == 0).alias("a"), (k % 4 == 0).alias("b"), F.col("source").alias("c"), k.alias("d"))).alias("observation_id"))


@bind("o_04_top_coefficients", "SELECT doc_id AS feature, round((n_chars % 1000 - 500) / 100.0, 4)::DOUBLE AS coefficient FROM documents ORDER BY abs(n_chars % 1000 - 500) DESC, doc_id LIMIT 20")
def top_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.col("n_chars") % 1000 - 500
    return table(spark, sf_dir, "documents").orderBy(F.abs(value).desc(), "doc_id").limit(20).select(F.col("doc_id").alias("feature"), F.round(value / 100.0, 4).alias("coefficient"))


@bind(
    "o_06_capped_majority",
    with_sightings(""", one AS (SELECT detail, observation_id FROM s QUALIFY row_number() OVER (PARTITION BY detail, user_id ORDER BY md5(CAST(observation_id AS VARCHAR)), observation_id) = 1),
cap AS (SELECT floor(min(n) * 1.02) AS cap FROM (SELECT count(*) AS n FROM one GROUP BY detail)), r AS (SELECT *, row_number() OVER (PARTITION BY detail ORDER BY md5(CAST(observation_id AS VARCHAR)), observation_id) AS n FROM one)
SELECT detail, observation_id FROM r, cap WHERE n <= cap"""),
)
def majority(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = F.struct(F.md5(F.col("observation_id").cast("string").cast("binary")), F.col("observation_id"))
    return ordering.capped_majority(sightings(spark, sf_dir), "detail", "user_id", 1.02, order).select("detail", "observation_id")


@bind(
    "j_20_as_of_join",
    """WITH r AS (SELECT user_id, ts, max(event_id) AS purchase_id FROM events WHERE event_type = 'purchase' GROUP BY ALL), l AS (SELECT user_id, ts, event_id FROM events WHERE event_type = 'view')
SELECT l.event_id, l.user_id, r.purchase_id FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.ts >= r.ts""",
)
def as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    last = e.filter("event_type = 'purchase'").select("user_id", "ts", F.col("event_id").alias("purchase_id"))
    return ordering.as_of_join(e.filter("event_type = 'view'").select("user_id", "ts", "event_id"), last, ["user_id"], "ts", ["purchase_id"]).select("event_id", "user_id", "purchase_id")


START, END = date(2023, 12, 25), date(2024, 2, 4)
DAYS = "days AS (SELECT CAST(t AS DATE) AS period_start FROM generate_series(DATE '2023-12-25', DATE '2024-02-04', INTERVAL 1 DAY) g(t))"


@bind("j_03_calendar_join", with_sightings(f", {DAYS} SELECT d.period_start, count(s.observation_id) AS n, coalesce(sum(s.source_report_count), 0)::BIGINT AS reports FROM days d LEFT JOIN s USING (period_start) GROUP BY 1"))
def calendar_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = sightings(spark, sf_dir).groupBy("period_start").agg(F.count(F.lit(1)).alias("n"), F.sum("source_report_count").alias("reports"))
    return C.fill_calendar(counted, C.periods(spark, START, END, "daily", verified=True).select("period_start"), ["n", "reports"])


@bind("j_09_dense_scaffold", with_sightings(f", {DAYS}, cells AS (SELECT DISTINCT source AS cell FROM s) SELECT cell, period_start, count(s.observation_id) AS n FROM cells CROSS JOIN days LEFT JOIN s ON s.source = cell AND s.period_start = days.period_start GROUP BY ALL".replace("SELECT cell, period_start", "SELECT cell, days.period_start AS period_start")))
def scaffold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every cell in every period: cells come from the data, periods from a calendar of bounded length."""
    obs = sightings(spark, sf_dir)
    counted = obs.groupBy(F.col("source").alias("cell"), "period_start").agg(F.count(F.lit(1)).alias("n"))
    days = C.periods(spark, START, END, "daily", verified=True).select("period_start")
    return counted.select("cell").distinct().crossJoin(F.broadcast(days)).join(counted, ["cell", "period_start"], "left").fillna(0, ["n"])


@bind("u_02_union_of_frequencies", with_sightings("SELECT 'daily' AS frequency, period_start, count(*) AS n FROM s GROUP BY ALL UNION ALL SELECT 'weekly', CAST(date_trunc('week', period_start) AS DATE), count(*) FROM s GROUP BY ALL"))
def frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = sightings(spark, sf_dir).groupBy("period_start").agg(F.count(F.lit(1)).alias("n"))
    weekly = daily.groupBy(week_start(F.col("period_start")).alias("period_start")).agg(F.sum("n").alias("n"))
    return daily.withColumn("frequency", F.lit("daily")).unionByName(weekly.withColumn("frequency", F.lit("weekly")))


@bind(
    "a_07_first_and_last_per_group",
    with_sightings("SELECT user_id, min(event_at) FILTER (source < 3) AS first_at, arg_min(observation_id, (event_at, observation_id)) FILTER (source < 3) AS first_id, max(event_at) AS last_at, arg_max(observation_id, (event_at, observation_id)) AS last_id FROM s GROUP BY 1"),
)
def first_and_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = F.struct("event_at", "observation_id")
    early = F.col("source") < 3
    return sightings(spark, sf_dir).groupBy("user_id").agg(
        F.min(F.when(early, F.col("event_at"))).alias("first_at"), F.min_by("observation_id", F.when(early, order)).alias("first_id"), F.max("event_at").alias("last_at"), F.max_by("observation_id", order).alias("last_id")
    )


@bind("a_11_group_spread", with_sightings(f"SELECT a.user_id, round(max({HAVERSINE}), 6) AS spread_km FROM s a JOIN s b ON a.user_id = b.user_id AND a.sighting_date = b.sighting_date AND a.observation_id < b.observation_id GROUP BY 1"))
def spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Largest distance between two records of a user's day: groups of a day are small, and pairs stay inside them."""
    places = sightings(spark, sf_dir).groupBy("user_id", "sighting_date").agg(F.collect_list(F.struct("lat", "lon")).alias("p")).filter("size(p) > 1")
    apart = F.transform("p", lambda a: F.array_max(F.transform("p", lambda b: haversine_km(a["lat"], a["lon"], b["lat"], b["lon"]))))
    return places.groupBy("user_id").agg(F.round(F.max(F.array_max(apart)), 6).alias("spread_km"))


@bind(
    "a_12_group_keys",
    with_sightings("""SELECT observation_id, CASE WHEN observation_id % 5 = 0 THEN 'event:' || user_id WHEN observation_id % 5 = 1 THEN 'exact:' || md5(concat_ws('|', strftime(event_at, '%Y-%m-%d %H:%M:%S'), printf('%.7f', lat), printf('%.7f', lon)))
 WHEN observation_id % 5 = 2 THEN 'occurrence:' || observation_id ELSE 'payload:' || sha256(payload) END AS group_key FROM s"""),
)
def group_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What records are grouped by: the provider's event, the exact time and place, the occurrence, or the payload."""
    k = F.col("observation_id") % 5
    event = F.when(k == 0, F.concat(F.lit("event:"), F.col("user_id").cast("string")))
    exact = F.when(k == 1, F.concat(F.lit("exact:"), F.md5(F.concat_ws("|", F.date_format("event_at", "yyyy-MM-dd HH:mm:ss"), F.format_string("%.7f", "lat"), F.format_string("%.7f", "lon")).cast("binary"))))
    occurrence = F.when(k == 2, F.concat(F.lit("occurrence:"), F.col("observation_id").cast("string")))
    return sightings(spark, sf_dir).select("observation_id", F.coalesce(event, exact, occurrence, F.concat(F.lit("payload:"), F.sha2("payload", 256))).alias("group_key"))


@bind(
    "a_13_sequences",
    with_sightings("""SELECT user_id, arg_min(observation_id, (event_at, observation_id)) FILTER (observation_id % 3 <> 0) AS first_valid, arg_max(observation_id, (event_at, observation_id)) FILTER (observation_id % 2 = 0) AS last_valid,
 array_to_string(list_sort(list(DISTINCT detail)), '; ') AS details, count(DISTINCT sighting_date) > 1 AS dates_disagree FROM s GROUP BY 1"""),
)
def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    order, k = F.struct("event_at", "observation_id"), F.col("observation_id")
    return sightings(spark, sf_dir).groupBy("user_id").agg(
        F.min_by("observation_id", F.when(k % 3 != 0, order)).alias("first_valid"), F.max_by("observation_id", F.when(k % 2 == 0, order)).alias("last_valid"),
        F.array_join(F.array_sort(F.collect_set("detail")), "; ").alias("details"), (F.min("sighting_date") != F.max("sighting_date")).alias("dates_disagree"),
    )


@bind(
    "a_18_normalization_metrics",
    with_sightings("""SELECT 'source' AS metric, CAST(source AS VARCHAR) AS name, count(*) AS n FROM s GROUP BY ALL UNION ALL SELECT 'label', detail, count(*) FROM s GROUP BY ALL
UNION ALL SELECT 'context', context_status, count(*) FROM s GROUP BY ALL UNION ALL SELECT 'eligible', CAST(detail NOT IN ('UNKNOWN', 'MIXED') AS VARCHAR), count(*) FROM s GROUP BY ALL"""),
)
def normalization_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of several kinds in one pass: each row is counted under four names."""
    eligible = ~F.col("detail").isin(*ObservationPolicy().open_labels)
    names = {"source": F.col("source"), "label": F.col("detail"), "context": F.col("context_status"), "eligible": eligible}
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("metric"), c.cast("string").alias("name")) for k, c in names.items()]))
    return sightings(spark, sf_dir).select(each.alias("m")).groupBy("m.metric", "m.name").agg(F.count(F.lit(1)).alias("n"))


@bind("a_36_grid_estimate", with_sightings("SELECT count(DISTINCT source)::BIGINT * 42 * 3 AS rows, count(DISTINCT source)::BIGINT * 42 * 3 * 130 AS bytes FROM s"))
def estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and bytes of a dense grid before it is built: cells x periods x buckets at 130 bytes."""
    days = (END - START).days + 1
    rows = F.countDistinct("source") * days * 3
    return sightings(spark, sf_dir).agg(rows.alias("rows"), (rows * 130).alias("bytes"))


@bind("h_16_tumbling_windows", "SELECT event_type, time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '2024-01-01') AS start, count(*) AS n FROM events GROUP BY ALL")
def tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = F.window("ts", "6 hours")
    return table(spark, sf_dir, "events").groupBy("event_type", w.alias("w")).agg(F.count(F.lit(1)).alias("n")).select("event_type", F.col("w.start").alias("start"), "n")


@bind(
    "h_16_sliding_windows",
    "SELECT event_type, time_bucket(INTERVAL 1 DAY, ts, TIMESTAMP '2024-01-01') - INTERVAL 1 DAY * k AS start, count(*) AS n FROM events, (VALUES (0), (1), (2)) v(k) GROUP BY ALL",
)
def sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = F.window("ts", "3 days", "1 day")
    return table(spark, sf_dir, "events").groupBy("event_type", w.alias("w")).agg(F.count(F.lit(1)).alias("n")).select("event_type", F.col("w.start").alias("start"), "n")


@bind(
    "h_16_session_windows",
    """WITH o AS (SELECT user_id, ts, CASE WHEN ts >= lag(ts) OVER w + INTERVAL 12 HOUR OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
n AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM o)
SELECT user_id, min(ts) AS start, count(*) AS n FROM n GROUP BY user_id, session""",
)
def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = F.session_window("ts", "12 hours")
    return table(spark, sf_dir, "events").groupBy("user_id", w.alias("w")).agg(F.count(F.lit(1)).alias("n")).select("user_id", F.col("w.start").alias("start"), "n")
