"""Counts, calendars, masses and dense grids over the sightings view."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldspark.functions.geo import degree_cell, grid_cell, region_label
from fieldspark.functions.temporal import daylight_hours, era, period_fields, season, week_start, year_wave
from fieldspark.operators import counts as C
from fieldspark.plans.base import sightings, table, with_sightings
from fieldspark.plans.registry import Registry

REGISTRY = Registry.new()
bind = REGISTRY.bind

START, END = date(2024, 1, 1), date(2024, 1, 30)
CELL = "concat_ws(':', CAST(CAST(floor(lat / 0.5) AS BIGINT) AS VARCHAR), CAST(CAST(floor(lon / 0.5) AS BIGINT) AS VARCHAR))"


def celled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sightings(spark, sf_dir).withColumn("cell", degree_cell(F.col("lat"), F.col("lon"), 0.5))


HARD_SQL = """count(DISTINCT observation_id) AS sighting_count, CAST(sum(source_report_count) AS BIGINT) AS source_report_count,
  CAST(sum(CASE WHEN imputation_applied THEN 0 ELSE 1 END) AS BIGINT) AS observed_count, CAST(sum(CASE WHEN imputation_applied THEN 1 ELSE 0 END) AS BIGINT) AS imputed_count"""


@bind("a_01_daily_counts", with_sightings(f"SELECT {CELL} AS cell, bucket, period_start, {HARD_SQL} FROM s GROUP BY ALL"))
def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.daily_counts(celled(spark, sf_dir), ["cell", "bucket"])


MASS = with_sightings("""
, m AS (
  SELECT observation_id, period_start, context_status, 'SRKW' AS detail, 'SRKW' AS bucket, expected_srkw / 1 AS w, false AS unknown FROM n
  UNION ALL SELECT observation_id, period_start, context_status, 'TRANSIENT', 'TRANSIENT', expected_transient, false FROM n
  UNION ALL SELECT observation_id, period_start, context_status, 'UNKNOWN', 'OTHER', expected_unknown, true FROM n
  UNION ALL SELECT observation_id, period_start, context_status, detail, 'OTHER', expected_other, false FROM n
), c AS (SELECT *, w AS expected_count, CASE WHEN context_status = 'PROVISIONAL_RECENT' THEN 0 ELSE w END AS mature_expected_count,
         CASE WHEN context_status = 'PROVISIONAL_RECENT' THEN w ELSE 0 END AS provisional_expected_count, CASE WHEN unknown THEN w ELSE 0 END AS expected_unknown_count
         FROM m WHERE w > 0)
""").replace("\n, m AS", "\n, n AS (SELECT * FROM s)\n, m AS")
SOFT = "sum(expected_count) AS expected_count, sum(mature_expected_count) AS mature_expected_count, sum(provisional_expected_count) AS provisional_expected_count, sum(expected_unknown_count) AS expected_unknown_count"


@bind("a_02_expected_contributions", MASS + f"SELECT bucket, detail, count(*) AS rows, {SOFT} FROM c GROUP BY ALL")
def contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = C.expected_contributions(sightings(spark, sf_dir))
    return parts.groupBy("bucket", "detail").agg(F.count(F.lit(1)).alias("rows"), *[F.sum(c).alias(c) for c in C.EXPECTED])


@bind(
    "j_02_hard_and_expected_counts",
    MASS
    + f""", h AS (SELECT detail, period_start, {HARD_SQL} FROM s GROUP BY ALL), e AS (SELECT detail, period_start, {SOFT} FROM c GROUP BY ALL)
SELECT detail, period_start, coalesce(sighting_count, 0) AS sighting_count, coalesce(source_report_count, 0) AS source_report_count, coalesce(observed_count, 0) AS observed_count,
  coalesce(imputed_count, 0) AS imputed_count, coalesce(expected_count, 0) AS expected_count, coalesce(mature_expected_count, 0) AS mature_expected_count,
  coalesce(provisional_expected_count, 0) AS provisional_expected_count, coalesce(expected_unknown_count, 0) AS expected_unknown_count
FROM h FULL JOIN e USING (detail, period_start)""",
)
def hard_and_expected(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = sightings(spark, sf_dir)
    return C.daily_counts(obs, ["detail"], C.expected_contributions(obs))


@bind(
    "a_03_mass_violations",
    with_sightings("""SELECT count(*) AS rows, 0::BIGINT AS not_finite, count(*) FILTER (WHERE expected_srkw > 1 OR expected_transient > 1) AS outside,
      count(*) FILTER (WHERE abs(expected_srkw + expected_transient + expected_unknown + expected_other - 1) > 1e-9) AS not_unit FROM s"""),
)
def mass_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.mass_violations(sightings(spark, sf_dir), ["expected_srkw", "expected_transient", "expected_unknown", "expected_other"]).withColumns(
        {c: F.col(c).cast("long") for c in ("not_finite", "outside", "not_unit")}
    )


WEEKLY = with_sightings(f""", d AS (SELECT {CELL} AS cell, period_start, {HARD_SQL} FROM s GROUP BY ALL),
w AS (SELECT cell, CAST(date_trunc('week', period_start) AS DATE) AS period_start, CAST(sum(sighting_count) AS BIGINT) AS sighting_count, CAST(sum(source_report_count) AS BIGINT) AS source_report_count FROM d GROUP BY ALL)
SELECT cell, period_start, sighting_count, source_report_count, CAST(year(period_start) AS INTEGER) AS year, CAST(dayofyear(period_start) AS INTEGER) AS day_of_year,
  CAST(isoyear(period_start) AS INTEGER) AS iso_year, CAST(week(period_start) AS INTEGER) AS iso_week, CAST(period_start + 6 AS DATE) AS period_end, 'COMPLETE' AS period_status, true AS is_complete_period
FROM w WHERE period_start >= DATE '2024-01-01' AND period_start + 6 <= DATE '2024-01-30'""")


@bind("a_04_weekly_counts", WEEKLY)
def weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.weekly_counts(C.daily_counts(celled(spark, sf_dir), ["cell"]), ["cell"], ["sighting_count", "source_report_count"], START, END)


@bind(
    "a_04_weekly_counts_as_of",
    WEEKLY.replace("'COMPLETE' AS period_status, true AS is_complete_period", "CASE WHEN period_start + 6 <= DATE '2024-01-30' THEN 'COMPLETE' ELSE 'OPEN' END AS period_status, period_start + 6 <= DATE '2024-01-30' AS is_complete_period").replace(
        " AND period_start + 6 <= DATE '2024-01-30'", " AND true"
    ).replace("FROM w WHERE period_start >= DATE '2024-01-01' AND true", "FROM w WHERE period_start >= DATE '2024-01-01'"),
)
def weekly_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.weekly_counts(C.daily_counts(celled(spark, sf_dir), ["cell"]), ["cell"], ["sighting_count", "source_report_count"], START, END, keep_open=True)


@bind(
    "a_05_period_totals",
    """WITH d AS (SELECT CAST(o_orderdate AS DATE) AS period_start, count(*) AS orders FROM orders GROUP BY 1),
days AS (SELECT CAST(x AS DATE) AS period_start FROM generate_series(DATE '1995-01-01', DATE '1996-12-31', INTERVAL 1 DAY) t(x)),
weeks AS (SELECT CAST(x AS DATE) AS period_start FROM generate_series(DATE '1994-12-26', DATE '1996-12-31', INTERVAL 7 DAY) t(x)),
w AS (SELECT CAST(date_trunc('week', period_start) AS DATE) AS period_start, CAST(sum(orders) AS BIGINT) AS orders FROM d GROUP BY 1),
all_ AS (SELECT 'daily' AS frequency, period_start, coalesce(orders, 0) AS orders, 0 AS span FROM days LEFT JOIN d USING (period_start)
  UNION ALL SELECT 'weekly', period_start, coalesce(orders, 0), 6 FROM weeks LEFT JOIN w USING (period_start) WHERE period_start >= DATE '1995-01-01' AND period_start + 6 <= DATE '1996-12-31')
SELECT frequency, period_start, orders, CAST(year(period_start) AS INTEGER) AS year, CAST(dayofyear(period_start) AS INTEGER) AS day_of_year, CAST(isoyear(period_start) AS INTEGER) AS iso_year,
  CAST(week(period_start) AS INTEGER) AS iso_week, CAST(period_start + span AS DATE) AS period_end, 'COMPLETE' AS period_status, true AS is_complete_period FROM all_""",
)
def period_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "orders").groupBy(F.col("o_orderdate").cast("date").alias("period_start")).agg(F.count(F.lit(1)).alias("orders"))
    weeks = days.groupBy(week_start(F.col("period_start")).alias("period_start")).agg(F.sum("orders").alias("orders"))
    out = []
    for frequency, rows in (("daily", days), ("weekly", weeks)):
        calendar = C.periods(spark, date(1995, 1, 1), date(1996, 12, 31), frequency, verified=True)
        out.append(C.fill_calendar(rows, calendar, ["orders"]).withColumn("frequency", F.lit(frequency)))
    return out[0].unionByName(out[1])


@bind("a_06_distinct_counts", "SELECT o_orderstatus, count(DISTINCT o_custkey) AS customers, count(DISTINCT o_orderpriority) AS priorities FROM orders GROUP BY 1")
def distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.countDistinct("o_custkey").alias("customers"), F.countDistinct("o_orderpriority").alias("priorities"))


@bind(
    "j_10_dense_grid",
    with_sightings(f""", x AS (SELECT *, {CELL} AS cell FROM s), u AS (SELECT DISTINCT cell FROM x), d AS (SELECT cell, period_start, count(DISTINCT observation_id) AS sighting_count FROM x GROUP BY ALL),
days AS (SELECT CAST(t AS DATE) AS period_start FROM generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY) g(t))
SELECT cell, period_start, coalesce(sighting_count, 0) AS sighting_count, CASE WHEN coalesce(sighting_count, 0) > 0 THEN 'REPORTED' ELSE 'NO_REPORT' END AS reporting_state
FROM u CROSS JOIN days LEFT JOIN d USING (cell, period_start)"""),
)
def dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = celled(spark, sf_dir)
    calendar = C.periods(spark, START, END, "daily", verified=True).select("period_start")
    grid = C.dense_grid(C.daily_counts(obs, ["cell"]), obs.select("cell").distinct(), calendar, ["sighting_count"], verified=True)
    return grid.withColumn("reporting_state", C.reporting_state(F.col("sighting_count"), F.lit(True)))


@bind(
    "j_08_universe_exclusions",
    with_sightings(f""", x AS (SELECT *, {CELL} AS cell FROM s), u AS (SELECT cell FROM x GROUP BY cell HAVING count(*) >= 205)
SELECT observation_id, cell, 'OUTSIDE_UNIVERSE' AS reason FROM x WHERE cell NOT IN (SELECT cell FROM u)"""),
)
def exclusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = celled(spark, sf_dir)
    cells = obs.groupBy("cell").count().filter("count >= 205")
    return C.split_universe(obs, cells)[1].select("observation_id", "cell", "reason")


@bind(
    "a_22_daily_rolling_mean",
    with_sightings(""", d AS (SELECT period_start, count(*) AS n FROM s GROUP BY 1), days AS (SELECT CAST(t AS DATE) AS period_start FROM generate_series(DATE '2023-12-20', DATE '2024-02-10', INTERVAL 1 DAY) g(t))
SELECT period_start, coalesce(n, 0) AS sightings, round(avg(coalesce(n, 0)) OVER (ORDER BY period_start ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 9) AS rolling_mean FROM days LEFT JOIN d USING (period_start)"""),
)
def rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = sightings(spark, sf_dir).groupBy("period_start").agg(F.count(F.lit(1)).alias("sightings"))
    filled = C.fill_calendar(days, C.periods(spark, date(2023, 12, 20), date(2024, 2, 10), "daily", verified=True).select("period_start"), ["sightings"])
    return filled.withColumn("rolling_mean", F.round(C.rolling_mean(filled, "sightings", "period_start"), 9))


@bind(
    "w_05_trailing_mean_per_source",
    with_sightings(""", d AS (SELECT source, period_start, count(*) AS n FROM s GROUP BY ALL)
SELECT source, period_start, n, round(avg(n) OVER (PARTITION BY source ORDER BY period_start ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 9) AS trailing FROM d"""),
)
def trailing(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = sightings(spark, sf_dir).groupBy("source", "period_start").agg(F.count(F.lit(1)).alias("n"))
    return days.withColumn("trailing", F.round(C.rolling_mean(days, "n", "period_start", 7, ["source"]), 9))


@bind(
    "a_35_weekly_reconciles_with_daily",
    with_sightings(""", d AS (SELECT bucket, CAST(date_trunc('week', period_start) AS DATE) AS period_start, count(*) AS n FROM s GROUP BY ALL),
w AS (SELECT bucket, CAST(date_trunc('week', period_start) AS DATE) AS period_start, count(*) AS n FROM s WHERE observation_id % 997 <> 0 GROUP BY ALL)
SELECT bucket, period_start, d.n AS n_left, w.n AS n_right, 'DIFFERS' AS side FROM d JOIN w USING (bucket, period_start) WHERE d.n <> w.n"""),
)
def reconciles(spark: SparkSession, sf_dir: str) -> DataFrame:
    weekly_of = lambda df: df.groupBy("bucket", week_start(F.col("period_start")).alias("period_start")).agg(F.count(F.lit(1)).alias("n"))
    obs = sightings(spark, sf_dir)
    return C.reconcile(weekly_of(obs), weekly_of(obs.filter("observation_id % 997 <> 0")), ["bucket", "period_start"], ["n"])


@bind("a_20_source_summary", with_sightings("SELECT source, count(*) AS sightings, min(sighting_date) AS first_date, max(sighting_date) AS last_date FROM s GROUP BY 1 ORDER BY 2 DESC, 1"))
def source_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sightings(spark, sf_dir).groupBy("source").agg(F.count(F.lit(1)).alias("sightings"), F.min("sighting_date").alias("first_date"), F.max("sighting_date").alias("last_date"))
    return rows.orderBy(F.desc("sightings"), "source")


@bind(
    "a_21_density_cells",
    with_sightings("""SELECT CAST(floor(lat * 110.574 / 25) AS BIGINT) AS grid_row, CAST(floor(lon * 111.32 * cos(radians(lat)) / 25) AS BIGINT) AS grid_col, count(*) AS sightings FROM s GROUP BY ALL"""),
)
def density(spark: SparkSession, sf_dir: str) -> DataFrame:
    row, col = grid_cell(F.col("lat"), F.col("lon"), 25)
    return sightings(spark, sf_dir).groupBy(row.alias("grid_row"), col.alias("grid_col")).agg(F.count(F.lit(1)).alias("sightings"))


@bind(
    "a_23_crosstab",
    with_sightings("""SELECT source, count(*) FILTER (WHERE bucket = 'SRKW') AS "SRKW", count(*) FILTER (WHERE bucket = 'TRANSIENT') AS "TRANSIENT", count(*) FILTER (WHERE bucket = 'OTHER') AS "OTHER" FROM s GROUP BY 1"""),
)
def crosstab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sightings(spark, sf_dir).groupBy("source").pivot("bucket", ["SRKW", "TRANSIENT", "OTHER"]).count().fillna(0)


@bind(
    "c_40_period_fields",
    """SELECT DISTINCT CAST(o_orderdate AS DATE) AS d, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(dayofyear(o_orderdate) AS INTEGER) AS day_of_year, CAST(isoyear(o_orderdate) AS INTEGER) AS iso_year,
  CAST(week(o_orderdate) AS INTEGER) AS iso_week, CAST(date_trunc('week', o_orderdate) AS DATE) AS monday, CAST(CAST(o_orderdate AS DATE) + 6 AS DATE) AS period_end FROM orders""",
)
def fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("d")).distinct()
    return d.withColumns(period_fields(F.col("d"), "weekly")).withColumn("monday", week_start(F.col("d")))


@bind(
    "c_43_season_features",
    """WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT d, round(sin(2 * pi() * dayofyear(d) / 365.25), 9) AS wave_sin, round(cos(2 * pi() * dayofyear(d) / 365.25), 9) AS wave_cos,
  CASE WHEN month(d) IN (12, 1, 2) THEN 'winter' WHEN month(d) IN (3, 4, 5) THEN 'spring' WHEN month(d) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season,
  CAST(CAST(floor(year(d) / 5) * 5 AS INTEGER) AS VARCHAR) || '-' || CAST(CAST(floor(year(d) / 5) * 5 + 4 AS INTEGER) AS VARCHAR) AS era,
  round(24 / pi() * acos(greatest(-1.0, least(1.0, -tan(radians(48.5)) * tan(radians(23.44) * sin(2 * pi() * (dayofyear(d) - 81) / 365.0))))), 6) AS daylight FROM d""",
)
def seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("d")).distinct()
    s, c = year_wave(F.col("d"))
    return d.select("d", F.round(s, 9).alias("wave_sin"), F.round(c, 9).alias("wave_cos"), season(F.col("d")).alias("season"), era(F.col("d")).alias("era"), F.round(daylight_hours(F.lit(48.5), F.col("d")), 6).alias("daylight"))


@bind("c_39_region_labels", with_sightings("""SELECT CAST(CAST(round_even(lat, 0) AS INTEGER) AS VARCHAR) || ':' || CAST(CAST(round_even(lon, 0) AS INTEGER) AS VARCHAR) AS region, count(*) AS n FROM s GROUP BY 1"""))
def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sightings(spark, sf_dir).groupBy(region_label(F.col("lat"), F.col("lon")).alias("region")).agg(F.count(F.lit(1)).alias("n"))


@bind(
    "c_45_log_features",
    with_sightings("""SELECT observation_id, round(ln(1 + greatest(value, 0)), 9) AS log_value, round(sin(2 * pi() * month(sighting_date) / 12), 9) AS month_sin FROM s"""),
)
def log_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    import math

    return sightings(spark, sf_dir).select(
        "observation_id", F.round(F.log1p(F.greatest("value", F.lit(0.0))), 9).alias("log_value"), F.round(F.sin(2 * math.pi * F.month("sighting_date") / 12), 9).alias("month_sin")
    )


@bind("p_03_date_window", with_sightings("SELECT observation_id, sighting_date FROM s WHERE sighting_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-09'"))
def window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sightings(spark, sf_dir).filter(F.col("sighting_date").between("2024-01-05", "2024-01-09")).select("observation_id", "sighting_date")


@bind("w_06_group_sizes", with_sightings("SELECT observation_id, count(*) OVER (PARTITION BY source, sighting_date) AS group_rows, (SELECT count(DISTINCT t.detail) FROM s t WHERE t.source = s.source AND t.sighting_date = s.sighting_date) AS group_labels FROM s"))
def group_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("source", "sighting_date")
    return sightings(spark, sf_dir).select("observation_id", F.count(F.lit(1)).over(w).alias("group_rows"), F.size(F.collect_set("detail").over(w)).cast("long").alias("group_labels"))
