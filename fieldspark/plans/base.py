"""Tables and derived views that the bound queries share, with the same views as DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LABELS = {"view": "UNKNOWN", "click": "SRKW", "purchase": "TRANSIENT", "signup": "OFFSHORE", "error": "MIXED"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations derived from ``events``: six sources, five labels, coordinates from the id, quarter masses."""
    label = F.lit(None).cast("string")
    for k, v in LABELS.items():
        label = F.when(F.col("event_type") == k, v).otherwise(label)
    e = table(spark, sf_dir, "events")
    q = F.col("event_id") % 4
    rows = e.select(
        F.col("event_id").alias("observation_id"),
        F.col("ts").cast("date").alias("sighting_date"),
        F.col("ts").alias("event_at"),
        (F.col("user_id") % 6).cast("int").alias("source"),
        F.col("user_id").alias("user_id"),
        label.alias("detail"),
        (F.lit(47.0) + (F.col("event_id") * 7919 % 3000) / F.lit(1000.0)).alias("lat"),
        (F.lit(-125.0) + (F.col("event_id") * 104729 % 4000) / F.lit(1000.0)).alias("lon"),
        F.col("value").alias("value"),
        F.col("props").alias("payload"),
        (1 + F.col("event_id") % 3).cast("int").alias("source_report_count"),
        (F.col("event_id") % 11 == 0).alias("imputation_applied"),
        (q / 4.0).alias("expected_srkw"),
        ((3 - q) / 4.0).alias("expected_transient"),
        F.when(F.col("event_id") % 5 == 0, 0.25).otherwise(0.0).alias("expected_unknown"),
        F.when(F.col("event_id") % 5 == 0, 0.0).otherwise(0.25).alias("expected_other"),
        F.when(F.col("ts") >= F.lit("2024-01-25").cast("timestamp"), "PROVISIONAL_RECENT").otherwise("MATURE_RETROSPECTIVE").alias("context_status"),
    )
    bucket = F.when(F.col("detail").isin("SRKW", "TRANSIENT"), F.col("detail")).otherwise("OTHER")
    return rows.withColumn("bucket", bucket).withColumn("period_start", F.col("sighting_date"))


SIGHTINGS = """s AS (
  SELECT event_id AS observation_id, CAST(ts AS DATE) AS sighting_date, ts AS event_at, CAST(user_id % 6 AS INTEGER) AS source, user_id,
    CASE event_type WHEN 'view' THEN 'UNKNOWN' WHEN 'click' THEN 'SRKW' WHEN 'purchase' THEN 'TRANSIENT' WHEN 'signup' THEN 'OFFSHORE' WHEN 'error' THEN 'MIXED' END AS detail,
    CASE event_type WHEN 'click' THEN 'SRKW' WHEN 'purchase' THEN 'TRANSIENT' ELSE 'OTHER' END AS bucket,
    CAST(47.0 AS DOUBLE) + (event_id * 7919 % 3000) / CAST(1000.0 AS DOUBLE) AS lat, CAST(-125.0 AS DOUBLE) + (event_id * 104729 % 4000) / CAST(1000.0 AS DOUBLE) AS lon,
    value, props AS payload, CAST(1 + event_id % 3 AS INTEGER) AS source_report_count, event_id % 11 = 0 AS imputation_applied,
    (event_id % 4) / CAST(4.0 AS DOUBLE) AS expected_srkw, (3 - event_id % 4) / CAST(4.0 AS DOUBLE) AS expected_transient,
    CAST(CASE WHEN event_id % 5 = 0 THEN 0.25 ELSE 0.0 END AS DOUBLE) AS expected_unknown, CAST(CASE WHEN event_id % 5 = 0 THEN 0.0 ELSE 0.25 END AS DOUBLE) AS expected_other,
    CASE WHEN ts >= TIMESTAMP '2024-01-25' THEN 'PROVISIONAL_RECENT' ELSE 'MATURE_RETROSPECTIVE' END AS context_status,
    CAST(ts AS DATE) AS period_start
  FROM events)"""


def with_sightings(sql: str) -> str:
    """A query over the view ``s``; further views may lead it, separated by commas."""
    return f"WITH {SIGHTINGS}{sql if sql.lstrip().startswith(',') else ' ' + sql}"


#: Great-circle kilometres between aliases a and b, as SQL.
HAVERSINE = (
    "2 * 6371.0088 * asin(least(1.0, sqrt(power(sin((radians(b.lat) - radians(a.lat)) / 2), 2)"
    " + cos(radians(a.lat)) * cos(radians(b.lat)) * power(sin((radians(b.lon) - radians(a.lon)) / 2), 2))))"
)
