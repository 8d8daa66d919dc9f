"""Query façade: a validated request over normalised observations, and the stages behind it."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldspark.functions.geo import Box, degree_cell, repair_coordinates
from fieldspark.functions.policies import ObservationPolicy
from fieldspark.functions.temporal import event_fields, first_date
from fieldspark.operators import counts, entity, quality

AREA = Box(-90.0, 90.0, -180.0, 180.0)
DATE_FORMATS = ["yyyy-MM-dd", "yyyy/MM/dd", "MM/dd/yyyy", "d MMM yyyy"]


@dataclass(frozen=True)
class Request:
    """Window, sources and area of a query; checked when made."""

    start: date
    end: date
    sources: tuple[str, ...] = ()
    box: Box = AREA
    zone: str = "America/Los_Angeles"
    policy: ObservationPolicy = field(default_factory=ObservationPolicy)

    def __post_init__(self) -> None:
        if self.start > self.end:
            raise ValueError("the window ends before it starts")
        if len(set(self.sources)) != len(self.sources):
            raise ValueError("a source is named twice")
        if unknown := set(self.sources) - set(self.policy.source_priority):
            raise ValueError(f"unknown sources: {sorted(unknown)}")
        if not (-90 <= self.box.south < self.box.north <= 90 and -180 <= self.box.west < self.box.east <= 180):
            raise ValueError("the area is no box of latitudes and longitudes")


def normalise(records: DataFrame, request: Request) -> tuple[DataFrame, DataFrame]:
    """Accepted observations and rejected records with the first reason."""
    lat, lon = F.col("latitude_raw").try_cast("double"), F.col("longitude_raw").try_cast("double")
    place = repair_coordinates(lat, lon, request.box, F.upper("source") == "TWM")
    instant = F.try_to_timestamp(F.col("observed_at_raw"))
    fields = event_fields(first_date(F.col("observed_date_raw"), DATE_FORMATS), instant, instant.cast("date"), F.try_to_timestamp(F.col("created_at_raw")), F.lit(None).cast("timestamp"), request.zone)
    rows = records.withColumn("__place", place).withColumns(fields)
    rows = rows.withColumns({"lat": F.col("__place.lat"), "lon": F.col("__place.lon"), "coordinate_transform": F.col("__place.transform")}).drop("__place")
    gates = [
        ("QUARANTINED", F.col("qc_status") == "ACCEPTED"),
        ("NO_DATE", F.col("sighting_date").isNotNull()),
        ("OUTSIDE_WINDOW", F.col("sighting_date").between(F.lit(request.start), F.lit(request.end))),
        ("UNUSABLE_COORDINATES", F.col("lat").isNotNull()),
    ]
    accepted, rejected = quality.split_by_gates(rows, gates)
    facts = entity.evidence(accepted, {"label_raw": True, "description": False, "species": False}, request.policy)
    labels = entity.classify(facts, "GBIF", request.policy)
    labelled = accepted.join(labels, "record_id", "left").withColumn("detail", F.coalesce("detail", F.lit(request.policy.unknown)))
    return labelled.withColumn("bucket", request.policy.bucket(F.col("detail"))), rejected


def query_observations(spark: SparkSession, records: DataFrame, request: Request, *, distance_m: float = 500, minutes: float = 15) -> DataFrame:
    """Observations of a request: normalised, and merged across sources where exactly one group matches wholly."""
    if request.sources:
        records = records.filter(F.col("source").isin(*request.sources))
    accepted, _ = normalise(records, request)
    obs = accepted.withColumn("observation_id", F.col("record_id")).withColumn("event_at", F.when(F.col("time_precision") == "TIMESTAMP", F.col("sighting_at"))).withColumn("rank", request.policy.rank(F.col("source")))
    groups = entity.complete_link_near(obs, ["sighting_date", "sighting_at", "rank", "observation_id"], "string", distance_m=distance_m, minutes=minutes, policy=request.policy)
    first = groups.join(obs, "observation_id").groupBy("group_id")
    order = F.struct(F.col("uncertainty_m").isNull(), F.col("uncertainty_m"), F.col("rank"), F.col("observation_id"))
    return first.agg(
        F.min("sighting_date").alias("sighting_date"),
        F.min_by("detail", F.struct(F.col("detail").isin(*request.policy.open_labels), F.col("rank"), F.col("observation_id"))).alias("detail"),
        F.min_by("lat", order).alias("lat"),
        F.min_by("lon", order).alias("lon"),
        F.array_sort(F.collect_set("source")).alias("sources"),
        F.sum("report_count").alias("source_report_count"),
    ).withColumnRenamed("group_id", "observation_id")


def count_products(obs: DataFrame, request: Request, step_degrees: float = 0.5, verified: bool = False) -> dict[str, DataFrame]:
    """Daily and weekly counts by cell and bucket, and calendar totals."""
    placed = obs.withColumns({"cell": degree_cell(F.col("lat"), F.col("lon"), step_degrees), "period_start": F.col("sighting_date"), "imputation_applied": F.lit(False)})
    placed = placed.withColumn("bucket", request.policy.bucket(F.col("detail")))
    daily = counts.daily_counts(placed, ["cell", "bucket"], counts.expected_contributions(placed))
    measures = [*counts.HARD, *counts.EXPECTED]
    weekly = counts.weekly_counts(daily, ["cell", "bucket"], measures, request.start, request.end)
    days = counts.daily_counts(placed, [])
    calendar = counts.periods(obs.sparkSession, request.start, request.end, "daily", verified)
    totals = counts.fill_calendar(days, calendar, list(counts.HARD))
    return {"daily": daily, "weekly": weekly, "totals": totals.withColumn("reporting_state", counts.reporting_state(F.col("sighting_count"), F.lit(verified)))}
