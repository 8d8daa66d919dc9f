"""The report of an observations table: sources, days and density, as one small document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldspark.functions.geo import degree_cell, map_zoom
from fieldspark.operators.quality import require

REQUIRED = ("observation_id", "sighting_date", "lat", "lon", "source")
#: Cells and days that the document holds, most observations first and latest first: a report, not a table.
MOST_CELLS, MOST_DAYS = 5000, 20_000


def checked(obs: DataFrame) -> DataFrame:
    """The report's columns; raises where one is missing, a date is null, an id repeats, or nothing is there."""
    if missing := [c for c in REQUIRED if c not in obs.columns]:
        raise ValueError(f"missing columns: {missing}")
    rows = obs.select(*REQUIRED)
    require(rows.filter("sighting_date is null or observation_id is null"), "rows without id or date")
    require(rows.groupBy("observation_id").count().filter("count > 1"), "repeated ids")
    if rows.isEmpty():
        raise ValueError("there are no observations")
    return rows


def build(obs: DataFrame, step_degrees: float = 0.25) -> dict:
    """Aggregates are made by executors; the driver gets sources, days and cells."""
    rows = checked(obs)
    sources = rows.groupBy("source").agg(F.count(F.lit(1)).alias("observations"), F.min("sighting_date").alias("first"), F.max("sighting_date").alias("last")).orderBy(F.desc("observations"), "source")
    days = rows.groupBy("sighting_date").agg(F.count(F.lit(1)).alias("observations")).orderBy(F.desc("sighting_date")).limit(MOST_DAYS)
    cell = degree_cell(F.col("lat"), F.col("lon"), step_degrees)
    cells = rows.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("observations"), F.avg("lat").alias("lat"), F.avg("lon").alias("lon")).orderBy(F.desc("observations"), "cell").limit(MOST_CELLS)
    span = F.greatest(F.max("lat") - F.min("lat"), F.max("lon") - F.min("lon"))
    extent = rows.agg(F.count(F.lit(1)).alias("observations"), F.avg("lat").alias("lat"), F.avg("lon").alias("lon"), map_zoom(span).alias("zoom")).first().asDict()
    return {"extent": extent, "sources": [r.asDict() for r in sources.collect()], "days": [r.asDict() for r in days.collect()][::-1], "cells": [r.asDict() for r in cells.collect()]}
