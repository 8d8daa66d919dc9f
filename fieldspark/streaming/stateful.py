"""Streams: landing folders read as events, windows with late data, and incremental state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from fieldspark.operators import cdc
from fieldspark.sources.sinks import exists


def read_events(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int = 100) -> DataFrame:
    """Parquet files as they land."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def windowed_counts(events: DataFrame, keys: list[str], *, at: str = "ts", width: str = "1 day", slide: str | None = None, lateness: str = "2 days") -> DataFrame:
    """Counts by event-time window and key; rows later than the watermark are left out, closed windows are emitted."""
    timed = events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, lateness)
    window = F.window(at, width, slide) if slide else F.window(at, width)
    counted = timed.groupBy(window, *keys).agg(F.count(F.lit(1)).alias("events"), F.sum("value").alias("value"))
    return counted.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *keys, "events", "value")


def sessions(events: DataFrame, key: str, *, at: str = "ts", gap: str = "30 minutes", lateness: str = "2 days") -> DataFrame:
    """Sessions of each key: events no more than the gap apart."""
    timed = events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, lateness)
    by = timed.groupBy(F.session_window(at, gap), key).agg(F.count(F.lit(1)).alias("events"))
    return by.select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), key, "events")


def first_seen_only(events: DataFrame, key: str, *, at: str = "ts", lateness: str = "2 days") -> DataFrame:
    """Drops repeats of a key within the watermark; state older than it is let go."""
    return events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, lateness).dropDuplicatesWithinWatermark([key])


def upsert_history(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends payload transitions of each micro-batch to the history at ``path``.

    The batch is compared with the persisted history, and the anti-join on record, retrieval and checksum makes a batch
    that is replayed after a failure add nothing: effects are exactly once.
    """

    def apply(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        batch = cdc.with_checksum(batch)
        # The first batch has no folder yet; any other failure to read the history is an error.
        history = spark.read.schema(batch.schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], batch.schema)
        cdc.transitions(batch, history).select(*batch.columns).write.mode("append").parquet(path)

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_to_parquet(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Runs a stream over all that has landed and stops; files are committed once each."""
    return stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
