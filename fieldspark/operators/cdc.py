"""Source history, corrections and current state from repeated snapshots.

Rows carry ``record_id``, ``source``, ``retrieval_id``, ``retrieved_at`` and ``payload``; equality of payloads is
equality of their digests.
"""

from __future__ import annotations

import hashlib
import json
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ORDER = ("retrieved_at", "retrieval_id", "arrival")


def with_checksum(rows: DataFrame) -> DataFrame:
    return rows.withColumn("checksum", F.sha2("payload", 256))


def last_known(history: DataFrame) -> DataFrame:
    """Last checksum of each record: a partial aggregate, no sort."""
    return history.groupBy("record_id").agg(F.max_by("checksum", F.struct("retrieved_at", "retrieval_id")).alias("known"))


def transitions(batch: DataFrame, history: DataFrame) -> DataFrame:
    """Rows of the batch whose payload differs from the one before: in the batch, else the last persisted one.

    Rows that the history holds already (record, retrieval and checksum) are left out, so that a batch can be replayed.
    """
    before = Window.partitionBy("record_id").orderBy(*ORDER)
    seen = batch.withColumn("__lag", F.lag("checksum").over(before)).join(last_known(history), "record_id", "left")
    changed = seen.filter(~F.col("checksum").eqNullSafe(F.coalesce("__lag", "known"))).drop("__lag", "known")
    return changed.join(history.select("record_id", "retrieval_id", "checksum"), ["record_id", "retrieval_id", "checksum"], "left_anti")


def corrections(history: DataFrame) -> DataFrame:
    """Per record: whether its payload ever changed, when it last did (else when it was first seen), and its versions."""
    before = Window.partitionBy("record_id").orderBy(*ORDER)
    flagged = history.withColumn("__changed", F.coalesce(F.col("checksum") != F.lag("checksum").over(before), F.lit(False)))
    return flagged.groupBy("record_id").agg(
        F.max("__changed").alias("corrected"),
        F.coalesce(F.max(F.when(F.col("__changed"), F.col("retrieved_at"))), F.min("retrieved_at")).alias("last_corrected_at"),
        F.countDistinct("checksum").alias("versions"),
    )


def latest(rows: DataFrame, prefer: Column | None = None) -> DataFrame:
    """The last row of each record; at one retrieval time ``prefer`` decides, then the later arrival."""
    order = [F.desc("retrieved_at"), F.desc(prefer if prefer is not None else F.lit(0)), F.desc("retrieval_id"), F.desc("arrival")]
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy("record_id").orderBy(*order))).filter("__n = 1").drop("__n")


def not_from_file(payload: Column) -> Column:
    """1 for rows of an API, 0 for those of a bulk file."""
    return (F.instr(payload, '"_source_file":') == 0).cast("int")


def merge(prior: DataFrame, incoming: DataFrame, full_sources: list) -> DataFrame:
    """Current state: sources in ``full_sources`` are replaced by the batch, the others upserted by record.

    A source without rows in the batch keeps its state.
    """
    replaced = incoming.filter(F.col("source").isin(*full_sources)).select("source").distinct() if full_sources else None
    kept = prior.join(F.broadcast(replaced), "source", "left_anti") if replaced is not None else prior
    return latest(kept.unionByName(incoming), not_from_file(F.col("payload")))


def first_seen(current: DataFrame, prior: DataFrame) -> DataFrame:
    """Keeps the prior retrieval time of records whose payload did not change."""
    was = prior.select("record_id", F.col("checksum").alias("__c"), F.col("retrieved_at").alias("__t"))
    same = F.col("checksum").eqNullSafe(F.col("__c"))
    return current.join(was, "record_id", "left").withColumn("retrieved_at", F.when(same, F.col("__t")).otherwise(F.col("retrieved_at"))).drop("__c", "__t")


def update_audit(batch: DataFrame) -> DataFrame:
    """Records that a batch holds more than once: UPDATED if payloads differ, else NO_OP."""
    many = batch.groupBy("record_id").agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("checksum").alias("versions")).filter("rows > 1")
    return many.withColumn("status", F.when(F.col("versions") > 1, "UPDATED").otherwise("NO_OP"))


def changed_against(current: DataFrame, prior: DataFrame) -> DataFrame:
    """Records of both states whose payloads differ."""
    return current.alias("c").join(prior.alias("p"), "record_id").filter("c.checksum <> p.checksum").select("record_id", F.col("p.checksum").alias("before"), F.col("c.checksum").alias("after"))


def fingerprint(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row that is equal for equal multisets of rows: their number and two sums of row hashes."""
    values = [F.col(c).cast("string") for c in sorted(columns)]
    one = F.xxhash64(F.lit(0), *values).cast("decimal(38,0)")
    two = F.xxhash64(F.lit(1), *values).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sum(one).alias("hash_1"), F.sum(two).alias("hash_2"))


def refuse_older(batch: DataFrame, state: DataFrame) -> None:
    """Raises if a source's batch is older than its state: one row per source is looked at."""
    newest = lambda df, name: df.groupBy("source").agg(F.max("retrieved_at").alias(name))
    late = newest(batch, "now").join(newest(state, "was"), "source").filter("now < was").limit(1).collect()
    if late:
        raise ValueError(f"snapshot of source {late[0]['source']} is older than its state")


def next_start(minimum: date, watermark: date | None, overlap_days: int) -> date:
    """First day of the next collection: the last watermark less an overlap, no earlier than the minimum."""
    return minimum if watermark is None else max(minimum, watermark - timedelta(days=overlap_days))


def coverage(sources: DataFrame) -> DataFrame:
    """Intersection of the sources' intervals (``start, end, verified``), and whether all are verified and overlap."""
    both = sources.agg(F.max("start").alias("start"), F.min("end").alias("end"), F.min("verified").alias("verified"))
    return both.withColumn("overlaps", F.col("start") <= F.col("end")).withColumn("verified", F.col("verified") & F.col("overlaps"))


def behind_watermark(published: DataFrame, end: date) -> DataFrame:
    """Sources whose published ``watermark`` lies after ``end``: a window that ends before it is out of order."""
    return published.filter(F.col("watermark") > F.lit(end))


def scope_hash(source: object, area: object, start: date) -> str:
    """Digest of a source's settings, area and first day. The last day moves on and is not part of it; another scope
    restarts the history."""
    body = {"source": source, "full_area": area, "start": start.isoformat()}
    return hashlib.sha256(json.dumps(body, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def snapshot_mode(has_state: Column) -> Column:
    """FULL_REPLACE for a first collection, then DELTA_UPSERT: completeness of a query does not prove deletions."""
    return F.when(has_state, "DELTA_UPSERT").otherwise("FULL_REPLACE")
