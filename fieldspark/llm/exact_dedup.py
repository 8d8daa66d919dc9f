"""Exact deduplication against a persistent digest index (operator 8, DataFrame functions only).

The index is a table bucketed and sorted by the SHA-256 digest of the normalised text. New data comes in batches. A batch
is first reduced to one row per digest (partial aggregation runs before the shuffle, so a text that fills a third of the
batch costs one row per task), then admitted by a sort-merge anti-join against the index and appended to it: the index is
read where it lies, sorted and without a shuffle, and never copied.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldspark.llm.common import ascii_lower, scratch, stored, table

#: Batches that the query admits its documents in.
BATCHES = 4


def digest(text: Column) -> Column:
    """SHA-256 (binary) of the text after lower-casing A-Z only; null counts as empty."""
    return F.unhex(F.sha2(ascii_lower(F.coalesce(text, F.lit(""))).cast("binary"), 256))


class DigestIndex:
    """Digests seen so far: ``digest, keep_id, batch`` (the name of the batch that brought it), bucketed and sorted by
    digest in the table ``name``."""

    def __init__(self, spark: SparkSession, name: str | None = None, buckets: int | None = None):
        self.spark = spark
        self.name = name or f"digest_index_{uuid.uuid4().hex}"
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def new(self, batch: DataFrame) -> DataFrame:
        """The rows of ``batch`` whose digest the index does not hold."""
        return batch.join(self.read().select("digest").hint("merge"), "digest", "left_anti") if self.exists() else batch

    def admit(self, batch: DataFrame, name: str) -> None:
        """Appends the rows ``digest, keep_id`` of ``batch`` (one per digest) whose digest is new."""
        fresh = self.new(batch.select("digest", "keep_id")).withColumn("batch", F.lit(name))
        (
            fresh.repartition(self.buckets, "digest")
            .write.format("parquet")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .mode("append")
            .saveAsTable(self.name)
        )


def _batches(own: DataFrame, n: int) -> list[Column]:
    """Conditions that deal rows into ``n`` batches of like size, the largest ids first and null ids last."""
    if n == 1:
        return [F.lit(True)]
    cuts = own.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)])).first()[0] or []
    edges = [None, *sorted(set(cuts), reverse=True), None]
    below = lambda x: F.lit(True) if x is None else F.col("doc_id").isNull() | (F.col("doc_id") <= x)
    above = lambda x: F.lit(True) if x is None else F.col("doc_id") > x
    return [below(high) & above(low) for high, low in zip(edges[:-1], edges[1:], strict=True)]


def deduplicate(docs: DataFrame, index: DigestIndex | None = None, batches: int = 1) -> DataFrame:
    """One row per document: ``doc_id, digest, keep_id, group_size, kept`` and ``fresh``.

    Of equal texts the row with the largest ``doc_id`` stays (a null id is smaller than any other). Repeated rows of one
    ``doc_id`` and text count in ``group_size``, the number of rows of ``docs`` with this text, and exactly one of them
    stays. ``fresh`` is false where an index given by the caller held the digest before; such rows are not kept, and
    ``keep_id`` is the index's. Null and empty texts are equal. An empty table gives no rows. Other columns of ``docs``
    are ignored. More than one batch needs numbers as ids: the largest ids are admitted first, so later batches only
    bring texts that they do not have.
    """
    own = index or DigestIndex(docs.sparkSession)
    with scratch():
        out = stored(_judged(docs, own, batches), "dedup-judged", keep=True)
    if index is None:
        own.drop()
    return out


def _judged(docs: DataFrame, index: DigestIndex, batches: int) -> DataFrame:
    own = docs.select(F.col("doc_id").alias("doc_id"), digest(F.col("text")).alias("digest"))
    same = Window.partitionBy("digest", "doc_id").orderBy(F.lit(0))
    own = stored(own.withColumn("repeat", F.row_number().over(same)), "dedup-digests")
    call = uuid.uuid4().hex
    for k, condition in enumerate(_batches(own, batches)):
        index.admit(own.filter(condition).groupBy("digest").agg(F.max("doc_id").alias("keep_id")), f"{call}-{k}")
    # One row per digest of these documents; hot digests are split where the documents join it.
    sized = own.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"))
    held = index.read().select("digest", "keep_id", F.col("batch").startswith(call).alias("fresh")).hint("merge")
    groups = stored(sized.join(held, "digest"), "dedup-groups")
    kept = F.col("fresh") & F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("repeat") == 1)
    return own.join(groups, "digest").select("doc_id", "digest", "keep_id", "group_size", kept.alias("kept"), "fresh")


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents without their exact copies, with the columns of ``docs``: of equal texts the largest ``doc_id``.

    The text travels through one shuffle by digest and id; copies are dropped by an anti-join with the dropped ids of
    their digest, and repeated rows of one id and text by keeping the first of each.
    """
    keyed = docs.withColumn("__digest", digest(F.col("text")))
    judged = deduplicate(docs.select("doc_id", "text"))
    winners = judged.filter("kept").select(F.col("digest").alias("__digest"), F.col("doc_id").alias("__keep"))
    same = Window.partitionBy("__digest", "doc_id").orderBy(F.lit(0))
    return (
        keyed.join(winners, (keyed["__digest"] == winners["__digest"]) & keyed["doc_id"].eqNullSafe(winners["__keep"]), "left_semi")
        .withColumn("__repeat", F.row_number().over(same))
        .filter("__repeat = 1")
        .drop("__repeat", "__digest")
    )


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = DigestIndex(spark, f"op8_digest_index_{uuid.uuid4().hex}")
    judged = deduplicate(table(spark, sf_dir, "documents").select("doc_id", "text"), index, BATCHES)
    index.drop()
    return judged.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP8_SQL = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h
  FROM documents
)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY h) AS keep_id,
       count(*) OVER (PARTITION BY h) AS group_size,
       row_number() OVER (PARTITION BY h ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       h AS text_sha256
FROM d
"""
