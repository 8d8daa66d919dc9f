"""From raw documents to token ids: toxicity, exact copies, near copies, benchmark leaks, encoding.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last return the columns
of ``documents``; the last returns ``doc_id, n_tokens, ids_sha256, decoded_sha256, ids`` of what is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldspark.llm import bpe, decontaminate, exact_dedup, jaccard_join, toxicity
from fieldspark.llm.common import bound_batches, stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the positive-unlabelled classifier, fitted on these documents and ``labels``, does not reject."""
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for the case of A-Z, the document of largest id."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of least id, of each component of links: five-word shingles, similarity 0.8 or more."""
    return jaccard_join.keep_one(docs, jaccard_join.Similarity(words=5, num=80, den=100))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of ``benchmark``."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with digests of the ids and of the bytes that they decode to."""
    bound_batches(spark)
    return bpe.round_trip(docs, *bpe.default_vocabulary(), with_ids=True, known_words=100_000, chars=1_000_000)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard", drop_near_copies),
    ("decontaminate", drop_leaks),
    ("bpe", encode),
]

#: A fitted classifier, LSH and BPE are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
