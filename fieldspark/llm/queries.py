"""The queries of this subpackage and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fieldspark.llm import bpe, decontaminate, exact_dedup, jaccard_join, katz, langid, pii, sharding, toxicity, urlfilter


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_bpe": bpe.op1_bpe,
        "op2_sharding": sharding.op2_sharding,
        "op3_language_id": langid.op3_language_id,
        "op4_url_filter": urlfilter.op4_url_filter,
        "op5_toxicity": toxicity.op5_toxicity,
        "op6_pii": pii.op6_pii,
        "op7_katz": katz.op7_katz,
        "op8_exact_dedup": exact_dedup.op8_exact_dedup,
        "op9_decontaminate": decontaminate.op9_decontaminate,
        "op10_ngram_jaccard": jaccard_join.op10_ngram_jaccard,
    }


def oracle_sql() -> dict[str, str]:
    return {"op4_url_filter": urlfilter.OP4_SQL, "op8_exact_dedup": exact_dedup.OP8_SQL, "op10_ngram_jaccard": jaccard_join.OP10_SQL}
