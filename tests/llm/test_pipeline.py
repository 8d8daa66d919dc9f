"""The pipeline's stages against brute force on a small corpus, and its contract."""

from __future__ import annotations

import random

import corpus_pipeline
import pytest

from tests.llm.test_llm import brute_components, edited, lower, text_of


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(11)
    at = tmp_path_factory.mktemp("tables")
    items = [(k, text_of(rng, 40)) for k in range(5)]
    docs = [(i, text_of(rng, 80)) for i in range(150)]
    toxic = {i for i in range(0, 150, 6)}
    docs = [(i, f"{t} vilest" if i in toxic else t) for i, t in docs]
    docs += [(200 + i, docs[i][1].upper()) for i in range(1, 21)]
    docs += [(300 + i, edited(rng, docs[i][1], 1)) for i in range(31, 51)]
    docs += [(400 + i, f"{text_of(rng, 20)} {items[i % 5][1]} {text_of(rng, 20)}") for i in range(10)]
    docs += [(500, None), (501, "")]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(150)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return str(at)


def test_stages(spark, folder):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "ngram_jaccard", "decontaminate", "bpe"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, folder), f"test-{name}")
        assert docs.columns == columns
        left = {r["doc_id"]: r["text"] for r in docs.collect()}
        gone = rows.keys() - left.keys()
        if name == "toxicity":
            assert {i for i, t in rows.items() if "vilest" in lower(t)} <= gone and len(gone) <= 60
        if name == "exact_dedup":
            best = {}
            for i, t in rows.items():
                best[lower(t)] = max(i, best.get(lower(t), i))
            assert left.keys() == set(best.values())
        if name == "ngram_jaccard":
            parts = brute_components(sorted(rows.items()), 5, 80, 100)
            assert left.keys() == {d for d, n, c in parts if n == 0 or d == c}
        if name == "decontaminate":
            assert gone == {i for i in rows if 400 <= i < 410}
        rows = left
    last = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert {r["doc_id"] for r in last.collect()} == rows.keys()


def test_run(spark, folder):
    assert corpus_pipeline.run(spark, folder).count() > 0
