"""Language identification by prediction by partial matching (operator 3).

For each language a variable-order context tree of bytes (A-Z lower-cased, contexts of up to ORDER bytes) is counted on
a bounded sample of its labelled documents and then frozen. A text is scored by its exact code length in each tree:
escape method C with exclusion, down to a uniform code over the bytes that a language never showed. As the counts are
frozen, the code length of a byte depends on its context alone, so workers expand the trees to one row of code lengths
for each context and a text is a gather and a sum.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldspark.llm.common import crc32_mod, table

ORDER = 3
#: Expected labelled documents of each language that are counted, and the bytes of each that are: the sample's bound.
DOCS_PER_LANGUAGE = 1500
BYTES_PER_SAMPLE = 20_000
UNKNOWN = "und"
#: Rows (a code and a count each) up to which the languages' sizes are broadcast.
FEW_LANGUAGES = 10_000

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def _bytes(text: str) -> bytes:
    return text.encode("utf-8", "replace").translate(_LOWER)


def sample(labelled: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE) -> DataFrame:
    """About ``docs_per_language`` documents of each language, or all: each is taken where a hash falls below a rate."""
    sizes = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("__n"))
    if sizes.count() <= FEW_LANGUAGES:  # else each document meets its language's count in a shuffle
        sizes = F.broadcast(sizes)
    chance = (F.pmod(F.xxhash64(F.lit("langid"), "doc_id", "text"), F.lit(1 << 30)) + 0.5) / float(1 << 30)
    return labelled.join(sizes, "lang").filter(chance * F.col("__n") < docs_per_language).drop("__n")


def count_grams(labelled: DataFrame) -> DataFrame:
    """``lang, gram, n``: how often ORDER bytes of context and a byte (packed in 32 bits) occur, texts led by newlines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by: dict[str, list[bytes]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                by.setdefault(lang, []).append(b"\n" * ORDER + _bytes(text)[:BYTES_PER_SAMPLE])
            for lang, texts in by.items():
                grams = []
                for x in texts:
                    b = np.frombuffer(x, np.uint8).astype(np.uint32)
                    grams.append((b[:-3] << 24) | (b[1:-2] << 16) | (b[2:-1] << 8) | b[3:])
                gram, n = np.unique(np.concatenate(grams), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(gram.astype(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])

    return labelled.select("lang", "text").mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Trees:
    """Frozen trees of all languages: grams and counts by language."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.langs = sorted(counts)
        self.counts = [counts[k] for k in self.langs]
        self.key = hash(tuple((k, int(n.sum()), len(g)) for k, (g, n) in counts.items()))

    @classmethod
    def fit(cls, labelled: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE) -> Trees:
        """Gathers the counts of the bounded sample: at most languages x documents x bytes grams, in practice some 10^5."""
        got = count_grams(sample(labelled.filter("lang is not null and text is not null"), docs_per_language)).toArrow().to_pandas()
        return cls({k: (x["gram"].to_numpy(np.uint32), x["n"].to_numpy(np.float64)) for k, x in got.groupby("lang")})

    def expand(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(class of each byte, row of each context, bits[row, class, language]).

        Bytes that no language showed are one class, which is exact: they have no statistics in any tree.
        """
        seen = np.zeros(256, bool)
        for gram, _ in self.counts:
            for shift in (0, 8, 16, 24):
                seen[np.unique(gram >> shift & 255)] = True
        classes = np.full(256, seen.sum(), np.int64)
        classes[seen] = np.arange(seen.sum())
        a, width = int(seen.sum()) + 1, len(self.counts)
        if not width:
            return classes.astype(np.int32), np.zeros(a**ORDER, np.int32), np.zeros((1, a, 0), np.float32)
        packed = [((classes[g >> 24] * a + classes[g >> 16 & 255]) * a + classes[g >> 8 & 255]) * a + classes[g & 255] for g, _ in self.counts]
        contexts = np.unique(np.concatenate([p // a for p in packed]))
        # Rows: order 2 contexts for what no tree saw at order 3, then the seen order 3 contexts.
        rows = np.arange(a**2, dtype=np.int32)[np.arange(a**3) % a**2]
        rows[contexts] = a**2 + np.arange(len(contexts), dtype=np.int32)
        bits = np.empty((a**2 + len(contexts), a, width), np.float32)
        for k, (p, (_, n)) in enumerate(zip(packed, self.counts, strict=True)):
            low = [np.bincount(p % a ** (o + 1), n, a ** (o + 1)).reshape(-1, a) for o in range(3)]
            high = np.zeros((len(contexts), a))
            np.add.at(high, (np.searchsorted(contexts, p // a), p % a), n)
            two = np.arange(a**2)
            bits[: a**2, :, k] = _bits([low[2], low[1][two % a], low[0][np.zeros(a**2, int)]])
            for s in range(0, len(contexts), 8192):
                c = contexts[s : s + 8192]
                bits[a**2 + s : a**2 + s + len(c), :, k] = _bits([high[s : s + len(c)], low[2][c % a**2], low[1][c % a], low[0][np.zeros(len(c), int)]])
        return classes.astype(np.int32), rows, bits


def _bits(orders: list[np.ndarray]) -> np.ndarray:
    """Code lengths of every class after each context, from counts at falling orders (rows x classes; the last class
    stands for each byte that no language showed)."""
    left = np.ones(orders[0].shape[0])  # probability that is not spent yet
    out = np.zeros(orders[0].shape)
    done = np.zeros(orders[0].shape, bool)
    for counts in orders:
        n = np.where(done, 0.0, counts)
        distinct = (n > 0).sum(axis=1)
        total = n.sum(axis=1) + distinct
        share = np.divide(left, total, out=np.zeros_like(left), where=total > 0)
        out += n * share[:, None]
        left = np.where(total > 0, distinct * share, left)
        done |= n > 0
    unseen = np.maximum(256 - done[:, :-1].sum(axis=1), 1)
    out = np.where(done, out, (left / unseen)[:, None])
    return -np.log2(np.maximum(out, 1e-300))


@lru_cache(maxsize=2)
def _expanded(trees_key: int, box: _Box) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return box.trees.expand()


class _Box:
    """Makes a broadcast tree usable as the cache's argument: equal keys are equal trees."""

    def __init__(self, trees: Trees):
        self.trees = trees

    def __eq__(self, other: object) -> bool:
        return isinstance(other, _Box) and self.trees.key == other.trees.key

    def __hash__(self) -> int:
        return self.trees.key


def code_lengths(text: str, classes: np.ndarray, rows: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Bits of the whole text in each language, in pieces that bound the memory of very long texts."""
    a, total = bits.shape[1], np.zeros(bits.shape[2])
    c = classes[np.frombuffer(b"\n" * ORDER + _bytes(text), np.uint8)]
    for s in range(0, len(c) - ORDER, 1 << 18):
        x = c[s : s + (1 << 18) + ORDER]
        total += bits[rows[(x[:-3] * a + x[1:-2]) * a + x[2:-1]], x[3:]].sum(axis=0, dtype=np.float64)
    return total


_LETTER = regex.compile(r"\p{L}")


def predict(docs: DataFrame, trees: Trees) -> DataFrame:
    """``doc_id, lang_pred, score`` for every document.

    The language of least code length wins, ties by name; ``score`` is its share of the posterior under equal priors.
    Null texts and texts without a letter get ``und`` and score 0, as does every text where no language was learned.
    Repeated rows are predicted alike; an empty table gives no rows; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        classes, rows, bits = _expanded(known.key, _Box(known))
        for batch in batches:
            langs, scores = [], []
            for text in batch.column(1):
                t = text.as_py()
                if not t or not known.langs or not _LETTER.search(t):
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                length = code_lengths(t, classes, rows, bits)
                best = int(length.argmin())
                langs.append(known.langs[best])
                scores.append(float(1 / np.exp2(np.maximum(length[best] - length, -1000)).sum()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc32_mod(F.col("doc_id"), 5) == 0
    trees = Trees.fit(docs.filter(~held_out).select("doc_id", "text", "lang"))
    return predict(docs, trees).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
