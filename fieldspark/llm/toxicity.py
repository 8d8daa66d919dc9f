"""Toxicity by non-negative positive-unlabelled learning (operator 5).

Confirmed toxic documents are the positives, a sample of all training rows is the unlabelled set. A linear model over
the words of a text and their first letters (each counted once a text) is fitted by numpy to the class-prior-corrected
risk  prior * P[loss(+)] + max(0, U[loss(-)] - prior * P[loss(-)]) , with the logistic loss: where the estimate of the
negative risk falls below zero, a step ascends it instead. The score is the model's probability.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldspark.llm.common import crc32_mod, table

#: Bounds of the fitted sample: expected positives and unlabelled documents, each of them whole, and features.
POSITIVES, UNLABELLED, FEATURES = 2500, 5000, 6000
#: Lengths of the word starts that are features beside whole words.
STARTS = (3, 4, 5, 6)
THRESHOLD = 0.3
#: Standard errors by which a feature's shares in positives and unlabelled texts must differ.
SIGNIFICANT = 6.0
KNOWN_WORDS = 100_000

_WORD = re.compile(r"[^\W\d_]+")


def features_of(word: str) -> list[str]:
    return [word, *(f"{word[:k]}*" for k in STARTS if len(word) >= k)]


def _words(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def _features(text: str) -> set[str]:
    return {f for w in _words(text) for f in features_of(w)}


@dataclass
class Model:
    """Weights by feature; ``prior`` is the score of a text without evidence where nothing could be learned."""

    prior: float
    bias: float
    weights: dict[str, float]
    _known: dict[str, tuple] = field(default_factory=dict, repr=False)

    def score(self, text: str) -> float:
        found: set = set()
        for w in _words(text):
            hit = self._known.get(w)
            if hit is None:
                if len(self._known) > KNOWN_WORDS:
                    self._known.clear()
                hit = self._known[w] = tuple((f, self.weights[f]) for f in features_of(w) if f in self.weights)
            if hit:
                found.update(hit)
        z = self.bias + sum(x for _, x in found)
        return float(1 / (1 + np.exp(-min(max(z, -50.0), 50.0))))


def _shares(texts: Sequence[str]) -> dict[str, int]:
    """Texts that hold each feature, for features of two texts or more; single ones are let go as they pile up."""
    counts: Counter = Counter()
    for i, x in enumerate(texts):
        counts.update(_features(x))
        if i % 1000 == 999 and len(counts) > 400_000:
            counts = Counter({f: n for f, n in counts.items() if n > 1})
    return {f: n for f, n in counts.items() if n > 1}


def _z(a: int, n: int, b: int, m: int) -> float:
    """Difference of two shares in pooled standard errors."""
    pooled = (a + b + 1) / (n + m + 2)
    return (a / n - b / m) / float(np.sqrt(pooled * (1 - pooled) * (1 / n + 1 / m)))


def fit_nnpu(positive: Sequence[str], unlabelled: Sequence[str], prior: float, *, rounds: int = 1200, rate: float = 0.5, l1: float = 0.002, beta: float = 0.0) -> Model:
    """Fits the model by proximal AdaGrad; without positives or unlabelled texts every text scores the prior.

    ``l1`` is the share of the positives that a feature must explain to get a weight.
    """
    prior = min(max(prior, 1e-4), 0.9)
    flat = float(np.log(prior / (1 - prior)))
    if not positive or not unlabelled:
        return Model(prior, flat, {})
    p, u = _shares(positive), _shares(unlabelled)
    np_, nu = len(positive), len(unlabelled)
    z = {f: x for f in p.keys() | u.keys() if abs(x := _z(p.get(f, 0), np_, u.get(f, 0), nu)) >= SIGNIFICANT}
    del p, u
    number = {f: i for i, f in enumerate(sorted(sorted(z), key=lambda f: -abs(z[f]))[:FEATURES])}

    def sparse(docs: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [np.array([number[f] for f in _features(x) if f in number], np.int32) for x in docs]
        return np.repeat(np.arange(len(found)), [len(x) for x in found]), np.concatenate(found)

    (pd_, pf), (ud, uf) = sparse(positive), sparse(unlabelled)
    w, b = np.zeros(len(number)), flat
    seen = np.full(len(number) + 1, 1e-8)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -50, 50)))
    for _ in range(rounds):
        zp = b + np.bincount(pd_, w[pf], np_)
        zu = b + np.bincount(ud, w[uf], nu)
        sp, su = sigmoid(zp), sigmoid(zu)
        negative = np.mean(np.logaddexp(0, zu)) - prior * np.mean(np.logaddexp(0, zp))
        # d loss(+)/dz = s - 1, d loss(-)/dz = s
        gp, gu = -prior * sp / np_, su / nu
        if negative < -beta:
            gp, gu = -gp, -gu
        else:
            gp = gp + prior * (sp - 1) / np_
        g = np.bincount(pf, gp[pd_], len(number)) + np.bincount(uf, gu[ud], len(number))
        gb = gp.sum() + gu.sum()
        seen += np.append(g, gb) ** 2
        step = rate / np.sqrt(seen)
        w = w - step[:-1] * g
        w = np.sign(w) * np.maximum(np.abs(w) - step[:-1] * l1 * prior, 0)
        b -= step[-1] * gb
    return Model(prior, float(b), {f: float(w[i]) for f, i in number.items() if abs(w[i]) > 1e-6})


def _chance(*columns: str) -> Column:
    return (F.pmod(F.xxhash64(F.lit("nnpu"), *columns), F.lit(1 << 30)) + 0.5) / float(1 << 30)


def train(docs: DataFrame, labels: DataFrame, *, positives: int = POSITIVES, unlabelled: int = UNLABELLED, prior: float | None = None) -> Model:
    """Fits a model on ``docs`` (doc_id, text) and the rows of ``labels`` (doc_id, toxic) that may be learned from.

    A document is a confirmed positive if a label row marks it toxic. The prior is the toxic share of the labelled
    documents unless given. The sample is taken by hash at rates that make its expected size the bounds given. Its texts
    are read whole: each comes to the driver as its distinct words, which have the same features as the text.
    """
    known = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n, toxic = known.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.when(F.col("toxic") == 1, 1)), F.lit(0))).first()
    total = docs.count()
    if not n or not total:
        return Model(prior or 0.5, 0.0, {})
    prior = prior if prior is not None else toxic / n
    marked = known.filter("toxic = 1").select("doc_id")

    @F.arrow_udf("string")
    def words(texts: pa.Array) -> pa.Array:
        return pa.array([" ".join(sorted(_words(x.as_py() or ""))) for x in texts], pa.string())

    some = marked.filter(_chance("doc_id") * F.lit(max(toxic, 1)) < positives)
    p = docs.join(F.broadcast(some), "doc_id", "left_semi").select("text")
    # The unlabelled sample stands for all documents, confirmed ones included: the prior is its share of positives.
    u = docs.filter(_chance("doc_id", "text") * F.lit(total) < unlabelled).select("text")
    both = p.withColumn("p", F.lit(True)).union(u.withColumn("p", F.lit(False)))
    rows = both.select("p", words(F.col("text")).alias("text")).toArrow().to_pandas().sort_values(["p", "text"])
    return fit_nnpu(list(rows["text"][rows["p"]]), list(rows["text"][~rows["p"]]), prior)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` for every whole text; null and empty texts score by the bias alone.

    Repeated rows score alike; an empty table gives no rows; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            scores = [m.score(x.as_py() or "") for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def _may_learn(doc_id: str = "doc_id") -> Column:
    return crc32_mod(F.col(doc_id), 4) != 2


def fit_tables(docs: DataFrame, labels: DataFrame) -> Model:
    """The query's model: labels and texts of rows whose crc32 remainder is not 2."""
    return train(docs.filter(_may_learn()).select("doc_id", "text"), labels.filter(_may_learn()).select("doc_id", "toxic"))


def clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below the threshold, with their columns."""
    model = fit_tables(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    # Only texts go to Python and only scores come back; the rows wait in the JVM.
    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        m = shared.value
        return pa.array([m.score(x.as_py() or "") for x in texts], pa.float64())

    return docs.filter(scored(F.col("text")) < threshold)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_tables(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id", (~_may_learn()).alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted")
    )
