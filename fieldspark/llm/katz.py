"""Katz back-off language model over words (operator 7).

    p(w | h) = d(c(h, w)) c(h, w) / c(h)   if c(h, w) >= CUTOFF,   else   alpha(h) p(w)

Good-Turing discounts d come from the counts of counts at each level; alpha(h) spreads what the kept words of h leave
over the words that h does not keep, so that each distribution sums to one over the known words, the end and one
unknown word. p(w) is the level below: discounted unigrams, whose left mass is the unknown word's.

Counts of bigrams are as large as the corpus. They travel packed: documents are cut into parts of PART bytes. For the
counts of words, a part sends its distinct words as sorted arrays by range of their hash; a range adds them up and answers
each part in the order that it asked. For the model, parts send their training pairs by range of the history's hash, and a
range's sums are stored as a row of a table bucketed by range. For scores, parts ask the stored table for their pairs and
histories, a pair once however often they hold it, and go from the pair to the word below token by token. A pair costs
some eight bytes in one shuffle. Words and pairs are told apart by 64-bit hashes. Pairs of words that make up more than
1 / HOT of the tokens, or a range's share of them, are dealt by the pair instead of by their first word, and their sums put
together afterwards, so no range grows with one word.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldspark.llm.common import bucketed, crc32_mod, partitions_of, scratch, stored, table
from fieldspark.llm.words import gathered, hash_words, mix, parts

#: Bytes of text in a part, tokens for which there is one range, and the counts that are discounted.
PART, TOKENS_PER_RANGE, DISCOUNTED = 16_000_000, 1_500_000, 5
#: Pairs seen less often back off (their mass goes to the back-off weight): all counted pairs are kept.
CUTOFF = 1
HOT = 1000
END, START = np.uint64(0x2545F4914F6CDD1D), np.uint64(0x9E6C63D0676A9A99)

#: A pair's second word travels as the upper 48 bits of its hash: among a million words after one history, the chance
#: that two share them is below 0.2 %.
WORD_BYTES = 6

_pack = lambda x: zstandard.ZstdCompressor(level=1).compress(_planes(np.ascontiguousarray(x)))


def _planes(x: np.ndarray) -> bytes:
    """Bytes of equal weight side by side, which compress better."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def _short(words: np.ndarray) -> bytes:
    return np.ascontiguousarray(words.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 8 - WORD_BYTES :]).tobytes()


def _long(data: bytes) -> np.ndarray:
    """The hashes without their lower bits."""
    short = np.frombuffer(data, np.uint8).reshape(-1, WORD_BYTES)
    out = np.zeros((len(short), 8), np.uint8)
    out[:, 8 - WORD_BYTES :] = short
    return out.reshape(-1).view("<u8").astype(np.uint64)


def _unpack(data: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).reshape(-1).view(kind)


@dataclass(frozen=True)
class Level:
    """Discounts of one n-gram level: ``d[r]`` for counts up to DISCOUNTED, 1 beyond."""

    d: tuple[float, ...]

    @classmethod
    def of(cls, spectrum: list[int]) -> Level:
        """From n_1 .. n_(DISCOUNTED + 1). Where Good-Turing gives no discount between 0 and 1, half a count goes."""
        n = [0, *spectrum]
        k = DISCOUNTED
        common = (k + 1) * n[k + 1] / n[1] if n[1] else 1.0
        d = [1.0]
        for r in range(1, k + 1):
            x = ((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common) if n[r] and common < 1 else 0.0
            d.append(x if 0 < x < 1 else 1 - 0.5 / r)
        return cls(tuple(d))

    def apply(self, counts: np.ndarray) -> np.ndarray:
        d = np.array([*self.d, 1.0])
        return d[np.minimum(counts, DISCOUNTED + 1)]


@dataclass(frozen=True)
class Unigrams:
    """Totals of the training tokens, and p(w) as a function of a word's count."""

    tokens: int
    words: int
    documents: int
    level: Level
    kept: float

    @property
    def unknown(self) -> float:
        """Probability of the unknown word: the mass that discounting leaves, half a token's at least."""
        return max(1 - self.kept / self.tokens, 0.5 / (self.tokens + 1)) if self.tokens else 1.0

    def p(self, counts: np.ndarray) -> np.ndarray:
        known = self.level.apply(counts) * counts * ((1 - self.unknown) / self.kept if self.kept else 0.0)
        return np.where(counts > 0, known, self.unknown)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.1) / (self.tokens + 0.1 * (self.words + 1)))


def cut_into_parts(docs: DataFrame) -> DataFrame:
    """Parts of ``doc_id, text, held_out``: token codes, the words that they stand for (most frequent first) and their
    counts in training documents."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where = TaskContext.get().partitionId()
        for n, part in enumerate(parts(gathered(batches, 1, PART), 1, PART)):
            words, offsets = hash_words(part.column(1))
            sizes = np.diff(offsets) + 1
            tokens = np.full(len(words) + len(sizes), END, np.uint64)
            inside = np.ones(len(tokens), bool)
            inside[np.cumsum(sizes) - 1] = False
            tokens[inside] = words
            train = ~part.column(2).to_numpy(zero_copy_only=False).astype(bool)
            names, code, times = np.unique(tokens, return_inverse=True, return_counts=True)
            order = np.argsort(-times, kind="stable")
            place = np.empty(len(order), np.uint32)
            place[order] = np.arange(len(order), dtype=np.uint32)
            code = place[code]
            count = np.bincount(code, np.repeat(train, sizes), len(names)).astype(np.uint32)
            row = {
                "part": pa.array([where << 24 | n], pa.int64()),
                "ids": pa.array([part.column(0).to_pylist()], pa.list_(part.column(0).type)),
                "train": pa.array([np.packbits(train).tobytes()], pa.binary()),
                "sizes": pa.array([_pack(sizes.astype(np.uint32))], pa.binary()),
                "codes": pa.array([_pack(code)], pa.binary()),
                "words": pa.array([names[order].tobytes()], pa.binary()),
                "counts": pa.array([_pack(count)], pa.binary()),
                "tokens": pa.array([len(tokens)], pa.int64()),
                "train_tokens": pa.array([int(count.sum())], pa.int64()),
                "train_documents": pa.array([int(train.sum())], pa.int64()),
            }
            yield pa.RecordBatch.from_arrays(list(row.values()), names=list(row))

    schema = f"part long, ids array<{kind}>, train binary, sizes binary, codes binary, words binary, counts binary, tokens long, train_tokens long, train_documents long"
    return docs.mapInArrow(run, schema)


def _range_of(h: np.ndarray, ranges: int) -> np.ndarray:
    return ((h >> np.uint64(33)).astype(np.int64) * ranges) >> 31


def _rows(names: list[str], rows: list[tuple], types: list[pa.DataType]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
    return pa.table({n: pa.array(c, t) for n, c, t in zip(names, columns, types, strict=True)})


#: Answers to a part about a range: ``counts`` in order of the question, and the weights of the histories.
ANSWER = "part long, range int, about string, counts binary, weights binary"
_ANSWER = (["part", "range", "about", "counts", "weights"], [pa.int64(), pa.int32(), pa.string(), pa.binary(), pa.binary()])
#: Part -1 of a range has what it adds to the corpus: the spectrum n_1.. and number of its words, and its hot words.
_WORDS = ([*_ANSWER[0], "spectrum", "hot"], [*_ANSWER[1], pa.list_(pa.int64()), pa.list_(pa.struct([("word", pa.int64())]))])


def _spectrum(totals: np.ndarray) -> np.ndarray:
    return np.bincount(np.minimum(totals, DISCOUNTED + 2), minlength=DISCOUNTED + 3)[1 : DISCOUNTED + 2].astype(np.int64)


def count_words(cut: DataFrame, ranges: int, hot_from: int) -> DataFrame:
    """Answers with the training count of each word of each part, and about the corpus; hot words have at least
    ``hot_from`` tokens."""

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, words, counts in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                words, counts = np.frombuffer(words, np.uint64), _unpack(counts, np.uint32)
                at = _range_of(words, ranges)
                order = np.argsort(at, kind="stable")
                cuts = np.searchsorted(at[order], np.arange(ranges + 1))
                rows = [(part, r, words[order[a:b]].tobytes(), _pack(counts[order[a:b]])) for r, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
                yield from _rows(["part", "range", "words", "counts"], rows, [pa.int64(), pa.int32(), pa.binary(), pa.binary()]).to_batches()

    def add(group: pa.Table) -> pa.Table:
        lists = [np.frombuffer(x, np.uint64) for x in group["words"].to_pylist()]
        given = np.concatenate([_unpack(x, np.uint32) for x in group["counts"].to_pylist()])
        word, which = np.unique(np.concatenate(lists), return_inverse=True)
        totals = np.bincount(which, given, len(word)).astype(np.int64)
        answers = np.split(totals[which].astype(np.uint32), np.cumsum([len(x) for x in lists])[:-1])
        r = group["range"][0].as_py()
        rows = [(p, r, "words", _pack(x), None, None, None) for p, x in zip(group["part"].to_pylist(), answers, strict=True)]
        hot = [{"word": int(x)} for x in word[totals >= hot_from].view(np.int64)]
        rows.append((-1, r, "corpus", None, None, [*_spectrum(totals).tolist(), int((totals > 0).sum())], hot))
        return _rows(_WORDS[0], rows, _WORDS[1])

    asked = cut.select("part", "words", "counts").mapInArrow(ask, "part long, range int, words binary, counts binary")
    return asked.groupBy("range").applyInArrow(add, f"{ANSWER}, spectrum array<long>, hot array<struct<word: long>>")


class _Part:
    """A part with the counts of its words: tokens, histories and distinct pairs in order of (history, word)."""

    def __init__(self, row: dict, answers: list[dict], ranges: int):
        self.ids, self.part = row["ids"], row["part"]
        self.sizes = _unpack(row["sizes"], np.uint32).astype(np.int64)
        self.train = np.unpackbits(np.frombuffer(row["train"], np.uint8), count=len(self.sizes)).astype(bool)
        self.codes = _unpack(row["codes"], np.uint32).astype(np.int64)
        self.words = np.frombuffer(row["words"], np.uint64)
        at = _range_of(self.words, ranges)
        order = np.argsort(at, kind="stable")
        self.counts = np.zeros(len(self.words) + 1, np.int64)
        if len(order):
            by_range = {a["range"]: a["counts"] for a in answers if a["about"] == "words"}
            self.counts[order] = np.concatenate([_unpack(by_range[r], np.uint32) for r in sorted(by_range)])
        start = len(self.words)  # the code of the start of a text, which is never a token
        before = np.empty_like(self.codes)
        before[1:] = self.codes[:-1]
        before[np.cumsum(self.sizes) - self.sizes] = start
        key, self.pair_of_token = np.unique(before * (start + 1) + self.codes, return_inverse=True)
        self.head, self.word = np.divmod(key, start + 1)
        self.before = before
        names = np.append(self.words, START)
        self.head_hash, self.word_hash = names[self.head], self.words[self.word]

    def deal(self, ranges: int, hot: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """The pairs of each range that has some."""
        h = self.head_hash
        is_hot = np.isin(h, hot) if len(hot) else np.zeros(len(h), bool)
        at = _range_of(np.where(is_hot, mix(h, self.word_hash), h), ranges)
        order = np.argsort(at, kind="stable")
        cuts = np.searchsorted(at[order], np.arange(ranges + 1))
        for r, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if b > a:
                yield r, order[a:b]


def _runs(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal values begin, and their lengths."""
    first = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.empty(0, np.int64)
    return first, np.diff(np.append(first, len(h))).astype(np.uint32)


#: The model: a row for each range of the histories' hashes. ``heads`` (histories), ``runs`` (how many kept words each has),
#: ``words`` and ``counts`` of the kept pairs in that order, ``sums`` (what a history's kept words sum up to), and for the
#: whole corpus the spectrum of its counts and the sums of the hot histories, which are dealt over all ranges.
MODEL = "range int, heads binary, runs binary, words binary, counts binary, sums binary, spectrum array<long>, hot array<struct<head: long, sums: array<double>>>"
_HOT = pa.struct([("head", pa.int64()), ("sums", pa.list_(pa.float64()))])
_MODEL = (["range", "heads", "runs", "words", "counts", "sums", "spectrum", "hot"], [pa.int32(), *[pa.binary()] * 5, pa.list_(pa.int64()), pa.list_(_HOT)])


def count_pairs(cut: DataFrame, words: DataFrame, unigrams: Unigrams, ranges: int, hot: np.ndarray) -> DataFrame:
    """The model's rows: training counts of pairs by range. A part sends its distinct training pairs, with the corpus's
    counts of their second words."""
    shared = cut.sparkSession.sparkContext.broadcast((unigrams, np.append(hot, START)))
    asked_names = ["range", "heads", "runs", "words", "word_counts", "counts"]

    def ask(left: pa.Table, right: pa.Table) -> pa.Table:
        _, hot = shared.value
        rows = []
        for row in left.to_pylist():
            p = _Part(row, right.to_pylist(), ranges)
            times = np.bincount(p.pair_of_token, np.repeat(p.train, p.sizes), len(p.head)).astype(np.uint32)
            for r, x in p.deal(ranges, hot):
                x = x[times[x] > 0]
                if len(x):
                    first, runs = _runs(p.head[x])
                    rows.append((r, p.head_hash[x][first].tobytes(), _pack(runs), _short(p.word_hash[x]), _pack(p.counts[p.word[x]].astype(np.uint32)), _pack(times[x])))
        return _rows(asked_names, rows, [pa.int32(), *[pa.binary()] * 5])

    def add(group: pa.Table) -> pa.Table:
        u, hot = shared.value
        asked = group.to_pylist()
        h = np.concatenate([np.repeat(np.frombuffer(a["heads"], np.uint64), _unpack(a["runs"], np.uint32)) for a in asked])
        w = np.concatenate([_long(a["words"]) for a in asked])
        word_counts = np.concatenate([_unpack(a["word_counts"], np.uint32) for a in asked])
        times = np.concatenate([_unpack(a["counts"], np.uint32) for a in asked])
        _, first, which = np.unique(mix(h, w), return_index=True, return_inverse=True)
        totals = np.bincount(which, times, len(first)).astype(np.int64)
        kept = totals >= CUTOFF
        # What the kept pairs of a history sum up to: how many have each discounted count, the larger counts, p(w).
        head, of = np.unique(h[first[kept]], return_inverse=True)
        c = totals[kept]
        sums = np.zeros((len(head), DISCOUNTED + 2))
        for r in range(1, DISCOUNTED + 1):
            sums[:, r - 1] = np.bincount(of[c == r], minlength=len(head))
        sums[:, DISCOUNTED] = np.bincount(of, np.where(c > DISCOUNTED, c, 0), len(head))
        sums[:, DISCOUNTED + 1] = np.bincount(of, u.p(word_counts[first[kept]].astype(np.int64)), len(head))
        order = np.argsort(of, kind="stable")
        runs = np.bincount(of, minlength=len(head)).astype(np.uint32)
        is_hot = np.isin(head, hot)
        spread = [{"head": int(x), "sums": y.tolist()} for x, y in zip(head[is_hot].view(np.int64), sums[is_hot], strict=True)]
        row = (asked[0]["range"], head.tobytes(), _pack(runs), _short(w[first[kept]][order]), _pack(c[order].astype(np.uint32)), _pack(sums.reshape(-1)), _spectrum(totals).tolist(), spread)
        return _rows(_MODEL[0], [row], _MODEL[1])

    asked = cut.groupBy("part").cogroup(words.groupBy("part")).applyInArrow(ask, "range int, heads binary, runs binary, words binary, word_counts binary, counts binary")
    return asked.groupBy("range").applyInArrow(add, MODEL)


def _weights(sums: np.ndarray, counts: np.ndarray, level: Level) -> np.ndarray:
    """For each history (alpha, scale): the weight of the level below, and what a discounted count is multiplied by."""
    c = counts.astype(np.float64)
    mass = sums[:, :DISCOUNTED] @ (np.array(level.d[1:]) * np.arange(1, DISCOUNTED + 1)) + sums[:, DISCOUNTED]
    left = np.where(c > 0, 1 - mass / np.maximum(c, 1), 1.0)
    # A history that keeps all its mass gives up half a count's.
    held = np.where(mass > 0, np.maximum(left, 0.5 / (c + 1)), 1.0)
    scale = np.where(mass > 0, (1 - held) / np.where(mass > 0, mass, 1), 0.0)
    return np.stack([held / (1 - sums[:, DISCOUNTED + 1]), scale], axis=1)


def look_up_pairs(cut: DataFrame, words: DataFrame, model: DataFrame, unigrams: Unigrams, level: Level, ranges: int, hot: np.ndarray) -> DataFrame:
    """Answers with the model's count of each pair of each part, and the weights of each of its histories. The model stays
    where it is stored; the parts' questions come to it."""
    shared = cut.sparkSession.sparkContext.broadcast((unigrams, level, hot))
    asked_names = ["part", "range", "heads", "runs", "words", "head_counts"]

    def ask(left: pa.Table, right: pa.Table) -> pa.Table:
        u, _, hot = shared.value
        rows = []
        for row in left.to_pylist():
            p = _Part(row, right.to_pylist(), ranges)
            p.counts[-1] = u.documents
            for r, x in p.deal(ranges, hot):
                first, runs = _runs(p.head[x])
                rows.append((p.part, r, p.head_hash[x][first].tobytes(), _pack(runs), _short(p.word_hash[x]), _pack(p.counts[p.head[x][first]].astype(np.uint32))))
        return _rows(asked_names, rows, [pa.int64(), pa.int32(), *[pa.binary()] * 4])

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        _, level, _ = shared.value
        key, counts, heads, sums = np.empty(0, np.uint64), np.empty(0, np.uint32), np.empty(0, np.uint64), np.empty((0, DISCOUNTED + 2))
        for m in left.to_pylist():  # one row, or none where no training document has a pair of this range
            heads, counts = np.frombuffer(m["heads"], np.uint64), _unpack(m["counts"], np.uint32)
            key = mix(np.repeat(heads, _unpack(m["runs"], np.uint32)), _long(m["words"]))
            sums = _unpack(m["sums"], np.float64).reshape(-1, DISCOUNTED + 2)
            order = np.argsort(key)
            key, counts = key[order], counts[order]
        rows = []
        for a in right.to_pylist():
            h = np.frombuffer(a["heads"], np.uint64)
            seen = _found(key, counts[:, None], mix(np.repeat(h, _unpack(a["runs"], np.uint32)), _long(a["words"])))[:, 0]
            weights = _weights(_found(heads, sums, h), _unpack(a["head_counts"], np.uint32), level)
            rows.append((a["part"], a["range"], "pairs", _pack(seen.astype(np.uint32)), _pack(weights.reshape(-1))))
        return _rows(_ANSWER[0], rows, _ANSWER[1])

    asked = cut.groupBy("part").cogroup(words.groupBy("part")).applyInArrow(ask, "part long, range int, heads binary, runs binary, words binary, head_counts binary")
    return model.select("range", "heads", "runs", "words", "counts", "sums").groupBy("range").cogroup(asked.groupBy("range")).applyInArrow(answer, ANSWER)


def _found(known: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The rows of ``values`` of what is wanted among the sorted ``known``, zeros for the rest."""
    if not len(known):
        return np.zeros((len(wanted), values.shape[1]), values.dtype)
    at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    return np.where((known[at] == wanted)[:, None], values[at], 0)


def _score(p: _Part, answers: list[dict], u: Unigrams, level: Level, ranges: int, hot: np.ndarray, hot_weights: np.ndarray) -> tuple[np.ndarray, ...]:
    """log10 p and base log10 p of each token, and its count."""
    by_range = {a["range"]: a for a in answers if a["about"] == "pairs"}
    seen = np.zeros(len(p.head), np.int64)
    weights = np.zeros((len(p.words) + 1, 2))
    for r, x in p.deal(ranges, hot):
        seen[x] = _unpack(by_range[r]["counts"], np.uint32)
        weights[p.head[x][_runs(p.head[x])[0]]] = _unpack(by_range[r]["weights"], np.float64).reshape(-1, 2)
    names = np.append(p.words, START)
    at = np.minimum(np.searchsorted(hot, names), len(hot) - 1)
    known = hot[at] == names
    weights[known] = hot_weights[at[known]]
    alpha, scale = weights.T
    below = u.p(p.counts[:-1])
    pair = np.where(seen > 0, scale[p.head] * level.apply(seen) * seen, alpha[p.head] * below[p.word])
    return np.log10(pair)[p.pair_of_token], u.base(p.counts[:-1].astype(np.float64))[p.codes], p.counts[p.codes]


def _unigrams(words: DataFrame, tokens: int, documents: int) -> tuple[Unigrams, DataFrame]:
    """Totals of the corpus, and its hot words (``word, n``)."""
    about = words.filter("part < 0").select("spectrum", F.explode_outer("hot").alias("hot"))
    spectrum = words.filter("part < 0").agg(*(F.sum(F.get("spectrum", F.lit(i))) for i in range(DISCOUNTED + 2))).first()
    spectrum = [int(x or 0) for x in spectrum]
    level = Level.of(spectrum[:-1])
    kept = float(tokens - sum((1 - level.d[r]) * r * spectrum[r - 1] for r in range(1, DISCOUNTED + 1)))
    return Unigrams(tokens, spectrum[-1], documents, level, kept), about.filter("hot is not null").select("hot.*")


def score_documents(docs: DataFrame) -> DataFrame:
    """Scores ``doc_id, text, held_out`` by a model of the documents that are not held out.

    Returns ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``, all logarithms to base 10 of the
    whole text and its end. Null and empty texts are the end alone. Null ids and repeated rows are scored as they are;
    without training documents every token is the unknown word, of probability 1. An empty table gives no rows.
    """
    with scratch():
        return stored(_scored(docs), "katz-scores", keep=True)


def _scored(docs: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    parts_of = max(8, partitions_of(docs))  # a partition of the input makes a part or a few
    cut = bucketed(cut_into_parts(docs.select("doc_id", "text", F.coalesce("held_out", F.lit(False)).alias("held_out"))), "katz_parts", "part", parts_of)
    n_all, tokens, documents = (int(x or 0) for x in cut.agg(F.sum("tokens"), F.sum("train_tokens"), F.sum("train_documents")).first())
    ranges = max(1, -(-n_all // TOKENS_PER_RANGE))
    # No word makes up more than a thousandth of the tokens or a range's share without being dealt over all ranges.
    hot_from = max(2, min(-(-tokens // HOT), TOKENS_PER_RANGE))
    words = stored(count_words(cut, ranges, hot_from), "katz-words")
    unigrams, hot = _unigrams(words, tokens, documents)
    hot = np.sort(np.array([x[0] for x in hot.collect()], np.int64).view(np.uint64))
    words = words.filter("part >= 0").select("part", "range", "about", "counts", "weights")
    model = bucketed(count_pairs(cut, words, unigrams, ranges, hot), "katz_model", "range", parts_of)
    level = Level.of([int(x or 0) for x in model.agg(*(F.sum(F.get("spectrum", F.lit(i))) for i in range(DISCOUNTED + 1))).first()])
    hot = np.sort(np.append(hot, START))
    sums = model.select(F.explode("hot").alias("hot")).groupBy("hot.head").agg(*(F.sum(F.get("hot.sums", F.lit(i))) for i in range(DISCOUNTED + 2))).collect()
    hot_sums, hot_counts = np.zeros((len(hot), DISCOUNTED + 2)), np.zeros(len(hot))
    for head, *values in sums:
        hot_sums[np.searchsorted(hot, np.array([head], np.int64).view(np.uint64)[0])] = values
    # A kept pair is counted whole: what the kept pairs of a history sum up to is its count, or that of the documents.
    hot_counts = hot_sums[:, :DISCOUNTED] @ np.arange(1, DISCOUNTED + 1) + hot_sums[:, DISCOUNTED]
    shared = spark.sparkContext.broadcast((unigrams, level, hot, _weights(hot_sums, hot_counts, level)))

    def judge(left: pa.Table, right: pa.Table) -> pa.Table:
        u, level, hot, hot_weights = shared.value
        out = []
        answers = right.to_pylist()
        for row in left.to_pylist():
            p = _Part(row, answers, ranges)
            score, base, count = _score(p, answers, u, level, ranges, hot, hot_weights)
            ends = np.cumsum(p.sizes)
            each = lambda x: np.add.reduceat(x, ends - p.sizes)
            out.append(
                pa.table(
                    {
                        "doc_id": pa.array(p.ids, left.schema.field("ids").type.value_type),
                        "held_out": pa.array(~p.train),
                        "n_tokens": pa.array(p.sizes),
                        "n_known": pa.array(each((count > 0).astype(np.int64))),
                        "train_tokens": pa.array(np.full(len(ends), u.tokens, np.int64)),
                        "base_score": pa.array(each(base)),
                        "score": pa.array(each(score)),
                    }
                )
            )
        return pa.concat_tables(out)

    answers = words.union(look_up_pairs(cut, words, model, unigrams, level, ranges, hot).select("part", "range", "about", "counts", "weights"))
    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return cut.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(judge, schema)


def op7_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_documents(docs.withColumn("held_out", crc32_mod(F.col("doc_id"), 10) == 0))
