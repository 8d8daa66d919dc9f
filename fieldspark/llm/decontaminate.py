"""Benchmark decontamination by CGK embedding and bit-sampling LSH (operator 9).

A document leaks an item if some run of its words is within the item's edit distance, counted in words: at least
``similarity`` of the item's words stay. CGK's random walk reads a word sequence with a pointer that each step either
holds or advances as a random function of step and word tells; close sequences are read in step again soon after an
edit, so their embeddings agree in most places. They agree less the more edits there are, so long items are cut into
pieces of at most PIECE words: of a leak within the distance one piece at least is within its own. Piece-sized windows of the text and the pieces are hashed by words sampled
from their embeddings, ``repeats`` times with other walks and places, which meets the target recall; what collides is
verified by an exact edit distance against the text around the window.

Windows are laid only where a leak is possible: an item within the distance shares a number of q-word grams with its
window (q-gram lemma; q is small enough for every item that it holds for one at least), so windows whose surroundings
hold fewer grams of any item need no embedding. This filter loses nothing.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from fieldspark.llm.common import table
from fieldspark.llm.words import batches_of, gram_hashes, hash_words, mix, parts

#: Words of the benchmark that one pass over the documents holds in memory; a larger one takes more passes.
WORDS_PER_PASS = 1_000_000
#: Places of an embedding that one hash samples, and the chance taken for an embedding of a leak to agree at a place.
PLACES, AGREEMENT = 2, 0.5
#: Bytes of text that are searched at once: each repeat and size of window takes them in one pass.
SLICE = 6_000_000
#: Words of an item that is hashed in one piece.
PIECE = 50


@dataclass(frozen=True)
class Settings:
    similarity: float = 0.8
    recall: float = 0.99
    seed: int = 20240607

    @property
    def repeats(self) -> int:
        """So many that one of them collides with the target probability if places agree with chance AGREEMENT."""
        return math.ceil(math.log(1 - self.recall) / math.log(1 - AGREEMENT**PLACES))

    def edits(self, length: int) -> int:
        return int((1 - self.similarity) * length + 1e-9)

    def gram(self, length: int) -> int:
        return max(1, min(3, length // (self.edits(length) + 1)))

    def least_grams(self, length: int) -> int:
        q, k = self.gram(length), self.edits(length)
        return max(1, length - q + 1 - k * q)


def cut(length: int) -> np.ndarray:
    """Where the pieces of an item begin and the last ends: equal pieces of at most PIECE words.

    Edits of all pieces sum up to the item's. If each piece had more than its own share of the length allows, the item
    would have more than its share.
    """
    n = -(-length // PIECE)
    return np.arange(n + 1) * length // n


def size_class(length: int) -> int:
    """Window length for items of this length: steps of about a tenth."""
    return length if length < 10 else int(10 * 1.1 ** round(math.log(length / 10, 1.1)))


def embed(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, steps: np.ndarray, salt: int) -> np.ndarray:
    """Embeddings of the windows ``words[start : end]`` at the rising ``steps``: (windows x steps) words, 0 past the end."""
    at = starts.copy()
    out = np.zeros((len(starts), len(steps)), np.uint64)
    wanted = {int(s): i for i, s in enumerate(steps)}
    last = len(words) - 1
    for step in range(int(steps[-1]) + 1):
        inside = at < ends
        word = np.where(inside, words[np.minimum(at, last)], np.uint64(0))
        if (i := wanted.get(step)) is not None:
            out[:, i] = word
        turn = mix(word, np.full(1, (salt * 1_000_003 + step) & 0xFFFFFFFFFFFF, np.uint64))
        at = at + (inside & (turn >> np.uint64(63) == 1))
    return out


def _key(values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values), np.uint64)
    for i in range(values.shape[1]):
        out = mix(out, values[:, i])
    return out


def best_match(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(edits, start, words) of the run of ``text`` with the least edit distance to ``item``, the first and longest such."""
    places = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for i, w in enumerate(item, 1):
        changed = np.empty_like(row)
        changed[0] = i
        changed[1:] = np.minimum(row[:-1] + (text != w), row[1:] + 1)
        row = np.minimum.accumulate(changed - places) + places
    end = int(row.argmin())
    back, turned = text[:end][::-1], item[::-1]
    places = places[: end + 1]
    line = places.copy()
    for i, w in enumerate(turned, 1):
        changed = np.empty_like(line)
        changed[0] = i
        changed[1:] = np.minimum(line[:-1] + (back != w), line[1:] + 1)
        line = np.minimum.accumulate(changed - places) + places
    length = int(len(line) - 1 - line[::-1].argmin())
    return int(row[end]), end - length, length


def _leaks_in(item: np.ndarray, words: np.ndarray, first: int, last: int, most: int) -> Iterator[tuple[int, int, int]]:
    """(edits, start, words) of disjoint runs of ``words[first:last]`` within ``most`` edits of the item: the best one, then
    the best of what lies before and after it."""
    todo = [(first, last)]
    while todo:
        a, b = todo.pop()
        if b - a >= max(1, len(item) - most):
            edits, start, n = best_match(item, words[a:b])
            if edits <= most:
                yield edits, a + start, n
                if n:
                    todo += [(a, a + start), (a + start + n, b)]


class Items:
    """A pass's share of the benchmark, with gram tables and LSH keys."""

    def __init__(self, ids: list, words: list[np.ndarray], settings: Settings):
        self.ids, self.words, self.settings = ids, words, settings
        self.grams: dict[int, np.ndarray] = {}
        by_q = defaultdict(list)
        self.classes: dict[int, list[int]] = defaultdict(list)
        cuts = [cut(len(w)) for w in words]
        self.pieces = [w[a:b] for w, c in zip(words, cuts, strict=True) for a, b in zip(c[:-1], c[1:], strict=True)]
        # The item of each piece, and where it begins in it.
        self.parent = np.repeat(np.arange(len(words)), [len(c) - 1 for c in cuts])
        self.offset = np.concatenate([c[:-1] for c in cuts])
        for i, w in enumerate(self.pieces):
            by_q[settings.gram(len(w))].append(gram_hashes(w, settings.gram(len(w))))
            self.classes[size_class(len(w))].append(i)
        self.grams = {q: np.unique(np.concatenate(x)) for q, x in by_q.items()}
        # A table of bits answers for most grams before the sorted ones are searched.
        self.bits = {}
        for q, g in self.grams.items():
            bits = np.zeros(1 << 22, bool)
            bits[(g >> np.uint64(42)).astype(np.int64)] = True
            self.bits[q] = bits
        self.plans = {size: self._plan(size, members) for size, members in self.classes.items()}

    def _plan(self, size: int, members: list[int]) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For each repeat: salt, sampled steps, sorted keys and the members that they are of."""
        flat = np.concatenate([self.pieces[i] for i in members])
        ends = np.cumsum([len(self.pieces[i]) for i in members])
        starts = ends - np.array([len(self.pieces[i]) for i in members])
        out = []
        for r in range(self.settings.repeats):
            rng = np.random.default_rng([self.settings.seed, size, r])
            shortest = min(len(self.pieces[i]) for i in members)
            steps = np.sort(rng.choice(max(PLACES, int(1.5 * shortest)), PLACES, replace=False))
            salt = int(rng.integers(1 << 40))
            keys = _key(embed(flat, starts, ends, steps, salt))
            order = np.argsort(keys, kind="stable")
            out.append((salt, steps, keys[order], np.array(members)[order]))
        return out

    def _hits(self, q: int, words: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Rising positions of words that start a q-gram of an item within one text."""
        grams = gram_hashes(words, q)
        if not len(grams):
            return np.empty(0, np.int64)
        maybe = np.flatnonzero(self.bits[q][(grams >> np.uint64(42)).astype(np.int64)])
        known = self.grams[q]
        at = np.minimum(np.searchsorted(known, grams[maybe]), len(known) - 1)
        maybe = maybe[known[at] == grams[maybe]]
        owner = np.searchsorted(offsets, maybe, side="right")
        return maybe[maybe + q <= offsets[np.minimum(owner, len(offsets) - 1)]]

    def search(self, words: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """(text, item, edits, start, words) of the leaks: disjoint runs of a text for each item, the best ones first."""
        s = self.settings
        hits = {q: self._hits(q, words, offsets) for q in self.grams}
        found: dict[tuple[int, int], list[int]] = defaultdict(list)
        for size, members in self.classes.items():
            starts = self._starts(members, hits, offsets)
            if not len(starts):
                continue
            owner = np.searchsorted(offsets, starts, side="right") - 1
            ends = np.minimum(starts + size, offsets[owner + 1])
            for salt, steps, keys, of in self.plans[size]:
                key = _key(embed(words, starts, ends, steps, salt))
                a, b = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
                for w in np.flatnonzero(b > a).tolist():
                    for i in of[a[w] : b[w]].tolist():
                        found[int(owner[w]), int(self.parent[i])].append(int(starts[w] - self.offset[i]))
        for (doc, i), at in sorted(found.items()):
            item, k = self.words[i], s.edits(len(self.words[i]))
            low, high = int(offsets[doc]), int(offsets[doc + 1])
            free = low
            for first, last in _runs(sorted(set(at)), len(item)):
                first, last = max(free, first - 2 * k - 1), min(high, max(last + len(item) + 2 * k + 1, low))
                for edits, start, n in _leaks_in(item, words, first, last, k):
                    yield doc, i, edits, start - low, n
                    free = max(free, start + n)

    def _starts(self, members: list[int], hits: dict[int, np.ndarray], offsets: np.ndarray) -> np.ndarray:
        """Every start of a window that may hold a piece of one of the members' lengths."""
        s, out = self.settings, []
        for length in sorted({len(self.pieces[i]) for i in members}):
            q, k, least = s.gram(length), s.edits(length), s.least_grams(length)
            h = hits[q]
            if len(h) < least:
                continue
            first, last = h[: len(h) - least + 1], h[least - 1 :]
            same = np.searchsorted(offsets, first, side="right") == np.searchsorted(offsets, last, side="right")
            first = np.flatnonzero(same & (last - first <= length + k - q))
            if not len(first):
                continue
            # The leak starts after the hit before its first one, and at most so far ahead of its first.
            at = h[first]
            before = np.where(first > 0, h[np.maximum(first - 1, 0)], -1)
            lead = np.minimum(at - before - 1, k * q + k)
            low = np.maximum(at - lead, offsets[np.searchsorted(offsets, at, side="right") - 1])
            out.append(np.concatenate([np.repeat(low, at - low + 1) + _counter(at - low + 1)]))
        if not out:
            return np.empty(0, np.int64)
        return np.unique(np.concatenate(out))


def _counter(sizes: np.ndarray) -> np.ndarray:
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _runs(starts: list[int], gap: int) -> Iterator[tuple[int, int]]:
    """First and last of the runs of starts that lie within ``gap`` of the next."""
    first = last = starts[0]
    for x in starts[1:]:
        if x - last > gap:
            yield first, last
            first = x
        last = x
    yield first, last


def _passes(benchmark: DataFrame, settings: Settings) -> Iterator[Items]:
    """The benchmark in shares of at most WORDS_PER_PASS words, read one partition at a time."""
    ids: list = []
    words: list[np.ndarray] = []
    total = 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        w, _ = hash_words(pa.array([row["text"]], pa.string()))
        if not len(w):
            continue
        if ids and total + len(w) > WORDS_PER_PASS:
            yield Items(ids, words, settings)
            ids, words, total = [], [], 0
        ids.append(row["item_id"])
        words.append(w)
        total += len(w)
    if ids:
        yield Items(ids, words, settings)


def find_leaks(docs: DataFrame, benchmark: DataFrame, settings: Settings | None = None) -> DataFrame:
    """``doc_id, item_id, start, n_words, edits, similarity``: the disjoint runs of each document and item that it leaks.

    ``start`` counts words from 0. Texts and items without words, or null, leak nothing; rows that repeat are reported
    each, as are items of equal text; null ids are kept. Empty tables give no rows; other columns are ignored.
    """
    settings = settings or Settings()
    spark = docs.sparkSession
    doc_type, item_type = docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()
    item_arrow = to_arrow_type(benchmark.schema["item_id"].dataType)
    schema = f"doc_id {doc_type}, item_id {item_type}, start long, n_words long, edits long, similarity double"
    out = spark.createDataFrame([], schema)
    for items in _passes(benchmark, settings):
        shared = spark.sparkContext.broadcast(items)

        def run(part: pa.RecordBatch, shared=shared) -> Iterator[pa.RecordBatch]:
            items = shared.value
            got = list(items.search(*hash_words(part.column(1))))
            if got:
                doc, item, edits, start, n = (np.array(x) for x in zip(*got, strict=True))
                sizes = np.array([len(items.words[i]) for i in item])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(doc)), pa.array([items.ids[i] for i in item], item_arrow), *(pa.array(x.astype(np.int64)) for x in (start, n, edits)), pa.array(1 - edits / sizes)],
                    names=["doc_id", "item_id", "start", "n_words", "edits", "similarity"],
                )

        out = out.union(docs.select("doc_id", "text").mapInArrow(batches_of(run, 1, SLICE), schema))
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, settings: Settings | None = None) -> DataFrame:
    """The documents that leak no item, with their columns: judged row by row, without a shuffle."""
    for items in _passes(benchmark, settings or Settings()):
        docs = docs.filter(~_leaks(docs.sparkSession.sparkContext.broadcast(items))(F.col("text")))
    return docs


def _leaks(shared: Broadcast) -> Callable[[Column], Column]:
    """Whether a text leaks an item. Only texts go to Python and only flags come back; the rows wait in the JVM."""

    @F.arrow_udf("boolean")
    def leaks(texts: pa.Array) -> pa.Array:
        flags, start = np.zeros(len(texts), bool), 0
        for part in parts([pa.RecordBatch.from_arrays([texts], names=["text"])], 0, SLICE):
            for doc, *_ in shared.value.search(*hash_words(part.column(0))):
                flags[start + doc] = True
            start += part.num_rows
        return pa.array(flags)

    return leaks


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "start", "n_words", "edits", F.round("similarity", 6).alias("similarity"))
