"""Byte-level BPE encoding and decoding (operator 1): recursive DuckDB queries inside each partition.

Words are the matches of the split pattern. A batch's distinct new words become token-position rows; a recursive query
joins neighbouring rows with the merge table and contracts each word's leftmost pair of minimum rank until none is
left. The merge table holds every split of a vocabulary entry into two entries, as ranks belong to byte strings.
Decoding joins (document, position, id) rows with the vocabulary and aggregates the bytes by position.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from itertools import chain, islice

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from fieldspark.llm.common import table
from fieldspark.llm.words import give_back

#: Rows of one recursive query, known words of a worker and characters of one sub-batch: they bound a worker's memory.
ROWS_PER_QUERY = 250_000
KNOWN_WORDS = 600_000
CHARS_PER_BATCH = 4_000_000
#: Rows of one decoding query.
TOKENS_PER_QUERY = 2_000_000
#: The recursion takes as many rounds as a word has merges; longer words are contracted from a heap instead.
LONGEST_WORD = 256

#: Positions run through all words of a query, so one sort by position serves the neighbours of every word.
ENCODE_SQL = """
WITH RECURSIVE state(done, word, pos, id) AS (
  SELECT false, word, pos, id FROM bytes_in
  UNION ALL
  (WITH pairs AS (
     SELECT word, pos, id, CASE WHEN lead(word) OVER k = word THEN id::BIGINT * 4294967296 + lead(id) OVER k END AS pair, lag(pos) OVER k AS before
     FROM state WHERE NOT done WINDOW k AS (ORDER BY pos)
   ), ranked AS (SELECT pairs.*, merged FROM pairs LEFT JOIN merges USING (pair)),
   best AS (SELECT word, min(merged::BIGINT * 4294967296 + pos) % 4294967296 AS spot FROM ranked WHERE merged IS NOT NULL GROUP BY word)
   SELECT spot IS NULL, word, pos, CASE WHEN pos = spot THEN merged ELSE id END
   FROM ranked LEFT JOIN best USING (word) WHERE spot IS NULL OR before IS DISTINCT FROM spot)
)
SELECT word, id FROM state WHERE done ORDER BY pos
"""

#: One sort by position, then aggregation in that order; the aggregated positions show whether it was kept.
DECODE_SQL = """
SELECT doc, unhex(string_agg(hex, '')) AS decoded, list(pos) AS places
FROM (SELECT doc, pos, hex FROM ids_in LEFT JOIN vocabulary USING (id) ORDER BY pos) GROUP BY doc
"""

#: The same for rows that reach the aggregate out of order: each group is sorted by itself, at three times the cost.
DECODE_SORTED_SQL = """
SELECT doc, unhex(string_agg(hex, '' ORDER BY pos)) AS decoded FROM ids_in LEFT JOIN vocabulary USING (id) GROUP BY doc
"""


def default_vocabulary() -> tuple[str, str]:
    """Path of the rank file and the split pattern of the public vocabulary that the query uses."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def unicode_pattern(pattern: str) -> str:
    """The pattern with white space as the Unicode property, which Python's own class exceeds by four controls."""
    return pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")


class Numbers(dict):
    """Words by number: a word that is looked up for the first time gets the next one."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


class Codec:
    """Encoder and decoder of one vocabulary, with a DuckDB connection and the words met so far."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.words = regex.compile(unicode_pattern(pattern))
        self.byte_ids = np.array([self.ranks[bytes([i])] for i in range(256)], dtype=np.int32)
        splits = [(self.ranks[t[:i]] << 32 | self.ranks[t[i:]], r) for t, r in self.ranks.items() for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks]
        self.ids = np.array(sorted(self.ranks.values()), np.int32)
        self.tables = {
            "merges": pa.table({"pair": pa.array([s for s, _ in splits], pa.int64()), "merged": pa.array([r for _, r in splits], pa.int32())}),
            "vocabulary": pa.table({"id": pa.array(list(self.ranks.values()), pa.int32()), "hex": [t.hex() for t in self.ranks]}),
        }
        self.limit = KNOWN_WORDS
        self._forget()
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        self.db.execute("SET preserve_insertion_order = false")
        for name, rows in self.tables.items():
            self.db.register("rows_in", rows)
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM rows_in")
            self.db.unregister("rows_in")

    def rest(self) -> None:
        """Between partitions: the worker may serve other stages, so most known words go, and free memory goes back."""
        self._thin()
        give_back()

    def _forget(self) -> None:
        """Known words have numbers; word k was met ``uses[k]`` times, its ids are ``flat[start[k] : start[k] + size[k]]``."""
        self.known = Numbers()
        self.flat = self.start = self.size = self.uses = np.empty(0, np.int32)

    def _thin(self) -> None:
        """Beyond the limit, only words met again stay: half the limit of them, those met most often."""
        if len(self.known) != len(self.size):  # a failed task left words without ids
            self._forget()
        if len(self.known) <= self.limit:
            return
        again = np.flatnonzero(self.uses > 1)
        kept = np.sort(again[np.argsort(-self.uses[again], kind="stable")[: self.limit // 2]])
        names = np.array(list(self.known), object)[kept].tolist()
        self.known = Numbers(zip(names, range(len(names)), strict=True))
        self.flat = self.flat[_ranges(self.start[kept], self.size[kept])]
        self.size, self.uses = self.size[kept], self.uses[kept] // 2
        self.start = np.cumsum(self.size) - self.size

    def _contract(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each word, and the ids of all words in turn, by the recursive query."""
        flat = np.frombuffer(b"".join(words), dtype=np.uint8)
        numbers = np.repeat(np.arange(len(words), dtype=np.int32), np.fromiter(map(len, words), np.int64, len(words)))
        self.db.register("bytes_in", pa.table({"word": numbers, "pos": np.arange(len(flat), dtype=np.int32), "id": self.byte_ids[flat]}))
        got = self.db.sql(ENCODE_SQL).to_arrow_table()
        self.db.unregister("bytes_in")
        return np.bincount(got["word"].to_numpy(), minlength=len(words)), got["id"].to_numpy()

    def _contract_long(self, word: bytes) -> np.ndarray:
        """The same contraction from a heap of (rank, position), in time n log n."""
        parts: list[bytes | None] = [word[i : i + 1] for i in range(len(word))]
        after, before = list(range(1, len(word) + 1)), list(range(-1, len(word) - 1))

        def pair(i: int) -> tuple | None:
            j = after[i]
            rank = self.ranks.get(parts[i] + parts[j]) if j < len(word) else None
            return None if rank is None else (rank, i, parts[i], parts[j])

        heap = [p for i in range(len(word)) if (p := pair(i))]
        heapq.heapify(heap)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if parts[i] != left or j >= len(word) or parts[j] != right:
                continue
            parts[i], parts[j], after[i] = left + right, None, after[j]
            if after[i] < len(word):
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and (p := pair(k)):
                    heapq.heappush(heap, p)
        return np.array([self.ranks[p] for p in parts if p is not None], dtype=np.int32)

    def _learn(self, words: Sequence[str]) -> None:
        """Adds the ids of words whose numbers follow those of the words before."""
        encoded = [w.encode("utf-8", "surrogatepass") for w in words]
        ranks = np.fromiter((self.ranks.get(w, -1) for w in encoded), np.int32, len(encoded))
        whole = np.flatnonzero(ranks >= 0)
        numbers, sizes, flats = [whole], [np.ones(len(whole), np.int64)], [ranks[whole]]
        some: list[int] = []
        rows = 0

        def flush() -> None:
            nonlocal rows
            if some:
                size, flat = self._contract([encoded[k] for k in some])
                numbers.append(np.array(some))
                sizes.append(size)
                flats.append(flat)
            some.clear()
            rows = 0

        for k in np.flatnonzero(ranks < 0).tolist():
            n = len(encoded[k])
            if n > LONGEST_WORD:
                ids = self._contract_long(encoded[k])
                numbers.append(np.array([k]))
                sizes.append(np.array([len(ids)]))
                flats.append(ids)
                continue
            if rows + n > ROWS_PER_QUERY:
                flush()
            some.append(k)
            rows += n
        flush()
        size, order = np.concatenate(sizes), np.argsort(np.concatenate(numbers))
        start = len(self.flat) + np.cumsum(size) - size
        self.flat = np.concatenate([self.flat, *flats]).astype(np.int32)
        self.start, self.size = np.concatenate([self.start, start[order]]), np.concatenate([self.size, size[order]])
        self.uses = np.concatenate([self.uses, np.zeros(len(words), np.int32)])

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        """Ids of each text, without special tokens."""
        split = [self.words.findall(t) for t in texts]
        self._thin()
        before = len(self.known)
        numbers = np.fromiter(map(self.known.__getitem__, chain.from_iterable(split)), np.int64, sum(map(len, split)))
        if len(self.known) > before:
            self._learn(list(islice(self.known, before, None)))
        self.uses = self.uses + np.bincount(numbers, minlength=len(self.known))
        sizes = self.size[numbers].astype(np.int64)
        flat = self.flat[_ranges(self.start[numbers], sizes)]
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum([0, *map(len, split)])]
        return [flat[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]

    def decode(self, ids: Sequence[np.ndarray]) -> list[bytes]:
        """Bytes of each sequence of ids; an id outside the vocabulary is an error."""
        sizes = [len(x) for x in ids]
        flat = np.concatenate([*ids, np.empty(0, np.int32)]).astype(np.int32)
        if not np.isin(flat, self.ids).all():
            raise ValueError("an id is not in the vocabulary")
        docs = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        pieces: list[list[bytes]] = [[] for _ in sizes]
        for at in range(0, len(flat), TOKENS_PER_QUERY):  # a longer text comes in pieces
            for doc, piece in self._join(docs[at : at + TOKENS_PER_QUERY], flat[at : at + TOKENS_PER_QUERY]):
                pieces[doc].append(piece)
        return [b"".join(x) for x in pieces]

    def _join(self, docs: np.ndarray, ids: np.ndarray) -> Iterator[tuple[int, bytes]]:
        """The bytes of the ids of each document, whose rows stand together."""
        self.db.register("ids_in", pa.table({"doc": docs, "pos": np.arange(len(ids), dtype=np.int32), "id": ids}))
        got = self.db.sql(DECODE_SQL).to_arrow_table().combine_chunks()
        size = np.bincount(docs)
        first, found = np.cumsum(size) - size, got["doc"].to_numpy()
        if not np.array_equal(got["places"].combine_chunks().flatten().to_numpy(), _ranges(first[found], size[found])):
            got = self.db.sql(DECODE_SORTED_SQL).to_arrow_table()
        self.db.unregister("ids_in")
        return zip(got["doc"].to_pylist(), got["decoded"].to_pylist(), strict=True)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges ``start .. start + size - 1``, one range after another."""
    before = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(starts.astype(np.int64) - before, sizes)


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def _parts(batches: Iterable[pa.RecordBatch], column: int, size, most: int = CHARS_PER_BATCH) -> Iterator[pa.RecordBatch]:
    """The batches in slices of bounded total size (a single larger row is a slice of its own)."""
    for batch in batches:
        sizes = [size(x) for x in batch.column(column)]
        start = total = 0
        for i, n in enumerate(sizes):
            if i > start and total + n > most:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        yield batch.slice(start)


def _text_size(x: pa.Scalar) -> int:
    return x.as_buffer().size if x.is_valid else 0


def _lists(ids: Sequence[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*ids, np.empty(0, np.int32)]).astype(np.int32)))


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, ids`` (array<int>) for every document; a null text counts as empty, and empty texts have no ids.

    Rows stay as they are, repeated or with null ids alike; an empty table gives no rows; other columns are ignored.
    Whole texts are encoded, and words longer than LONGEST_WORD bytes are contracted from a heap with the same result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for part in _parts(batches, 1, _text_size):
            ids = c.encode([x or "" for x in part.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([part.column(0), _lists(ids)], names=["doc_id", "ids"])
        c.rest()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, decoded`` (binary) of rows ``doc_id, ids``; null ids count as none, an unknown id is an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for part in _parts(batches, 1, lambda x: 4 * len(x) if x.is_valid else 0):
            decoded = c.decode([np.array(x or [], np.int32) for x in part.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(decoded, pa.binary())], names=["doc_id", "decoded"])
        c.rest()

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, decoded binary")


def round_trip(docs: DataFrame, path: str, pattern: str, with_ids: bool = False, known_words: int = KNOWN_WORDS, chars: int = CHARS_PER_BATCH) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: each text is encoded, its ids decoded, and both hashed in place;
    ``with_ids`` adds the ids, ``known_words`` and ``chars`` bound what a worker remembers and handles at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        c.limit = known_words
        names = [str(i) for i in range(int(c.ids[-1]) + 1)]
        sha = lambda x: hashlib.sha256(x).hexdigest()
        for part in _parts(batches, 1, _text_size, chars):
            ids = c.encode([x or "" for x in part.column(1).to_pylist()])
            columns = [
                part.column(0),
                pa.array([len(x) for x in ids], pa.int64()),
                pa.array([sha(",".join(map(names.__getitem__, x.tolist())).encode()) for x in ids], pa.string()),
                pa.array([sha(x) for x in c.decode(ids)], pa.string()),
            ]
            if with_ids:
                columns.append(_lists(ids))
            yield pa.RecordBatch.from_arrays(columns, names=list(out))
        c.rest()

    out = {"doc_id": docs.schema["doc_id"].dataType.simpleString(), "n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}
    if with_ids:
        out["ids"] = "array<int>"
    return docs.select("doc_id", "text").mapInArrow(run, ", ".join(f"{k} {v}" for k, v in out.items()))


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), *default_vocabulary())
