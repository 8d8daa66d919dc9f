"""Words of texts as 64-bit hashes, vectorised over Arrow batches.

A word is a run of characters other than space and the controls from tab to carriage return, after lower-casing A-Z.
Hashes stand for words: two words of a corpus of 10^9 different ones share a hash with a probability of about 3 %.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

BYTES_PER_PART = 3_000_000
_MIX, _END = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def give_back() -> None:
    """Returns free memory of Arrow's pool and of the heap to the system."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def parts(batches: Iterable[pa.RecordBatch], column: int, size: int = BYTES_PER_PART) -> Iterator[pa.RecordBatch]:
    """The batches in slices whose texts have about ``size`` bytes at most; one larger text is a slice of its own."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths)
        start = 0
        while start < len(lengths):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
        # Workers are used again by other stages: what Arrow's pool and the heap keep for later goes back.
        del batch, lengths, ends
        give_back()


def gathered(batches: Iterable[pa.RecordBatch], column: int, size: int) -> Iterator[pa.RecordBatch]:
    """The batches put together as long as their texts have ``size`` bytes at most."""
    some: list[pa.RecordBatch] = []
    total = 0
    for batch in batches:
        n = int(pc.sum(pc.binary_length(batch.column(column))).as_py() or 0)
        if some and total + n > size:
            yield pa.Table.from_batches(some).combine_chunks().to_batches()[0]
            some, total = [], 0
        if batch.num_rows:
            some.append(batch)
            total += n
    if some:
        yield pa.Table.from_batches(some).combine_chunks().to_batches()[0]


def hash_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word of all texts in turn, start of each text's words and the end); null counts as empty."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat, offsets = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    coded = flat.dictionary_encode()
    names = coded.dictionary.cast(pa.large_binary() if pa.types.is_large_string(coded.dictionary.type) else pa.binary()).to_pylist()
    hashed = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in names), np.uint64, len(names))
    codes = coded.indices.to_numpy(zero_copy_only=False)
    full = np.fromiter((len(w) > 0 for w in names), bool, len(names))[codes] if names else np.empty(0, bool)
    kept = np.concatenate([[0], np.cumsum(full)])
    return hashed[codes[full]] if names else np.empty(0, np.uint64), kept[offsets]


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of a sequence's hash and one more word's."""
    x = a * _MIX
    x = (x ^ (x >> np.uint64(29))) + b
    x = (x ^ (x >> np.uint64(32))) * _END
    return x ^ (x >> np.uint64(32))


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k words from each position, of len(words) - k + 1 positions (none if there are fewer words)."""
    if len(words) < k:
        return np.empty(0, np.uint64)
    out = mix(np.full(len(words) - k + 1, k, np.uint64), words[: len(words) - k + 1])
    for i in range(1, k):
        out = mix(out, words[i : len(words) - k + 1 + i])
    return out


def shingle_sets(words: np.ndarray, offsets: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """Sorted distinct k-word shingles of each text; a shorter text's words are one shingle, no words none."""
    grams = gram_hashes(words, k)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if b - a >= k:
            yield np.unique(grams[a : b - k + 1])
        else:
            yield gram_hashes(words[a:b], b - a) if b > a else np.empty(0, np.uint64)


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def batches_of(run: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], column: int, size: int = BYTES_PER_PART) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for mapInArrow that applies ``run`` to slices of bounded size."""

    def over(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches, column, size):
            yield from run(part)

    return over
