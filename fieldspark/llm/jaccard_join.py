"""Exact n-gram Jaccard join in the metric space of shingle sets (operator 10).

The Jaccard distance d = 1 - similarity is a metric; links are pairs with d <= r. Documents with one set form a class,
and classes are joined by regions within regions:

1. Root regions. Unrelated documents lie at distance 1 from each other and from any pivot, where no triangle inequality
   separates them; so the space is first split by pivots that are single shingles. In a global order of shingles the
   nearest of them is a set's first shingle; the window that a distance of r leaves open are its first
   n - ceil((1 - r) n) + 1 shingles, and a class is replicated to those regions. Linked classes share one (prefix
   filter). The order is by document frequency, rare shingles first, so that shared passages make few regions.
2. Voronoi regions. Each class is compared with pivots, one class drawn in each of its min-hash cells, and belongs to
   the nearest one within r; a class without one is its own pivot. Members of a region are linked through their pivot,
   so a group of thousands of near copies costs a few comparisons for each member.
3. Windows. A root region of few classes joins them directly. A crowded one joins its Voronoi regions first, by their
   pivots: members x, y can be linked only if d(x, p) + d(y, q) + r >= d(p, q). Pairs of regions that this leaves open
   are joined again, member by member, and only boundary members are compared. Crowded regions of any size are dealt
   in blocks of BLOCK Voronoi regions or members, so none of them lands in one task.

Before sets are read, pairs pass a bound from fixed pivots: BUCKETS parts of the universe of shingles. The counts of
sets in a part differ by no more than the sets do there, so the sum of the lesser counts bounds the intersection.

Components of the links found are exact; pairs within a Voronoi region are not enumerated. Sets are compared by 64-bit
hashes of their shingles, classes by 64-bit hashes of their sets.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldspark.llm.common import partitions_of, scratch, stored, table
from fieldspark.llm.words import batches_of, hash_words, shingle_sets, signed
from fieldspark.operators.graph import connected

#: Independent min-hashes that propose pivots.
CELLS = 6
#: Shingles of this many classes or more are frequent; the most of them that are remembered, most frequent first. They
#: are told by 32 bits of their hash. They only steer the order, and any order gives the same links.
FREQUENT, MOST_FREQUENT = 5, 1_000_000
#: Parts of the universe of shingles whose counts bound an intersection.
BUCKETS = 128
SLICE = 8_000_000
#: Shingles that the prefixes of a pair must share where they are long enough.
SHARED = 4
#: Classes beyond which the root region of a remembered shingle is crowded.
CROWD = 64
#: Voronoi regions or members in a block of a crowded region, and entries of a task that joins small root regions.
BLOCK, ENTRIES = 1000, 250_000
#: Identifiers up to which a list of documents to be read again is broadcast (8 bytes each); beyond, a shuffle join.
FEW_IDS = 1_000_000


@dataclass(frozen=True)
class Similarity:
    """Sets are linked if ``den`` x intersection >= ``num`` x union, for shingles of ``words`` words."""

    words: int = 5
    num: int = 80
    den: int = 100

    @property
    def reach(self) -> float:
        """The distance r of the farthest links, and a little for rounding."""
        return 1 - self.num / self.den + 1e-9


@dataclass(frozen=True)
class Frequent:
    """Frequent shingles: upper halves of their hashes, sorted; the rank of each (rarer ones earlier); the rank from which
    shingles are in more than CROWD classes."""

    halves: np.ndarray
    ranks: np.ndarray
    crowded: int

    def look_up(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each shingle is frequent, and where among the frequent ones it would be."""
        if not len(self.halves):
            return np.zeros(len(x), bool), np.zeros(len(x), np.int64)
        half = (x >> np.uint64(32)).astype(np.uint32)
        at = np.minimum(np.searchsorted(self.halves, half), len(self.halves) - 1)
        return self.halves[at] == half, at


def _class_of(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes())


def _id(c: Column) -> Column:
    """Document ids as join keys; null ids share one key, told apart by their class."""
    return F.coalesce(c.cast("long"), F.lit(-(1 << 63)))


def _counts(x: np.ndarray) -> bytes | None:
    """Counts by bucket, or none where one exceeds 16 bits."""
    v = np.bincount((x >> np.uint64(57)).astype(np.int64), minlength=BUCKETS)
    return v.astype(np.uint16).tobytes() if v.max(initial=0) < 1 << 16 else None


def _vectors(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Counts by bucket as a matrix, and which rows have some."""
    rows = column.to_pylist()
    none = bytes(2 * BUCKETS)
    return np.frombuffer(b"".join(x or none for x in rows), np.uint16).reshape(-1, BUCKETS), np.array([x is not None for x in rows], bool)


def profile(docs: DataFrame, s: Similarity, frequent: Broadcast) -> DataFrame:
    """For each row of ``doc_id, text, t``: ``n`` (set size) and ``c`` (class). The first row of a class in a slice has
    also ``u`` (shingles that are not frequent), ``m`` (min-hashes), ``v`` (counts by bucket), ``s`` (root regions: the
    prefix in order) and ``cool`` (how many of those are not crowded)."""
    salts = [np.uint64(0xA24BAED4963EE407 * (2 * j + 1) % (1 << 64) | 1) for j in range(CELLS)]
    kind = docs.schema["doc_id"].dataType.simpleString()
    payload = pa.schema([("u", pa.int32()), ("m", pa.list_(pa.int64())), ("v", pa.binary()), ("s", pa.list_(pa.int64())), ("cool", pa.int32())])

    def describe(x: np.ndarray, known: Frequent) -> tuple:
        often, at = known.look_up(x)
        length, rare = len(x) - -(-s.num * len(x) // s.den) + 1, len(x) - int(often.sum())
        rank = known.ranks[at[often]]
        order = np.argsort(rank, kind="stable")
        prefix = np.concatenate([x[~often], x[often][order]])[:length]
        cool = min(length, rare + int((rank < known.crowded).sum()))
        mixed = [x * salt for salt in salts]
        least = np.array([(y ^ (y >> np.uint64(31))).min() for y in mixed], np.uint64)
        return rare, least.view(np.int64), _counts(x), prefix.view(np.int64), cool

    def run(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        known = frequent.value
        n, c, rows, done = [], [], [], set()
        for x in shingle_sets(*hash_words(part.column(1)), s.words):
            n.append(len(x))
            c.append(_class_of(x))
            rows.append(describe(x, known) if len(x) and c[-1] not in done else (None,) * len(payload))
            done.add(c[-1])
        columns = [pa.array(list(column), f.type) for column, f in zip(zip(*rows, strict=True), payload, strict=True)]
        yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(n, pa.int64()), signed(np.array(c, np.uint64)), *columns], names=["doc_id", "t", "n", "c", *payload.names])

    return docs.select("doc_id", "text", "t").mapInArrow(batches_of(run, 1), f"doc_id {kind}, t long, n long, c long, u int, m array<long>, v binary, s array<long>, cool int")


def _frequent(docs: DataFrame, s: Similarity) -> Frequent:
    """The frequent shingles. A slice of documents counts its classes' shingles and sends sorted halves and counts by
    range, packed; a range adds them up. There are a few ranges for each partition of the input, so that a range does
    not grow with it."""
    ranges = 4 * max(8, partitions_of(docs))

    def run(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        pool = {_class_of(x): x for x in shingle_sets(*hash_words(part.column(0)), s.words)}
        half = np.concatenate([*pool.values(), np.empty(0, np.uint64)]) >> np.uint64(32)
        half, n = np.unique(half.astype(np.uint32), return_counts=True)
        n = np.minimum(n, 255).astype(np.uint8)
        at = np.searchsorted(half, (np.arange(ranges + 1, dtype=np.float64) * 2**32 / ranges)[:-1].astype(np.uint32)).tolist() + [len(half)]
        rows = [(i, half[a:b].tobytes(), n[a:b].tobytes()) for i, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)) if b > a]
        if rows:
            i, h, k = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(h, pa.binary()), pa.array(k, pa.binary())], names=["range", "h", "n"])

    def add(group: pa.Table) -> pa.Table:
        h = np.frombuffer(b"".join(group["h"].to_pylist()), np.uint32)
        n = np.frombuffer(b"".join(group["n"].to_pylist()), np.uint8)
        half, which = np.unique(h, return_inverse=True)
        total = np.bincount(which, n)
        often = total >= FREQUENT
        return pa.table({"h": pa.array(half[often].astype(np.int64)), "n": pa.array(total[often].astype(np.int64))})

    packed = docs.select("text").mapInArrow(batches_of(run, 0, SLICE), "range int, h binary, n binary")
    often = stored(packed.groupBy("range").applyInArrow(add, "h long, n long"), "jaccard-frequent")
    # The least count at which no more than MOST_FREQUENT are left, from their histogram.
    room, least = MOST_FREQUENT, FREQUENT
    for n, k in sorted(map(tuple, often.groupBy(F.least("n", F.lit(100_000)).alias("n")).count().collect()), reverse=True):
        room -= k
        if room < 0:
            least = n + 1
            break
    often = often.filter(F.col("n") >= least).toArrow()
    half, n = often["h"].to_numpy().astype(np.uint32), often["n"].to_numpy()
    by_value = np.argsort(half)
    rank = np.empty(len(half), np.int32)
    rank[np.lexsort((half, n))] = np.arange(len(half), dtype=np.int32)
    return Frequent(half[by_value], rank[by_value], int((n <= CROWD).sum()))


def _sets(docs: DataFrame, pairs: DataFrame, classes: DataFrame, s: Similarity, label: str) -> DataFrame:
    """``c, set`` (packed sorted shingles) of the classes in ``pairs`` (a, b), from texts that are read again."""

    def run(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sets = list(shingle_sets(*hash_words(part.column(0)), s.words))
        yield pa.RecordBatch.from_arrays([signed(np.array([_class_of(x) for x in sets], np.uint64)), pa.array([x.tobytes() for x in sets], pa.binary())], names=["c", "set"])

    wanted = pairs.select(F.col("a").alias("c")).union(pairs.select("b")).distinct().join(classes, "c").select("c", _id(F.col("doc_id")).alias("__id"))
    wanted = stored(wanted, f"jaccard-{label}-wanted")
    ids, names = wanted.select("__id").distinct(), wanted.select("c")
    if wanted.count() <= FEW_IDS:
        ids, names = F.broadcast(ids), F.broadcast(names)
    some = docs.select(_id(F.col("doc_id")).alias("__id"), "text").join(ids, "__id", "left_semi").select("text")
    found = some.mapInArrow(batches_of(run, 0), "c long, set binary")
    # A document id may have several texts: classes that nobody asked for go, and one set of each class stays.
    return stored(found.join(names, "c", "left_semi").groupBy("c").agg(F.first("set").alias("set")), f"jaccard-{label}-sets")


def _measured(pairs: DataFrame, sets: DataFrame, s: Similarity) -> DataFrame:
    """``pairs`` (a, b, reach) with ``linked`` and the distance ``d``."""
    names = ["a", "b", "reach", "linked", "d"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for x, y in zip(batch.column(3), batch.column(4), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                rows.append((len(x) + len(y), len(np.intersect1d(x, y, assume_unique=True))))
            total, both = np.array(rows, np.int64).reshape(-1, 2).T
            linked, d = both * (s.den + s.num) >= total * s.num, 1 - both / np.maximum(total - both, 1)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array(linked), pa.array(d)], names=names)

    left, right = sets.select(F.col("c").alias("a"), F.col("set").alias("x")), sets.select(F.col("c").alias("b"), F.col("set").alias("y"))
    both = pairs.select("a", "b", "reach").join(left, "a").join(right, "b").select("a", "b", "reach", "x", "y")
    return both.mapInArrow(run, "a long, b long, reach double, linked boolean, d double")


def _least_distance(x: np.ndarray, y: np.ndarray, n_x: np.ndarray, n_y: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Lower bounds of distances, from counts by bucket where both are known."""
    both = np.where(known, np.minimum(x, y).sum(axis=1, dtype=np.int64), np.minimum(n_x, n_y))
    return 1 - both / np.maximum(n_x + n_y - both, 1)


def _possible(pairs: DataFrame, classes: DataFrame, s: Similarity) -> DataFrame:
    """The pairs ``a, b`` of classes that their counts by bucket do not hold apart."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (x, has_x), (y, has_y) = _vectors(batch.column(4)), _vectors(batch.column(5))
            n_x, n_y = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            near = _least_distance(x, y, n_x, n_y, has_x & has_y) <= s.reach
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(near))

    left, right = (classes.select(F.col("c").alias(k), F.col("n").alias(f"n_{k}"), F.col("v").alias(f"v_{k}")) for k in "ab")
    both = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "n_a", "n_b", "v_a", "v_b")
    return both.mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """``c, label``: the least class of the component of each class in ``edges`` (a, b); rounds are stored."""
    found = connected(edges.select(F.col("a").alias("src"), F.col("b").alias("dst")), lambda df: stored(df, "jaccard-stars"))
    return found.select(F.col("node").alias("c"), F.col("component").alias("label"))


def _joined_regions(entries: DataFrame, s: Similarity, ranges: int) -> DataFrame:
    """Pairs ``a, b, n_a, n_b, common`` of classes of different groups that meet in small root regions.

    ``entries``: ``s, c, g, n, pos``. A task has a range of the shingles' hashes. Positions count as far as a linked pair of
    these sizes must share SHARED shingles.
    """
    names = ["a", "b", "n_a", "n_b", "common"]

    def run(group: pa.Table) -> pa.Table:
        at, c, g, n, pos = (group[k].to_numpy() for k in ("s", "c", "g", "n", "pos"))
        order = np.argsort(at, kind="stable")
        at, c, g, n, pos = at[order], c[order], g[order], n[order].astype(np.int64), pos[order].astype(np.int64)
        found, one, step = [], np.arange(len(at)), 0
        while len(one):
            step += 1
            one = one[one + step < len(at)]
            one = one[at[one] == at[one + step]]
            two = one + step
            low, high = np.minimum(n[one], n[two]), np.maximum(n[one], n[two])
            need = -(-(n[one] + n[two]) * s.num // (s.num + s.den))
            fits = (g[one] != g[two]) & (s.den * low >= s.num * high) & (pos[one] < n[one] - need + SHARED) & (pos[two] < n[two] - need + SHARED)
            x, y = one[fits], two[fits]
            swap = c[x] > c[y]
            x, y = np.where(swap, y, x), np.where(swap, x, y)
            found.append(np.stack([c[x], c[y], n[x], n[y]]))
        rows, times = np.unique(np.concatenate([*found, np.empty((4, 0), np.int64)], axis=1), axis=1, return_counts=True)
        return pa.table([*(pa.array(x) for x in rows), pa.array(times)], names=names)

    dealt = entries.withColumn("range", F.pmod("s", F.lit(ranges)))
    pairs = dealt.groupBy("range").applyInArrow(run, "a long, b long, n_a long, n_b long, common long")
    need = f"ceil((n_a + n_b) * {s.num} / ({s.num} + {s.den}) - 1e-9)"
    room = " , ".join(f"n_{k} - ceil({s.num} * n_{k} / {s.den} - 1e-9) + 1 - (n_{k} - {need})" for k in "ab")
    return pairs.groupBy("a", "b", "n_a", "n_b").agg(F.sum("common").alias("common")).filter(f"common >= least({SHARED}, {room})")


def _crowded_regions(entries: DataFrame, classes: DataFrame, s: Similarity) -> DataFrame:
    """Pairs ``a, b, reach`` of pivots whose Voronoi regions meet in a crowded root region and may hold linked members:
    ``reach`` is how far their members there are from them together. ``entries``: ``s, c, g, n, p, d``.
    """
    regions = entries.groupBy("s", "p", "g").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.max("d").alias("d"))
    regions = stored(regions, "jaccard-crowds")
    mixed = regions.groupBy("s").agg(F.min("g").alias("one"), F.max("g").alias("two"), F.count(F.lit(1)).alias("k")).filter("one < two")
    blocks = F.ceil(F.col("k") / BLOCK).cast("int")
    regions = regions.join(mixed.select("s", "k"), "s").withColumn("block", F.pmod(F.xxhash64("p"), blocks).cast("int")).withColumn("blocks", blocks)
    regions = regions.join(classes.select(F.col("c").alias("p"), F.col("n").alias("size"), "v"), "p")
    dealt = regions.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("s", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "p", "g", "low", "high", "d", "size", "v")

    def run(group: pa.Table) -> pa.Table:
        block, p, g, low, high, d, n = (group[k].to_numpy() for k in ("block", "p", "g", "low", "high", "d", "size"))
        v, has = _vectors(group["v"])
        i, j = group["i"][0].as_py(), group["j"][0].as_py()
        others = np.flatnonzero(block == j)
        found = []
        for x in np.flatnonzero(block == i):
            y = others[(g[others] != g[x]) & (s.num * low[others] <= s.den * high[x]) & (s.num * low[x] <= s.den * high[others])]
            if i == j:
                y = y[y > x]
            together = d[x] + d[y]
            y, together = (z[_least_distance(v[x], v[y], n[x], n[y], has[x] & has[y]) <= together + s.reach] for z in (y, together))
            swap = p[y] < p[x]
            found.append((np.where(swap, p[y], p[x]), np.where(swap, p[x], p[y]), together))
        a, b, together = (np.concatenate([z, *(f[k] for f in found)]) for k, z in enumerate((np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))))
        return pa.table({"a": pa.array(a), "b": pa.array(b), "reach": pa.array(together)})

    pairs = dealt.groupBy("s", "i", "j").applyInArrow(run, "a long, b long, reach double")
    return pairs.groupBy("a", "b").agg(F.max("reach").alias("reach"))


def _boundaries(apart: DataFrame, homes: DataFrame, classes: DataFrame, s: Similarity) -> DataFrame:
    """Pairs ``a, b`` of members of Voronoi regions whose pivots ``a, b`` are ``far`` from each other, but near enough for
    links between their members (``c, p, d`` in ``homes``).

    The region of more members is the host, members of the other are guests; both are dealt in blocks. Members x, y whose
    distances from their pivots and r make up for ``far`` are boundary members; what their counts by bucket leave is
    returned.
    """
    members = homes.filter("c <> p").select("p", "c", "d").union(apart.select("a", "a", F.lit(0.0)).union(apart.select("b", "b", F.lit(0.0))).distinct())
    members = stored(members, "jaccard-members")
    sizes = members.groupBy("p").agg(F.count(F.lit(1)).alias("size"))
    sized = apart.join(sizes.select(F.col("p").alias("a"), F.col("size").alias("size_a")), "a").join(sizes.select(F.col("p").alias("b"), F.col("size").alias("size_b")), "b")
    first = F.col("size_a") >= F.col("size_b")
    sized = sized.select(F.when(first, F.col("a")).otherwise(F.col("b")).alias("host"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("p"), F.greatest("size_a", "size_b").alias("size"), "far")
    guests = stored(sized.join(members, "p").select("host", "size", "c", "d", "far"), "jaccard-guests")
    hosts = guests.groupBy("host").agg(F.first("size").alias("size"), F.count(F.lit(1)).alias("asked"))
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    place = lambda n: F.pmod(F.xxhash64("c"), blocks(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), blocks(n) - 1))
    own = members.withColumnRenamed("p", "host").join(hosts, "host").select("host", place("size").alias("i"), every("asked").alias("j"), "c", "d", F.lit(None).cast("double").alias("far"))
    guests = guests.join(hosts.select("host", "asked"), "host").select("host", every("size").alias("i"), place("asked").alias("j"), "c", "d", "far")
    dealt = own.union(guests).join(classes.select("c", "n", "v"), "c")

    def run(group: pa.Table) -> pa.Table:
        c, d, n = (group[k].to_numpy() for k in ("c", "d", "n"))
        far, (v, has) = group["far"].to_numpy(), _vectors(group["v"])
        own, found = np.flatnonzero(np.isnan(far)), []
        for y in np.flatnonzero(~np.isnan(far)):
            x = own[(d[own] + d[y] > 0) & (d[own] + d[y] + s.reach >= far[y])]
            x = x[_least_distance(v[x], v[y], n[x], n[y], has[x] & has[y]) <= s.reach]
            found.append(np.stack([np.minimum(c[x], c[y]), np.maximum(c[x], c[y])]))
        a, b = np.concatenate([*found, np.empty((2, 0), np.int64)], axis=1)
        return pa.table({"a": pa.array(a), "b": pa.array(b)})

    return dealt.groupBy("host", "i", "j").applyInArrow(run, "a long, b long").distinct()


def join_documents(docs: DataFrame, s: Similarity) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id`` (the least doc_id that links reach).

    Documents without words have no shingles and no links, not even with each other: they are their own component, as
    are those with a null id that nothing links (null). Equal texts and repeated rows are linked. Null ids never become
    a component's id if another exists. An empty table gives no rows; other columns are ignored.
    """
    return _joined(docs, s).select("doc_id", "n_shingles", "component_id")


def _joined(docs: DataFrame, s: Similarity) -> DataFrame:
    """What ``join_documents`` returns, with ``t``, the hash of the row's text; tables on the way to it are removed."""
    with scratch():
        return stored(_components_of(docs, s), "jaccard-components", keep=True)


def _components_of(docs: DataFrame, s: Similarity) -> DataFrame:
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("t"))
    frequent = docs.sparkSession.sparkContext.broadcast(_frequent(docs, s))
    profiled = stored(profile(docs, s, frequent), "jaccard-profile")
    frequent.destroy()
    payload = F.first(F.when(F.col("s").isNotNull(), F.struct("u", "m", "v", "s", "cool")), ignorenulls=True).alias("x")
    classes = profiled.filter("n > 0").groupBy("c").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), payload)
    classes = stored(classes.select("c", "doc_id", "n", "x.*"), "jaccard-classes")

    # Pivots: of each min-hash cell the most central class, that of fewest rare shingles, or a class drawn by hash.
    cells = classes.select("c", "n", "u", F.posexplode("m").alias("j", "h"))
    central = F.when(F.col("j") % 2 == 0, F.col("u")).otherwise(0)
    drawn = cells.groupBy("j", "h").agg(F.min(F.struct(central.alias("u"), F.xxhash64("j", "c").alias("k"), "c", "n")).alias("p"), F.min("c").alias("least"), F.max("c").alias("most"))
    drawn = drawn.filter("least < most").select("j", "h", F.col("p.c").alias("b"), F.col("p.n").alias("n_b"))
    offered = cells.join(drawn, ["j", "h"]).filter(f"c <> b and {s.den} * least(n, n_b) >= {s.num} * greatest(n, n_b)")
    offered = offered.groupBy(F.col("c").alias("a")).agg(F.collect_set("b").alias("of")).select("a", F.explode("of").alias("b"))
    offered = stored(_possible(offered, classes, s), "jaccard-offered")

    # Voronoi regions: of the pivots within reach the nearest; a class without one stands for itself.
    spokes = _measured(offered.withColumn("reach", F.lit(0.0)), _sets(docs, offered, classes, s, "pivots"), s)
    spokes = stored(spokes.filter("linked").select("a", "b", "d"), "jaccard-spokes")
    nearest = spokes.groupBy("a").agg(F.min(F.struct("d", "b")).alias("at")).select(F.col("a").alias("c"), F.col("at.b").alias("p"), F.col("at.d").alias("d"))
    grouped = components(spokes)
    homes = stored(grouped.join(nearest, "c", "left").select("c", F.col("label").alias("g"), F.coalesce("p", "c").alias("p"), F.coalesce("d", F.lit(0.0)).alias("d")), "jaccard-homes")

    # Root regions. Pairs that meet in a crowded one are found there, whatever else they share.
    placed = classes.join(homes, "c", "left").select("c", "n", "s", "cool", F.coalesce("g", "c").alias("g"), F.coalesce("p", "c").alias("p"), F.coalesce("d", F.lit(0.0)).alias("d"))
    entries = classes.agg(F.sum("cool")).first()[0] or 0
    ranges = max(1, -(-entries // ENTRIES), 3 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    small = placed.select("c", "g", "n", F.posexplode(F.expr("slice(s, 1, cool)")).alias("pos", "s"))
    crowded = placed.filter("size(s) > cool").select("c", "g", "n", "p", "d", F.explode(F.expr("slice(s, cool + 1, size(s))")).alias("s"))
    met = _possible(_joined_regions(small, s, ranges), classes, s).withColumn("reach", F.lit(0.0))
    met = stored(met.union(_crowded_regions(crowded, classes, s)).groupBy("a", "b").agg(F.max("reach").alias("reach")), "jaccard-met")
    measured = stored(_measured(met, _sets(docs, met, classes, s, "met"), s), "jaccard-measured")

    links = spokes.select("a", "b").union(measured.filter("linked").select("a", "b"))
    apart = measured.filter(f"not linked and reach > 0 and d <= reach + {s.reach}").select("a", "b", F.col("d").alias("far"))
    if not apart.isEmpty():
        boundary = stored(_boundaries(apart, homes, classes, s).withColumn("reach", F.lit(0.0)), "jaccard-boundary")
        links = links.union(_measured(boundary, _sets(docs, boundary, classes, s, "boundary"), s).filter("linked").select("a", "b"))

    named = classes.select("c", "doc_id").join(components(links), "c", "left").withColumn("label", F.coalesce("label", "c"))
    least = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    named = named.join(least, "label").select("c", "component_id")
    out = profiled.select("doc_id", "t", "n", F.when(F.col("n") > 0, F.col("c")).alias("c")).join(named, "c", "left")
    return out.select("doc_id", "t", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, s: Similarity | None = None) -> DataFrame:
    """The documents with one of each component, the one of least id, with the columns of ``docs``; rows that repeat
    this id and text leave one. Documents without words all stay."""
    gone = _joined(docs, s or Similarity()).filter("n_shingles > 0 and not (doc_id <=> component_id)").select(_id(F.col("doc_id")).alias("__id"), F.col("t").alias("__t")).distinct()
    empty = F.length(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", "")) == 0
    left = docs.withColumns({"__id": _id(F.col("doc_id")), "__t": F.xxhash64("text")}).join(gone, ["__id", "__t"], "left_anti").withColumn("__empty", empty)
    # Of rows that repeat an id and text one stays. They are partitioned by both already: the window needs no shuffle.
    first = Window.partitionBy("__id", "__t").orderBy(F.lit(0))
    return left.withColumn("__n", F.row_number().over(first)).filter("__empty or __n = 1").select(*docs.columns)


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_documents(table(spark, sf_dir, "documents"), Similarity(words=4, num=85, den=100))


#: Shingle lists, a self-join that counts what two documents share, and the transitive closure of their links. Words have
#: no spaces, so words joined by spaces stand for a shingle.
OP10_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' '))) END AS shingles
  FROM w
), sized AS (SELECT doc_id, len(shingles) AS n, md5(array_to_string(list_sort(shingles), chr(10))) AS class, shingles FROM sets),
classes AS (SELECT class, min(doc_id) AS doc_id, any_value(n) AS n, any_value(shingles) AS shingles FROM sized WHERE n > 0 GROUP BY class),
rows AS (SELECT doc_id, n, unnest(shingles) AS shingle FROM classes),
often AS (SELECT shingle FROM rows GROUP BY shingle HAVING count(*) > 1),
shared AS (SELECT rows.* FROM rows SEMI JOIN often USING (shingle)),
links AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM shared a JOIN shared b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id
  HAVING 100 * count(*) >= 85 * (any_value(a.n) + any_value(b.n) - count(*))
), reached(a, b) AS (
  SELECT a, b FROM links
  UNION
  SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a
), named AS (SELECT c.class, least(c.doc_id, coalesce(min(r.b), c.doc_id)) AS component_id FROM classes c LEFT JOIN reached r ON r.a = c.doc_id GROUP BY c.class, c.doc_id)
SELECT s.doc_id, s.n::BIGINT AS n_shingles, coalesce(m.component_id, s.doc_id) AS component_id
FROM sized s LEFT JOIN named m ON s.n > 0 AND m.class = s.class
"""
