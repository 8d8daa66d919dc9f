"""Sharding by a hierarchical weighted hash tree (operator 2, DataFrame functions only).

A tree has regions, regions have racks, racks have shards with positive weights; a node weighs what its leaves weigh.
A row descends the tree: at each node every child draws an exponential variate from a keyed hash of (doc_id, child),
divided by the child's weight, and the least draw wins. A change of weights therefore moves rows only into or out of
nodes whose weight changed; what lies in other subtrees stays. ``grown`` appends a shard as a subtree of its own below
the root, so that rows move into that shard only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldspark.llm.common import table

#: Hash ranges of a shard that are numbered one by one; bounds the rows that one task sorts, and the table of offsets.
SLOT_RANGES = 4096


@dataclass(frozen=True)
class Tree:
    """``regions[r][k]`` are the (shard, weight) leaves of rack k in region r."""

    regions: tuple[tuple[tuple[tuple[int, float], ...], ...], ...]

    @classmethod
    def even(cls, shards: int, racks_per_region: int = 3, shards_per_rack: int = 4) -> Tree:
        """Shards 0 .. shards-1 of weight 1, filled rack by rack and region by region."""
        if shards < 1:
            raise ValueError("a tree needs a shard")
        racks = [tuple((s, 1.0) for s in range(a, min(a + shards_per_rack, shards))) for a in range(0, shards, shards_per_rack)]
        return cls(tuple(tuple(racks[a : a + racks_per_region]) for a in range(0, len(racks), racks_per_region)))

    def shards(self) -> list[int]:
        return [s for region in self.regions for rack in region for s, _ in rack]

    def grown(self, weight: float = 1.0) -> Tree:
        """One more shard, in a new region of its own: rows move only into it."""
        return Tree((*self.regions, (((max(self.shards()) + 1, weight),),)))

    def check(self) -> None:
        leaves = [w for region in self.regions for rack in region for _, w in rack]
        if not leaves or min(leaves) <= 0:
            raise ValueError("weights must be positive")
        if len(set(self.shards())) != len(leaves):
            raise ValueError("a shard occurs twice")


def _key(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("string"), F.lit("null"))


def _uniform(key: Column, node: Column) -> Column:
    """In (0, 1): 48 bits of md5(key, node)."""
    bits = F.conv(F.substring(F.md5(F.concat_ws("/", key, node).cast("binary")), 1, 12), 16, 10).cast("long")
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 48))


def _children(nodes: list[tuple[str, float, int]]) -> Column:
    return F.array(*[F.struct(F.lit(name).alias("node"), F.lit(float(weight)).alias("weight"), F.lit(i).alias("i")) for name, weight, i in nodes])


def _least(children: Column, key: Column) -> Column:
    """Number of the child whose exponential draw is least."""
    draws = F.transform(children, lambda c: F.struct((-F.ln(_uniform(key, c["node"])) / c["weight"]).alias("draw"), c["i"].alias("i")))
    return F.array_min(draws)["i"]


def place(df: DataFrame, tree: Tree, key: str = "__key", out: str = "shard") -> DataFrame:
    """Adds the shard of every row as column ``out``: one projection for each level, the tree being a constant in it."""
    tree.check()
    weigh = lambda racks: sum(w for rack in racks for _, w in rack)
    racks, at = [], []
    for r, region in enumerate(tree.regions):
        at.append(_children([(f"g{r}.{k}", weigh([rack]), len(racks) + k) for k, rack in enumerate(region)]))
        racks += [(f"g{r}.{k}", rack) for k, rack in enumerate(region)]
    top = _children([(f"g{r}", weigh(region), r) for r, region in enumerate(tree.regions)])
    leaves = F.array(*[_children([(f"{name}.{s}", w, s) for s, w in rack]) for name, rack in racks])
    df = df.withColumn("__region", _least(top, F.col(key)))
    df = df.withColumn("__rack", _least(F.get(F.array(*at), F.col("__region")), F.col(key)))
    return df.withColumn(out, _least(F.get(leaves, F.col("__rack")), F.col(key))).drop("__region", "__rack")


def shard_documents(docs: DataFrame, tree: Tree) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    Placement depends on doc_id alone (null ids share one key), so copies of a row land together. ``size`` is the UTF-8
    length of the text plus 8, a null text counting as none and its crc32 as that of the empty text. ``slot`` numbers a
    shard's rows from 0 by (hash of doc_id, doc_id, size, crc32), rows equal in all four in any order. An empty table
    gives no rows; other columns of ``docs`` are ignored.

    A shard's rows are numbered in ``SLOT_RANGES`` ranges of that hash: each range is a group of its own, and ranges
    start at the sum of the counts before them (at most shards x SLOT_RANGES rows, hence the broadcast).
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").alias("doc_id"),
        (F.octet_length(text).cast("long") + F.lit(8)).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        _key(F.col("doc_id")).alias("__key"),
    )
    rows = rows.withColumn("__h", F.conv(F.substring(F.md5(F.concat(F.lit("slot/"), F.col("__key")).cast("binary")), 1, 12), 16, 10).cast("long"))
    rows = rows.withColumn("__range", F.shiftright("__h", 36).cast("int"))
    rows = place(place(rows, tree, out="shard"), tree.grown(), out="grown_shard")
    keys = place(
        docs.select(_key(F.col("doc_id")).alias("__key")).withColumn(
            "__range",
            F.shiftright(F.conv(F.substring(F.md5(F.concat(F.lit("slot/"), F.col("__key")).cast("binary")), 1, 12), 16, 10).cast("long"), 36).cast("int"),
        ),
        tree,
    )
    counts = keys.groupBy("shard", "__range").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "__range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "__range").orderBy("__h", "doc_id", "size", "text_crc32")
    numbered = rows.withColumn("__n", F.row_number().over(within))
    return numbered.join(F.broadcast(starts), ["shard", "__range"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("start") + F.col("__n") - 1).alias("slot"),
        "grown_shard",
    )


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), Tree.even(24))
