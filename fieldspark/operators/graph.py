"""Weighted graphs as edge tables: collapse to parents, bounded shortest paths, chains, kernel-weighted evidence."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldspark.functions.stats import noisy_or
from fieldspark.operators.lineage import cut


def undirected(edges: DataFrame) -> DataFrame:
    """Both directions of each edge, the least weight where several join a pair; loops go."""
    one = edges.filter("src <> dst").groupBy(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).agg(F.min("weight").alias("weight"))
    return one.unionByName(one.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"))


def connected(edges: DataFrame, keep: Callable[[DataFrame], DataFrame] = cut) -> DataFrame:
    """``node, component`` (the least node) of every node of the edges ``src, dst``; ``keep`` cuts the lineage of a round.

    Each node points at the least node next to it. A round joins those that one node points at, and lets pointers jump,
    until nothing moves: the number of rounds grows with the logarithm of the longest chain. Nothing is collected but
    whether a pointer moved, and partial minima bear a node that a third of all edges touch.
    """
    stars = keep(edges.select(F.greatest("src", "dst").alias("a"), F.least("src", "dst").alias("b")).filter("a <> b").distinct())
    while True:
        least = stars.groupBy("a").agg(F.min("b").alias("m"))
        other = F.col("b") != F.col("m")
        linked = stars.join(least, "a").select(F.when(other, F.col("b")).otherwise(F.col("a")).alias("a"), F.col("m").alias("b"), other.alias("moved"))
        above = least.select(F.col("a").alias("b"), F.col("m").alias("above"))
        jumped = linked.join(above, "b", "left").select("a", F.coalesce("above", "b").alias("b"), (F.col("moved") | F.col("above").isNotNull()).alias("moved"))
        after = keep(jumped.groupBy("a", "b").agg(F.max("moved").alias("moved")))
        if after.filter("moved").isEmpty():
            roots = after.select(F.col("b").alias("node")).distinct()
            return after.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots.select("node", F.col("node").alias("component")))
        stars = after.select("a", "b")


def collapse(edges: DataFrame, parents: DataFrame) -> DataFrame:
    """Edges between the parents (``node, parent``) of their ends, the least weight of each pair."""
    a, b = parents.select(F.col("node").alias("src"), F.col("parent").alias("p1")), parents.select(F.col("node").alias("dst"), F.col("parent").alias("p2"))
    return undirected(edges.join(a, "src").join(b, "dst").select(F.col("p1").alias("src"), F.col("p2").alias("dst"), "weight"))


def within(edges: DataFrame, origins: DataFrame, bound: float) -> DataFrame:
    """``origin, node, distance`` of all nodes that an origin (``node``) reaches within ``bound``.

    Rounds relax the edges of what improved last; a round keeps the least distance of each pair only. Weights are
    positive, so there are no more rounds than edges on a path within the bound.
    """
    best = cut(origins.select(F.col("node").alias("origin"), "node").distinct().withColumn("distance", F.lit(0.0)))
    front = best
    while True:
        step = (
            front.join(edges, front["node"] == edges["src"])
            .select("origin", F.col("dst").alias("node"), (F.col("distance") + F.col("weight")).alias("distance"))
            .filter(F.col("distance") <= bound)
            .groupBy("origin", "node")
            .agg(F.min("distance").alias("distance"))
        )
        known = best.select("origin", "node", F.col("distance").alias("known"))
        front = cut(step.join(known, ["origin", "node"], "left").filter("known is null or distance < known").drop("known"))
        if front.isEmpty():
            return best
        best = cut(best.unionByName(front).groupBy("origin", "node").agg(F.min("distance").alias("distance")))


#: Links of a task: they are dealt by number, as adaptive execution would go by bytes, of which packed ids have few. Targets
#: with more than this share of as many are looked up by broadcast, the heaviest first and no more than its inverse.
TASK_ROWS, HEAVY = 200_000, 0.01


def resolve_chains(links: DataFrame) -> DataFrame:
    """End of the chain of each ``alias -> target`` link, by doubling; a cycle is an error.

    A chain has no more steps than there are links, so one that still moves after as many doublings is a cycle. Links
    that have come to an end are set aside, as many end at one target; heavy targets of the others are told apart, so
    that no task gets all links of one.
    """
    size = links.count()
    tasks = size // TASK_ROWS + 1
    first = cut(links.select("alias", "target").repartition(tasks, "alias").distinct())
    if not first.groupBy("alias").count().filter("count > 1").isEmpty():
        raise ValueError("an alias has two targets")
    known = first.select(F.col("alias").alias("target"), F.lit(True).alias("open"))
    now = cut(_looked_up(first, known, tasks).select("alias", "target", F.coalesce("open", F.lit(False)).alias("open")))
    ended = []
    for _ in range(size.bit_length() + 1):
        ended.append(now.filter("not open"))
        moving = now.filter("open")
        if moving.isEmpty():
            return reduce(DataFrame.unionByName, ended).select("alias", "target")
        on = reduce(DataFrame.unionByName, [*ended, moving]).select(F.col("alias").alias("target"), F.col("target").alias("beyond"), F.col("open").alias("on"))
        step = cut(_looked_up(moving.select("alias", "target"), on, tasks))
        if not step.filter("beyond = alias or alias = target").isEmpty():
            raise ValueError("aliases form a cycle")
        now = step.select("alias", F.col("beyond").alias("target"), F.col("on").alias("open"))
    raise ValueError("aliases form a cycle")


def _looked_up(rows: DataFrame, by: DataFrame, tasks: int) -> DataFrame:
    """Left join on ``target``, distinct in ``by``; what heavy targets of ``rows`` give is broadcast."""
    most = rows.groupBy("target").count().orderBy(F.desc("count")).limit(int(1 / HEAVY)).collect()
    heavy = [r["target"] for r in most if r["count"] > TASK_ROWS * HEAVY and r["target"] is not None]
    hot = F.coalesce(F.col("target").isin(heavy), F.lit(False))
    dealt = rows.filter(~hot).repartition(tasks, "target").join(by.repartition(tasks, "target"), "target", "left")
    return dealt.unionByName(rows.filter(hot).join(F.broadcast(by.filter(hot)), "target", "left")) if heavy else dealt


def intensity(grid: DataFrame, reach: DataFrame, weight: Column) -> DataFrame:
    """Adds ``intensity`` to a grid of ``cell, period_start, mature_expected_count``.

    Evidence of a cell spreads to the cells it reaches (``origin, node, distance``) with the kernel weight; causes in a
    cell and period combine by noisy-or, and a cell's own count of 1 or more is certain.
    """
    sources = grid.filter("mature_expected_count > 0").select(F.col("cell").alias("origin"), "period_start", "mature_expected_count")
    causes = sources.join(reach, "origin").select(F.col("node").alias("cell"), "period_start", (F.col("mature_expected_count") * weight).alias("p"))
    heard = causes.groupBy("cell", "period_start").agg(noisy_or(F.col("p")).alias("heard"))
    own = F.when(F.col("mature_expected_count") >= 1, 1.0).otherwise(F.coalesce("heard", F.lit(0.0)))
    return grid.join(heard, ["cell", "period_start"], "left").withColumn("intensity", own).drop("heard")


def degree_summary(edges: DataFrame) -> DataFrame:
    return edges.groupBy("src").agg(F.count(F.lit(1)).alias("degree"), F.min("weight").alias("nearest"))


def diffuse(edges: DataFrame, seeds: DataFrame, time: float, terms: int = 12) -> DataFrame:
    """Heat-kernel diffusion exp(-time x Laplacian) of ``node, mass``, by its Taylor series in edge joins.

    Each term applies the normalised Laplacian once; the series is cut at ``terms``, enough for times up to about 2.
    """
    degree = edges.groupBy("src").agg(F.sum("weight").alias("degree")).withColumnRenamed("src", "node")
    total = seeds.select("node", F.col("mass").cast("double").alias("mass"))
    term = total
    for k in range(1, terms + 1):
        spread = (
            term.join(degree, "node").join(edges, F.col("node") == F.col("src")).select(F.col("dst").alias("node"), (F.col("mass") * F.col("weight") / F.col("degree")).alias("mass"))
        )
        stay = term.select("node", (-F.col("mass")).alias("mass"))
        term = cut(spread.unionByName(stay).groupBy("node").agg((F.sum("mass") * (time / k)).alias("mass")))
        total = cut(total.unionByName(term).groupBy("node").agg(F.sum("mass").alias("mass")))
    return total


def routes(edges: DataFrame, asked: DataFrame, bound: float) -> DataFrame:
    """``origin, destination, distance`` of asked pairs within the bound; what lies beyond it or apart has no distance."""
    reach = within(edges, asked.select(F.col("origin").alias("node")).distinct(), bound).withColumnRenamed("node", "destination")
    return asked.join(reach, ["origin", "destination"], "left")


def sub_graph(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """The edges with both ends among ``nodes`` (``node``)."""
    ends = lambda c: nodes.select(F.col("node").alias(c)).distinct()
    return edges.join(ends("src"), "src", "left_semi").join(ends("dst"), "dst", "left_semi")
