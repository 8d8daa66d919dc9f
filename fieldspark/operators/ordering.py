"""Operators that rest on an order: as-of joins, running sums over ranges, representatives and capped classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges that a running sum over one long order is cut into.
RANGES = 64


def as_of_join(left: DataFrame, right: DataFrame, keys: list[str], at: str, values: list[str]) -> DataFrame:
    """``left`` with the ``values`` of the last row of ``right`` of the same keys at or before ``at``; null if there is none.

    Both sides are sorted together once and the last values are carried forward: no pair of rows is made. Of rows of
    ``right`` at one time the largest values count.
    """
    own = [c for c in left.columns if c not in (*keys, at)]
    last = right.groupBy(*keys, at).agg(F.max(F.struct(*values)).alias("__v"))
    both = left.select(*keys, at, F.struct(*own).alias("__l"), F.lit(None).cast(last.schema["__v"].dataType).alias("__v"), F.lit(1).alias("__side"))
    both = both.unionByName(last.select(*keys, at, F.lit(None).cast(both.schema["__l"].dataType).alias("__l"), "__v", F.lit(0).alias("__side")))
    carried = F.last("__v", ignorenulls=True).over(Window.partitionBy(*keys).orderBy(at, "__side").rowsBetween(Window.unboundedPreceding, 0))
    return both.withColumn("__v", carried).filter("__side = 1").select(*keys, at, "__l.*", "__v.*")


def running_sums(rows: DataFrame, order: str, sums: dict[str, Column], keys: list[str] | None = None) -> DataFrame:
    """``rows`` with sums of all rows of their keys up to and with them, in rising ``order`` (distinct within the keys).

    The order is cut into RANGES ranges of like size; each is summed by itself, and what lies before it is added. So a
    single long order does not run through one task.
    """
    keys = keys or []
    cuts = rows.agg(F.percentile_approx(F.col(order).cast("double"), [i / RANGES for i in range(1, RANGES)])).first()[0] or []
    # No lambda here: the range is a key to group by, and lambdas in such keys are not recognised above the aggregate.
    over = [F.when(F.col(order).cast("double") > F.lit(float(c)), 1).otherwise(0) for c in sorted(set(cuts))]
    ranged = rows.withColumn("__range", sum(over, F.lit(0)))
    before = ranged.groupBy(*keys, "__range").agg(*[F.sum(c).alias(f"__{n}") for n, c in sums.items()])
    earlier = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    before = before.select(*keys, "__range", *[F.coalesce(F.sum(f"__{n}").over(earlier), F.lit(0)).alias(f"__{n}") for n in sums])
    inside = Window.partitionBy(*keys, "__range").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    summed = ranged.withColumns({f"__in_{n}": F.sum(c).over(inside) for n, c in sums.items()}).join(before, [*keys, "__range"])
    return summed.select(*rows.columns, *[(F.col(f"__in_{n}") + F.col(f"__{n}")).alias(n) for n in sums])


def capped_majority(rows: DataFrame, label: str, encounter: str, ratio: float, order: Column) -> DataFrame:
    """One row of each encounter and class, and no more than ``ratio`` times the smallest class of any class, in ``order``
    (a sampling operator)."""
    one = rows.withColumn("__n", F.row_number().over(Window.partitionBy(label, encounter).orderBy(order))).filter("__n = 1").drop("__n")
    sizes = one.groupBy(label).count()
    cap = sizes.agg(F.floor(F.min("count") * ratio).alias("__cap"))
    ranked = one.withColumn("__n", F.row_number().over(Window.partitionBy(label).orderBy(order)))
    return ranked.crossJoin(F.broadcast(cap)).filter("__n <= __cap").drop("__n", "__cap")
