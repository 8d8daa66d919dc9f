"""Evaluation designs: cross-fitted conformal sets, propensities, splits, group weights and hierarchical masses."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldspark.functions.stats import log_loss
from fieldspark.operators.ordering import running_sums


def cross_fitted_conformal(rows: DataFrame, classes: Sequence[str], alpha: float = 0.1) -> DataFrame:
    """``id, class, p_value, in_set`` of rows ``id, fold, label, p_<class>``: a row's p-value for a class is the share of
    that class's rows of the other folds whose score 1 - p is no smaller, one added on both sides.

    Counts at or above a score are totals less running sums, over all rows less the row's own fold: no pair of rows is
    made, and no fold is passed over twice.
    """
    each = F.array(*[F.struct(F.lit(c).alias("class"), (1 - F.col(f"p_{c}")).alias("s")) for c in classes])
    long = rows.select("id", "fold", "label", F.inline(each)).withColumn("own", (F.col("label") == F.col("class")).cast("long"))

    def at_least(keys: list[str], name: str) -> DataFrame:
        by = long.groupBy(*keys, "s").agg(F.sum("own").alias("own"))
        total = by.groupBy(*keys).agg(F.sum("own").alias("total"))
        summed = running_sums(by, "s", {"upto": F.col("own")}, keys).join(total, keys)
        return summed.select(*keys, "s", (F.col("total") - F.col("upto") + F.col("own")).alias(name), F.col("total").alias(f"{name}_n"))

    both = long.join(at_least(["class"], "all"), ["class", "s"]).join(at_least(["class", "fold"], "same"), ["class", "fold", "s"])
    p = (F.col("all") - F.col("same") + 1) / (F.col("all_n") - F.col("same_n") + 1)
    return both.select("id", "class", p.alias("p_value"), (p > alpha).alias("in_set"))


def cross_fitted_rate(rows: DataFrame, stratum: str, fold: str, y: str, strength: float = 1.0) -> DataFrame:
    """``rows`` with ``rate``: the share of ``y`` in the row's stratum over the other folds, shrunk to the share of all rows."""
    by = rows.groupBy(stratum, fold).agg(F.sum(y).alias("__y"), F.count(F.lit(1)).alias("__n"))
    total = by.groupBy(stratum).agg(F.sum("__y").alias("__ty"), F.sum("__n").alias("__tn"))
    everywhere = rows.agg(F.avg(y).alias("__all"))
    rate = (F.col("__ty") - F.col("__y") + strength * F.col("__all")) / (F.col("__tn") - F.col("__n") + strength)
    return rows.join(by.join(total, stratum).crossJoin(F.broadcast(everywhere)).select(stratum, fold, rate.alias("rate")), [stratum, fold])


def inverse_propensity(rows: DataFrame, propensity: str, clip: float = 0.05) -> DataFrame:
    """``rows`` with ``weight``: the inverse of the propensity, which is held to ``clip`` at least, at a mean of 1."""
    raw = 1 / F.greatest(F.lit(clip), F.col(propensity))
    mean = rows.agg(F.avg(raw).alias("__mean"))
    return rows.crossJoin(F.broadcast(mean)).withColumn("weight", raw / F.col("__mean")).drop("__mean")


def rolling_origins(rows: DataFrame, day: str, origins: Sequence[date], horizon_days: int) -> DataFrame:
    """``rows`` for each origin: ``TRAIN`` before it, ``TEST`` in the days that follow it; later rows are in neither."""
    parts = []
    for k, start in enumerate(origins):
        end = start + timedelta(days=horizon_days)
        role = F.when(F.col(day) < F.lit(start), "TRAIN").when(F.col(day) < F.lit(end), "TEST")
        parts.append(F.struct(F.lit(k).alias("split"), role.alias("role")))
    return rows.withColumn("__s", F.explode(F.array(*parts))).select(*rows.columns, "__s.*").filter("role is not null")


def held_out(rows: DataFrame, column: str) -> DataFrame:
    """``held_out, train, test``: rows outside and inside of each value of a column, from one count of its values."""
    sizes = rows.groupBy(F.col(column).alias("held_out")).agg(F.count(F.lit(1)).alias("test"))
    total = sizes.agg(F.sum("test").alias("all"))
    return sizes.crossJoin(F.broadcast(total)).select("held_out", (F.col("all") - F.col("test")).alias("train"), "test")


def group_robust_step(rows: DataFrame, group: str, eta: float, weights: dict[str, float] | None = None) -> DataFrame:
    """``group, loss, q``: groups' weights after one exponentiated step on their mean log losses (``y, p, w``), none below
    a hundredth of its even share, at a sum of 1."""
    losses = rows.groupBy(group).agg((F.sum(F.col("w") * log_loss(F.col("y"), F.col("p"), 1e-6)) / F.sum("w")).alias("loss"))
    given = weights or {}
    start = reduce(lambda c, kv: F.when(F.col(group) == kv[0], F.lit(kv[1])).otherwise(c), given.items(), F.lit(1.0))
    raised = losses.withColumn("raw", start * F.exp(eta * F.col("loss")))
    total = raised.agg(F.sum("raw").alias("sum"), F.count(F.lit(1)).alias("k"))
    floored = raised.crossJoin(F.broadcast(total)).withColumn("q", F.greatest(F.col("raw") / F.col("sum"), 0.01 / F.col("k")))
    again = floored.agg(F.sum("q").alias("all"))
    return floored.crossJoin(F.broadcast(again)).select(group, "loss", (F.col("q") / F.col("all")).alias("q"))


def hierarchical_masses(known: Column, first: Column, names: tuple[str, str, str]) -> dict[str, Column]:
    """Masses of two classes and of what is neither, from the chance to be one of them and that of the first among them."""
    return {names[0]: known * first, names[1]: known * (1 - first), names[2]: 1 - known}


def usable_folds(rows: DataFrame, label: str, requested: int) -> DataFrame:
    """``folds``: no more than the smallest class has rows."""
    return rows.groupBy(label).count().agg(F.least(F.lit(requested), F.min("count")).cast("int").alias("folds"))


def best_blend(rows: DataFrame, keys: list[str], steps: int = 21) -> DataFrame:
    """``keys, n, weight, brier``: the blend weight of the challenger ``q`` against ``p``, among even steps from 0 to 1, of
    least weighted Brier score (the smallest of equal ones). The score is quadratic in the weight: three sums decide."""
    d, e, w = F.col("q") - F.col("p"), F.col("p") - F.col("y"), F.col("w")
    sums = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), (F.sum(w * d * d) / F.sum(w)).alias("dd"), (F.sum(w * d * e) / F.sum(w)).alias("de"), (F.sum(w * e * e) / F.sum(w)).alias("ee"))
    tried = F.transform(F.sequence(F.lit(0), F.lit(steps - 1)), lambda k: F.struct(F.round(F.col("ee") + 2 * (k / (steps - 1)) * F.col("de") + (k / (steps - 1)) * (k / (steps - 1)) * F.col("dd"), 12).alias("brier"), (k / (steps - 1)).alias("weight")))
    return sums.withColumn("b", F.array_min(tried)).select(*keys, "n", "b.weight", "b.brier")


def shrunk_blend(local: DataFrame, overall: DataFrame, minimum: int = 100, strength: float = 200.0) -> DataFrame:
    """``local`` (``stratum, n, weight``) with ``shrunk``: n / (n + strength) of the stratum's weight and the rest of the
    overall one, never above it; strata below the minimum keep the baseline (0)."""
    share = F.col("n") / (F.col("n") + strength)
    mixed = share * F.col("weight") + (1 - share) * F.col("__all")
    out = local.crossJoin(F.broadcast(overall.select(F.col("weight").alias("__all"))))
    return out.withColumn("shrunk", F.when(F.col("n") >= minimum, F.least("__all", mixed)).otherwise(0.0)).drop("__all")
