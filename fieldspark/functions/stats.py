"""Statistics as column expressions."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F


def wilson_upper(errors: Column, total: Column, confidence: float = 0.95) -> Column:
    """Upper Wilson bound of an error rate (two-sided z); 1 where nothing was counted."""
    z = NormalDist().inv_cdf(1 - (1 - confidence) / 2)
    p = errors / total
    bound = (p + z * z / (2 * total) + z * F.sqrt(p * (1 - p) / total + z * z / (4 * total * total))) / (1 + z * z / total)
    return F.when(total > 0, F.least(F.lit(1.0), bound)).otherwise(F.lit(1.0))


def entropy(shares: list[Column]) -> Column:
    """Shannon entropy in nats; shares of zero add nothing."""
    return -sum((F.when(p > 0, p * F.ln(p)).otherwise(F.lit(0.0)) for p in shares), F.lit(0.0))


def noisy_or(p: Column) -> Column:
    """Aggregate: probability that one of independent causes acts.

    A cause of probability 1 would be lost in the sum of logarithms (its logarithm is null), hence the guard.
    """
    held = F.greatest(F.lit(0.0), F.least(F.lit(1.0), p))
    some = F.coalesce(-F.expm1(F.sum(F.when(held < 1, F.log1p(-held)))), F.lit(0.0))
    return F.when(F.max(F.when(held >= 1, 1).otherwise(0)) == 1, F.lit(1.0)).otherwise(some)


def logit(p: Column, clip: float = 1e-6) -> Column:
    held = F.greatest(F.lit(clip), F.least(F.lit(1 - clip), p))
    return F.ln(held / (1 - held))


def log_loss(y: Column, p: Column, clip: float = 1e-15) -> Column:
    held = F.greatest(F.lit(clip), F.least(F.lit(1 - clip), p))
    return -(y * F.ln(held) + (1 - y) * F.ln(1 - held))


def distance_weight(distance: Column, radius: float, *, center: float, outer: float, exponent: float) -> Column:
    """Kernel that falls from ``center`` to ``outer`` at the radius."""
    fraction = F.greatest(F.lit(0.0), F.least(F.lit(1.0), distance / radius))
    return outer + (center - outer) * F.pow(1 - fraction, F.lit(exponent))


def ring_weight(ring: Column, rings: int, *, first: float, last: float, exponent: float, digits: int = 6) -> Column:
    """Weight of a ring by power decay from ``first`` (ring 0) to ``last``."""
    return F.round(last + (first - last) * F.pow(1 - ring / rings, F.lit(exponent)), digits)
