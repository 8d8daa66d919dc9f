"""Evaluation of probabilities: grouped metrics, calibration, coverage and acceptance, all as aggregates.

Rows carry ``y`` (0 or 1), ``p`` (probability of 1) and ``w`` (weight).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldspark.functions.stats import log_loss, wilson_upper
from fieldspark.operators.ordering import running_sums


def summary(rows: DataFrame, keys: list[str] | None = None, threshold: float = 0.5) -> DataFrame:
    """Weighted losses, confusion counts and rates by key."""
    w, y, p = F.col("w"), F.col("y"), F.col("p")
    hit = p >= threshold
    mass = lambda test: F.sum(F.when(test, w).otherwise(0.0))
    out = rows.groupBy(*(keys or [])).agg(
        F.count(F.lit(1)).alias("n"),
        (F.sum(w * y) / F.sum(w)).alias("prevalence"),
        (F.sum(w * log_loss(y, p)) / F.sum(w)).alias("log_loss"),
        (F.sum(w * (p - y) * (p - y)) / F.sum(w)).alias("brier"),
        mass(hit & (y == 1)).alias("tp"),
        mass(hit & (y == 0)).alias("fp"),
        mass(~hit & (y == 1)).alias("fn"),
        mass(~hit & (y == 0)).alias("tn"),
    )
    rate = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    c = F.col
    out = out.withColumns({"accuracy": (c("tp") + c("tn")) / (c("tp") + c("tn") + c("fp") + c("fn")), "precision": rate(c("tp"), c("tp") + c("fp")), "recall": rate(c("tp"), c("tp") + c("fn"))})
    return out.withColumns({"balanced_accuracy": (c("recall") + rate(c("tn"), c("tn") + c("fp"))) / 2, "f1": rate(2 * c("precision") * c("recall"), c("precision") + c("recall"))})


def auc(rows: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Area under the ROC curve from counts by score: pairs of a higher positive, ties counting half.

    Scores are grouped first, and the running sum goes over ranges of scores.
    """
    keys = keys or []
    by = rows.groupBy(*keys, "p").agg(F.sum("y").cast("double").alias("pos"), F.sum(1 - F.col("y")).cast("double").alias("neg"))
    pairs = running_sums(by, "p", {"upto": F.col("neg")}, keys)
    total = pairs.groupBy(*keys).agg(F.sum(F.col("pos") * (F.col("upto") - F.col("neg") / 2)).alias("u"), (F.sum("pos") * F.sum("neg")).alias("all"))
    return total.select(*keys, F.when(F.col("all") > 0, F.col("u") / F.col("all")).alias("auc"))


def average_precision(rows: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Precision at each score from the top, weighted by the recall that it adds."""
    keys = keys or []
    by = rows.groupBy(*keys, (-F.col("p")).alias("down")).agg(F.sum("y").cast("double").alias("pos"), F.count(F.lit(1)).cast("double").alias("n"))
    cum = running_sums(by, "down", {"tp": F.col("pos"), "seen": F.col("n")}, keys)
    return cum.groupBy(*keys).agg((F.sum(F.col("pos") * F.col("tp") / F.col("seen")) / F.sum("pos")).alias("average_precision"))


def reliability(rows: DataFrame, bins: int = 10, keys: list[str] | None = None) -> DataFrame:
    """Right-closed bins of equal width: rows, mean probability and share of ones."""
    at = F.greatest(F.lit(0), F.least(F.lit(bins - 1), F.ceil(F.col("p") * bins).cast("int") - 1))
    return rows.withColumn("bin", at).groupBy(*(keys or []), "bin").agg(F.count(F.lit(1)).alias("n"), F.avg("p").alias("confidence"), F.avg("y").alias("frequency"))


def calibration_error(rows: DataFrame, bins: int = 10) -> DataFrame:
    """Mean gap of the reliability bins, weighted by their rows."""
    b = reliability(rows, bins)
    return b.agg((F.sum(F.col("n") * F.abs(F.col("confidence") - F.col("frequency"))) / F.sum("n")).alias("ece"))


def equal_mass_error(rows: DataFrame, id_column: str, bins: int = 10) -> DataFrame:
    """Calibration error over bins of equal numbers of rows in order of score and id (the first bins have one row more
    where they do not come out even).

    A row's number is that of its score's first row, from running sums over ranges of scores, and its place in it.
    """
    by = rows.groupBy("p").agg(F.count(F.lit(1)).alias("same"))
    before = running_sums(by, "p", {"upto": F.col("same")}).select("p", (F.col("upto") - F.col("same")).alias("before"))
    place = F.row_number().over(Window.partitionBy("p").orderBy(id_column)) + F.col("before")
    total = rows.agg(F.count(F.lit(1)).alias("all"))
    numbered = rows.join(before, "p").withColumn("place", place - 1).crossJoin(F.broadcast(total))
    small, larger = F.floor(F.col("all") / bins), F.col("all") % bins
    edge = larger * (small + 1)
    tile = numbered.withColumn("bin", F.when(F.col("place") < edge, F.floor(F.col("place") / (small + 1))).otherwise(larger + F.floor((F.col("place") - edge) / small)))
    b = tile.groupBy("bin").agg(F.sum("w").alias("w"), (F.sum(F.col("w") * F.col("p")) / F.sum("w")).alias("c"), (F.sum(F.col("w") * F.col("y")) / F.sum("w")).alias("f"))
    return b.agg((F.sum(F.col("w") * F.abs(F.col("c") - F.col("f"))) / F.sum("w")).alias("equal_mass_ece"))


def risk_coverage(rows: DataFrame, thresholds: list[float]) -> DataFrame:
    """Rows accepted at each confidence threshold, their errors, risk and its Wilson bound.

    Each row is counted once at the highest threshold that it passes; running sums give the others.
    """
    confidence = F.greatest("p", 1 - F.col("p"))
    wrong = F.when((F.col("p") >= 0.5).cast("int") != F.col("y"), 1).otherwise(0)
    spark = rows.sparkSession
    steps = sorted(thresholds)
    level = sum((F.when(confidence >= t, 1).otherwise(0) for t in steps), F.lit(0))
    by = rows.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n"), F.sum(wrong).alias("e"))
    grid = spark.createDataFrame([(i + 1, t) for i, t in enumerate(steps)], "at int, threshold double")
    total = rows.agg(F.count(F.lit(1)).alias("rows"))
    out = grid.join(F.broadcast(by), F.col("level") >= F.col("at"), "left").groupBy("threshold").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("accepted"), F.coalesce(F.sum("e"), F.lit(0)).alias("errors"))
    out = out.join(F.broadcast(total))
    return out.select(
        "threshold", "accepted", "errors", (F.col("accepted") / F.col("rows")).alias("coverage"), F.when(F.col("accepted") > 0, F.col("errors") / F.col("accepted")).alias("risk"), wilson_upper(F.col("errors"), F.col("accepted")).alias("upper")
    )


def accept_threshold(curve: DataFrame, target: float) -> DataFrame:
    """Of the thresholds whose bound meets the target the one that accepts most (then the least); none gives no row."""
    return curve.filter((F.col("upper") <= target) & (F.col("accepted") > 0)).orderBy(F.desc("accepted"), "threshold").limit(1)


def stratified(rows: DataFrame, sets: list[list[str]]) -> DataFrame:
    """Metrics over several sets of dimensions in one pass: GROUPING SETS, with the dimensions of each row named."""
    columns = list(dict.fromkeys(c for s in sets for c in s))
    view = f"stratified_{abs(hash(tuple(map(tuple, sets))))}"
    rows.createOrReplaceTempView(view)
    groups = ", ".join(f"({', '.join(s)})" for s in sets)
    picked = ", ".join(columns)
    names = ", ".join(f"CASE WHEN grouping({c}) = 0 THEN '{c}' END" for c in columns)
    return rows.sparkSession.sql(
        f"SELECT concat_ws('+', {names}) AS dimensions, {picked}, count(*) AS n, avg(y) AS prevalence, avg((p - y) * (p - y)) AS brier FROM {view} GROUP BY GROUPING SETS ({groups})"
    )


def poststratification(sample: DataFrame, reference: DataFrame, strata: list[str]) -> DataFrame:
    """Weights that give the sample the reference's shares of strata, with mean 1."""
    share = lambda df, name: df.groupBy(*strata).agg(F.count(F.lit(1)).alias(name))
    both = share(sample, "s").join(share(reference, "r"), strata)
    total = both.agg(F.sum("s").alias("ss"), F.sum("r").alias("rr"))
    return both.join(F.broadcast(total)).select(*strata, ((F.col("r") / F.col("rr")) / (F.col("s") / F.col("ss"))).alias("weight"))


def robust_weights(rows: DataFrame, group: str, strength: float = 1.0) -> DataFrame:
    """Factor by group toward the geometric mean of the groups' weights, kept from 1/4 to 4."""
    by = rows.groupBy(group).agg(F.sum("w").alias("total"))
    mean = by.agg(F.exp(F.avg(F.ln("total"))).alias("mean"))
    return by.join(F.broadcast(mean)).select(group, F.greatest(F.lit(0.25), F.least(F.lit(4.0), F.pow(F.col("mean") / F.col("total"), F.lit(strength)))).alias("factor"))


def inverse_propensity(chance: Column, floor: float = 0.05) -> Column:
    """Weight of a labelled row before it is divided by its mean."""
    return 1 / F.greatest(chance, F.lit(floor))


def conformal_p_values(calibration: DataFrame, queries: DataFrame) -> DataFrame:
    """p = (calibration scores at least as strange + 1) / (their number + 1), for each class of each query.

    ``calibration`` has ``label, score``, ``queries`` has ``id, label, score``. Scores of both are counted together by
    running sums over ranges of scores, so that no query meets every calibration row and no label is one task.
    """
    own = calibration.select("label", "score", F.lit(1).alias("own")).unionByName(queries.select("label", "score", F.lit(0).alias("own")))
    by = own.groupBy("label", "score").agg(F.sum("own").alias("own"))
    total = by.groupBy("label").agg(F.sum("own").alias("n"))
    ranked = running_sums(by, "score", {"upto": F.col("own")}, ["label"]).join(total, "label")
    counted = ranked.select("label", "score", ((F.col("n") - F.col("upto") + F.col("own") + 1) / (F.col("n") + 1)).alias("p_value"))
    return queries.join(counted, ["label", "score"]).select("id", "label", "p_value")


def blend_search(rows: DataFrame, base: str, other: str, strata: str, tolerance: float, steps: int = 21, minimum: int = 1) -> DataFrame:
    """Brier loss of each blend of two probabilities, and the worst degradation over strata of enough rows.

    The steps are constants within the row, so each row is expanded in place and aggregated before the shuffle.
    """
    grid = F.array(*[F.lit(i / (steps - 1)) for i in range(steps)])
    mixed = rows.select(strata, "y", F.col(base).alias("b"), F.col(other).alias("o"), F.explode(grid).alias("share"))
    loss = lambda p: (p - F.col("y")) * (p - F.col("y"))
    by = mixed.groupBy("share", strata).agg(F.count(F.lit(1)).alias("n"), F.sum(loss(F.col("b") * (1 - F.col("share")) + F.col("o") * F.col("share"))).alias("l"), F.sum(loss(F.col("b"))).alias("l0"))
    out = by.groupBy("share").agg((F.sum("l") / F.sum("n")).alias("brier"), F.max(F.when(F.col("n") >= minimum, (F.col("l") - F.col("l0")) / F.col("n"))).alias("worst"))
    return out.withColumn("allowed", F.col("worst") <= tolerance)


def gate(metrics: DataFrame, stratum: list[str], model: str, baseline: str, minimum: int) -> DataFrame:
    """Per model: strata compared with the baseline's, those that got worse, and the largest degradation."""
    base = metrics.filter(F.col(model) == baseline).select(*stratum, F.col("brier").alias("base"))
    both = metrics.filter((F.col(model) != baseline) & (F.col("n") >= minimum)).join(base, stratum)
    worse = F.col("brier") - F.col("base")
    return both.groupBy(model).agg(F.count(F.lit(1)).alias("strata"), F.sum(F.when(worse > 0, 1).otherwise(0)).alias("failed"), F.max(worse).alias("largest"))


def review_priority(rows: DataFrame, strata: str, top: int) -> DataFrame:
    """The rows most worth a review of each stratum: near an even probability, ties by id (a top-k report)."""
    margin = F.abs(F.col("p") - 0.5)
    w = Window.partitionBy(strata).orderBy(margin, "id")
    return rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)
