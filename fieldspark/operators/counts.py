"""Counts by cell, period and label; expected mass; dense calendars and grids."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldspark.functions.policies import CountPolicy
from fieldspark.functions.temporal import period_fields, week_start

HARD = ("sighting_count", "source_report_count", "observed_count", "imputed_count")
EXPECTED = ("expected_count", "mature_expected_count", "provisional_expected_count", "expected_unknown_count")


def effective_labels(obs: DataFrame) -> DataFrame:
    """Labels after imputation where they are given beside the observed ones."""
    for name in ("detail", "bucket"):
        if f"{name}_effective" in obs.columns:
            obs = obs.withColumn(name, F.col(f"{name}_effective"))
    return obs


def expected_contributions(obs: DataFrame, policy: CountPolicy | None = None) -> DataFrame:
    """Each observation as up to four additive contributions of its unit mass.

    Labels with a column of their own become that label (the unknown one in the other bucket); the other column keeps
    the observation's own label in the other bucket; rows without any mass count 1 under their own label.
    """
    policy = policy or CountPolicy()
    have = set(obs.columns)
    own = lambda label: F.when(F.col("detail") == label, 1.0).otherwise(0.0)
    weights: list[tuple[Column, Column, Column, bool]] = []
    total = F.lit(0.0)
    for label, column in policy.expected_columns.items():
        weight = F.coalesce(F.col(column), F.lit(0.0)) if column in have else own(label)
        unknown = label == policy.unknown_label
        weights.append((F.lit(label), F.lit(policy.other_bucket if unknown else label), weight, unknown))
        total = total + weight
    if policy.other_column in have:
        other = F.coalesce(F.col(policy.other_column), F.lit(0.0))
        weights.append((F.col("detail"), F.lit(policy.other_bucket), other, False))
        total = total + other
    weights.append((F.col("detail"), F.col("bucket"), F.when(total == 0, 1.0).otherwise(0.0), False))
    parts = F.array(*[F.struct(d.alias("detail"), b.alias("bucket"), w.alias("w"), F.lit(u).alias("unknown")) for d, b, w, u in weights])
    rest = [c for c in obs.columns if c not in ("detail", "bucket")]
    rows = obs.select(*rest, F.explode(F.filter(parts, lambda x: x["w"] > 0)).alias("__part"))
    mature = ~(F.coalesce(F.col("context_status"), F.lit("")) == "PROVISIONAL_RECENT") if "context_status" in have else F.lit(True)
    w = F.col("__part.w")
    return rows.select(
        *rest,
        F.col("__part.detail").alias("detail"),
        F.col("__part.bucket").alias("bucket"),
        w.alias("expected_count"),
        F.when(mature, w).otherwise(0.0).alias("mature_expected_count"),
        F.when(mature, 0.0).otherwise(w).alias("provisional_expected_count"),
        F.when(F.col("__part.unknown"), w).otherwise(0.0).alias("expected_unknown_count"),
    ).drop("__part")


def mass_violations(obs: DataFrame, columns: list[str], tolerance: float = 1e-9) -> DataFrame:
    """One row of counts: masses that are not finite, outside [0, 1], or do not sum to 1."""
    values = [F.col(c) for c in columns]
    bad = lambda test: F.coalesce(F.sum(F.when(test, 1)), F.lit(0))
    infinite = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    not_finite = F.lit(False)
    outside = F.lit(False)
    for v in values:
        not_finite = not_finite | infinite(v)
        outside = outside | (~infinite(v) & ~v.between(0, 1))
    total = sum(values, F.lit(0.0))
    return obs.agg(
        F.count(F.lit(1)).alias("rows"), bad(not_finite).alias("not_finite"), bad(outside).alias("outside"), bad(~not_finite & (F.abs(total - 1) > tolerance)).alias("not_unit")
    )


def daily_counts(obs: DataFrame, keys: list[str], contributions: DataFrame | None = None) -> DataFrame:
    """Hard counts and expected mass by ``keys`` and day; a label may have one without the other.

    Rows with a null key are left out. Hard counts are of distinct observations.
    """
    by = [*keys, "period_start"]
    known = lambda df: df.dropna(subset=by)
    applied = F.coalesce(F.col("imputation_applied"), F.lit(False))
    hard = known(obs).groupBy(*by).agg(
        F.countDistinct("observation_id").alias("sighting_count"),
        F.sum("source_report_count").alias("source_report_count"),
        F.sum(F.when(applied, 0).otherwise(1)).alias("observed_count"),
        F.sum(F.when(applied, 1).otherwise(0)).alias("imputed_count"),
    )
    if contributions is None:
        return hard
    soft = known(contributions).groupBy(*by).agg(*[F.sum(c).alias(c) for c in EXPECTED])
    return hard.join(soft, by, "full").fillna(0, subset=[*HARD, *EXPECTED])


def weekly_counts(daily: DataFrame, keys: list[str], measures: list[str], start: date, end: date, keep_open: bool = False) -> DataFrame:
    """Daily counts by Monday weeks. Weeks that the window cuts are dropped; ``keep_open`` keeps its last one as OPEN."""
    weeks = daily.withColumn("period_start", week_start(F.col("period_start"))).groupBy(*keys, "period_start").agg(*[F.sum(m).alias(m) for m in measures])
    whole = (F.col("period_start") >= F.lit(start)) & (F.date_add("period_start", 6) <= F.lit(end))
    last = (F.col("period_start") == week_start(F.lit(end))) & ~whole
    kept = weeks.filter(whole | last) if keep_open else weeks.filter(whole)
    return kept.withColumns(period_fields(F.col("period_start"), "weekly")).withColumns(
        {"period_status": F.when(last, "OPEN").otherwise("COMPLETE"), "is_complete_period": ~last}
    )


def periods(spark, start: date, end: date, frequency: str, verified: bool, keep_open: bool = False) -> DataFrame:
    """Calendar of the window: days, or Monday weeks within it. Without verified coverage no period is complete."""
    if start > end:
        raise ValueError("the window is empty")
    step, first = ("INTERVAL 1 DAY", F.lit(start)) if frequency == "daily" else ("INTERVAL 7 DAYS", week_start(F.lit(start)))
    rows = spark.range(1).select(F.explode(F.sequence(first, F.lit(end), F.expr(step))).alias("period_start"))
    rows = rows.withColumns(period_fields(F.col("period_start"), frequency))
    whole = (F.col("period_start") >= F.lit(start)) & (F.col("period_end") <= F.lit(end))
    rows = rows.withColumn("__whole", whole).filter(F.col("__whole") | (F.lit(keep_open) & (F.col("period_start") >= F.lit(start))))
    status = F.when(F.lit(not verified), "UNVERIFIED_COVERAGE").when(F.col("__whole"), "COMPLETE").otherwise("OPEN")
    return rows.withColumns({"period_status": status, "is_complete_period": F.col("__whole") & F.lit(verified)}).drop("__whole")


def fill_calendar(counts: DataFrame, calendar: DataFrame, measures: list[str]) -> DataFrame:
    """Calendar rows with their counts, zero where there are none."""
    return calendar.join(counts.select("period_start", *measures), "period_start", "left").fillna(0, subset=measures)


def reporting_state(count: Column, verified: Column) -> Column:
    """REPORTED, or NO_REPORT only where coverage is verified, else UNAVAILABLE."""
    return F.when(count > 0, "REPORTED").when(verified, "NO_REPORT").otherwise("UNAVAILABLE")


def dense_grid(counts: DataFrame, cells: DataFrame, calendar: DataFrame, measures: list[str], verified: bool) -> DataFrame:
    """Every cell in every period with its counts, zero-filled; refused where coverage is not verified.

    The scaffold crosses the reviewed cells with a calendar, both small by construction; it is made inside the join's
    tasks, and the counts meet it by a left join on cell and period.
    """
    if not verified:
        raise ValueError("dense zeros need verified coverage")
    scaffold = cells.crossJoin(F.broadcast(calendar))
    return scaffold.join(counts.select("cell", "period_start", *measures), ["cell", "period_start"], "left").fillna(0, subset=measures)


def split_universe(obs: DataFrame, cells: DataFrame, reason: str = "OUTSIDE_UNIVERSE") -> tuple[DataFrame, DataFrame]:
    """Observations in a cell of the universe, and exclusion facts for the others."""
    inside = obs.join(cells.select("cell").distinct(), "cell", "left_semi")
    outside = obs.join(cells.select("cell").distinct(), "cell", "left_anti").withColumn("reason", F.lit(reason))
    return inside, outside


def rolling_mean(df: DataFrame, value: str, order: str, rows: int = 30, keys: list[str] | None = None) -> Column:
    """Trailing mean over the last ``rows`` rows of each key."""
    w = Window.partitionBy(*(keys or [])).orderBy(order).rowsBetween(-(rows - 1), 0)
    return F.avg(value).over(w)


def reconcile(left: DataFrame, right: DataFrame, keys: list[str], measures: list[str], tolerance: float = 1e-9) -> DataFrame:
    """Keys on which two tables disagree: missing on a side, or a measure apart."""
    a = left.select(*keys, *[F.col(m).alias(f"{m}_left") for m in measures], F.lit(1).alias("__l"))
    b = right.select(*keys, *[F.col(m).alias(f"{m}_right") for m in measures], F.lit(1).alias("__r"))
    both = a.join(b, keys, "full")
    apart = F.lit(False)
    for m in measures:
        apart = apart | (F.abs(F.coalesce(F.col(f"{m}_left"), F.lit(0)) - F.coalesce(F.col(f"{m}_right"), F.lit(0))) > tolerance)
    side = F.when(F.col("__l").isNull(), "RIGHT_ONLY").when(F.col("__r").isNull(), "LEFT_ONLY").when(apart, "DIFFERS")
    return both.withColumn("side", side).filter("side is not null").drop("__l", "__r")


def estimate_dense_rows(cells: int, days: int, buckets: int = 3, bytes_per_row: int = 130, rows_per_second: int = 100_000) -> dict[str, float]:
    """Size and time that a dense build would take."""
    rows = cells * days * buckets
    return {"rows": rows, "bytes": rows * bytes_per_row, "seconds": rows / rows_per_second}
