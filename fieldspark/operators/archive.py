"""Archive dates, encounter collapse, anchor quality, annual counts and period rules of published counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldspark.functions.geo import haversine_km
from fieldspark.functions.temporal import clock_text, plausible_start, week_start
from fieldspark.functions.text import date_text, source_text, use_class
from fieldspark.operators.ordering import running_sums


def archive_date(raw: Column, year: Column) -> Column:
    """Struct ``day, flags`` of archive text like ``3-Sept-019``.

    A year of three digits is the archive's, a missing one too; two digits pivot at 69. The flags tell repairs, a year
    other than the archive's, and text that no format fits.
    """
    # Each step is bound to a name and evaluated once; a format is tried only on text of its shape, as a failure is slow.
    let = lambda x, f: F.get(F.transform(F.array(x), f), F.lit(0))
    own = year.cast("string")

    def widened(full: Column) -> Column:
        """Two-digit years: 69 to 99 are of the last century."""
        tail = F.regexp_extract(full, r"[-/](\d{2})$", 1)
        return let(tail, lambda t: F.when(t != "", F.concat(F.regexp_replace(full, r"\d{2}$", ""), F.when(t.try_cast("int") >= 69, F.lit("19")).otherwise(F.lit("20")), t)).otherwise(full))

    def dated(wide: Column) -> Column:
        shapes = ((r"^\d+-[A-Za-z]{3}-", "d-MMM-yyyy"), (r"^\d+-[A-Za-z]{4,}-", "d-MMMM-yyyy"), (r"^\d+/\d+/", "d/M/yyyy"), (r"^\d+-\d+-", "d-M-yyyy"))
        out = F.lit(None).cast("date")
        for shape, form in reversed(shapes):
            out = F.when(wide.rlike(shape), F.try_to_date(wide, form)).otherwise(out)
        return out

    def parsed(plain: Column) -> Column:
        short = plain.rlike(r"[-/]\d{3}$")
        fixed = F.when(short, F.concat(F.regexp_replace(plain, r"\d{3}$", ""), own)).otherwise(plain)
        missing = lambda x: ~x.rlike(r"[-/]\d{2,4}$") | x.rlike(r"^\d{1,2}[-/]\d{1,2}$")
        full = let(fixed, lambda x: F.when(missing(x), F.concat(x, F.lit("-"), own)).otherwise(x))
        return F.struct(short.alias("short"), let(let(full, widened), dated).alias("day"))

    def told(p: Column) -> Column:
        empty = F.trim(raw) == ""
        flags = F.array_compact(
            F.array(
                F.when(raw.isNull() | empty, F.lit("MISSING_DATE")),
                F.when(p["short"], F.lit("YEAR_REPAIRED")),
                F.when(F.year(p["day"]) != year, F.lit("YEAR_MISMATCH")),
                F.when(p["day"].isNull() & ~empty, F.lit("UNPARSED_DATE")),
            )
        )
        return F.struct(p["day"].alias("day"), flags.alias("flags"))

    return let(let(F.replace(date_text(raw), F.lit(" "), F.lit("")), parsed), told)


def encounter_start(start: Column, end: Column) -> Column:
    """Start of an encounter as HH:mm, where it is plausible."""
    return plausible_start(clock_text(start), clock_text(end))


def collapse_encounters(rows: DataFrame, keys: Sequence[str], *, max_spread_km: float, max_uncertainty_m: float) -> DataFrame:
    """One row for each encounter of occurrences ``day, lat, lon, uncertainty, license, remark, occurrence``.

    Reasons tell days that are missing or differ, coordinates that are missing, a spread or an uncertainty beyond the
    limits. The spread is the largest distance of two occurrences; it is computed within the row from the distinct
    places of an encounter, which are few by the grouping.
    """
    place = F.when(F.col("lat").isNotNull() & F.col("lon").isNotNull(), F.struct("lat", "lon"))
    good = F.when(F.col("uncertainty") >= 0, F.col("uncertainty"))
    g = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("occurrences"),
        F.countDistinct("day").alias("__days"),
        F.sum(F.when(F.col("day").isNull(), 1).otherwise(0)).alias("__no_day"),
        F.min("day").alias("day"),
        F.collect_set(place).alias("__places"),
        F.sum(F.when(place.isNull(), 1).otherwise(0)).alias("__no_place"),
        F.median("lat").alias("lat"),
        F.median("lon").alias("lon"),
        F.max(good).alias("uncertainty"),
        F.max(F.when(F.col("uncertainty") < 0, 1).otherwise(0)).alias("__bad"),
        F.array_sort(F.collect_set("license")).alias("licenses"),
        F.array_sort(F.collect_set(source_text(F.col("remark")))).alias("remarks"),
        F.array_sort(F.collect_set(F.col("occurrence").cast("string"))).alias("occurrence_ids"),
    )
    far = F.transform("__places", lambda a: F.array_max(F.transform("__places", lambda b: haversine_km(a["lat"], a["lon"], b["lat"], b["lon"]))))
    g = g.withColumn("spread_km", F.coalesce(F.array_max(far), F.lit(0.0)))
    reasons = F.array_sort(
        F.array_compact(
            F.array(
                F.when((F.col("__days") != 1) | (F.col("__no_day") > 0), F.lit("DAY_MISSING_OR_CONFLICTING")),
                F.when(F.col("__no_place") > 0, F.lit("COORDINATES_MISSING")),
                F.when(F.col("spread_km") > max_spread_km, F.lit("SPREAD_EXCEEDS_LIMIT")),
                F.when(F.col("uncertainty") > max_uncertainty_m, F.lit("UNCERTAINTY_EXCEEDS_LIMIT")),
                F.when(F.col("__bad") == 1, F.lit("UNCERTAINTY_INVALID")),
            )
        )
    )
    out = g.withColumns({"reasons": reasons, "use_class": use_class(F.col("licenses")), "qc_status": F.when(F.size(reasons) > 0, "QUARANTINED").otherwise("ACCEPTED")})
    return out.drop(*[c for c in out.columns if c.startswith("__")])


def anchor_quality(obs: DataFrame, facts: DataFrame) -> DataFrame:
    """Adds ``anchor_weight`` and ``label_quality``.

    The weight is that of the best fact for an observation's own label (``confidence``, ``field``, ``conflicting``):
    strong or structured explicit facts 1, explicit text 0.75, others 0.6, conflicting ones 0. Low quality and mixed
    labels weigh nothing.
    """
    weight = F.when(F.col("conflicting"), 0.0).when(F.col("confidence") == "STRONG", 1.0).when((F.col("confidence") == "EXPLICIT") & (F.col("field") == "label_raw"), 1.0).when(F.col("confidence") == "EXPLICIT", 0.75).otherwise(0.6)
    best = facts.select("observation_id", F.col("value").alias("detail"), weight.alias("__w")).groupBy("observation_id", "detail").agg(F.max("__w").alias("__w"))
    rows = obs.join(best, ["observation_id", "detail"], "left")
    low, mixed = F.coalesce(F.col("tier") == "LOW_QUALITY_NON_ANCHOR", F.lit(False)), F.col("detail") == "MIXED"
    w = F.coalesce("__w", F.lit(1.0))
    quality = F.when(mixed, "CONFLICT").when(low, "LOW_QUALITY_NON_ANCHOR").when(w >= 0.99, F.when(F.col("__w").isNull(), "OBSERVED").otherwise("GOLD")).when(w >= 0.6, "SILVER").otherwise("CONFLICT")
    return rows.withColumns({"anchor_weight": F.when(low | mixed, 0.0).otherwise(w), "label_quality": quality}).drop("__w")


def annual_counts(rows: DataFrame, parts: Sequence[str], total: str) -> DataFrame:
    """Census rows by year, with the sum of the parts and whether it is the total."""
    added = sum((F.col(c) for c in parts), F.lit(0))
    return rows.withColumn("part_sum", added).withColumn("total_matches", F.col("part_sum") == F.col(total)).orderBy("census_year")


def repeated_years(rows: DataFrame) -> DataFrame:
    return rows.groupBy("census_year").count().filter("count > 1")


def census_summary(rows: DataFrame, parts: Sequence[str], total: str) -> DataFrame:
    """One row: latest year and its counts, number of years, and the years whose total does not match."""
    checked = annual_counts(rows, parts, total)
    latest = F.max_by(F.struct("census_year", *parts, total), "census_year")
    return checked.agg(latest.alias("latest"), F.count(F.lit(1)).alias("years"), F.array_sort(F.collect_list(F.when(~F.col("total_matches"), F.col("census_year")))).alias("mismatched"))


def weekly_differences(daily: DataFrame, weekly: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """Weeks whose count is not the sum of their days."""
    by = [*keys, "period_start"]
    days = daily.groupBy(*keys, week_start(F.col("period_start")).alias("period_start")).agg(F.sum(measure).alias("days"))
    both = weekly.select(*by, F.col(measure).alias("week")).join(days, by, "left")
    return both.filter(F.coalesce("days", F.lit(0)) != F.col("week"))


def total_differences(buckets: DataFrame, totals: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """Keys whose buckets do not add up to their total."""
    summed = buckets.groupBy(*keys).agg(F.sum(measure).alias("buckets"))
    both = summed.join(totals.select(*keys, F.col(measure).alias("total")), list(keys), "full")
    return both.filter(~F.coalesce("buckets", F.lit(0)).eqNullSafe(F.coalesce("total", F.lit(0))))


def unlicensed(outputs: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Source records behind outputs (``record_ids``) that no redistributable snapshot record covers."""
    need = outputs.select(F.explode("record_ids").alias("record_id")).distinct()
    return need.join(snapshots.filter("use_class = 'REDISTRIBUTABLE'").select("record_id"), "record_id", "left_anti")


def capped_sample(rows: DataFrame, group: str, encounter: str, cap: int, salt: str = "sample") -> DataFrame:
    """At most ``cap`` rows of each class, one of each encounter first, in an order of hashes (a sampling operator)."""
    from pyspark.sql import Window

    h = F.md5(F.concat_ws("|", F.lit(salt), F.col("id").cast("string")).cast("binary"))
    turn = F.row_number().over(Window.partitionBy(group, encounter).orderBy(h, "id"))
    ranked = rows.withColumn("__turn", turn)
    order = Window.partitionBy(group).orderBy("__turn", h, "id")
    return ranked.withColumn("__n", F.row_number().over(order)).filter(F.col("__n") <= cap).drop("__turn", "__n")


def paired_bootstrap(rows: DataFrame, first: str, second: str, replicates: int = 300) -> DataFrame:
    """Mean difference of two losses and its 95 % interval, over Poisson resamples drawn by hash.

    Each row is expanded to its replicates and summed before the shuffle: as many partial rows as replicates and tasks.
    """
    u = (F.pmod(F.xxhash64("id", "replicate"), F.lit(1 << 30)) + 0.5) / float(1 << 30)
    times = sum((F.when(u > c, 1).otherwise(0) for c in (0.36787944, 0.73575888, 0.91969860, 0.98101184, 0.99634015, 0.99940582)), F.lit(0))
    each = rows.select("id", (F.col(second) - F.col(first)).alias("d"), F.explode(F.sequence(F.lit(1), F.lit(replicates))).alias("replicate")).withColumn("k", times)
    means = each.groupBy("replicate").agg((F.sum(F.col("d") * F.col("k")) / F.sum("k")).alias("mean"))
    return means.agg(F.avg("mean").alias("difference"), F.percentile("mean", F.lit(0.025)).alias("low"), F.percentile("mean", F.lit(0.975)).alias("high"))


def higher_quantiles(rows: DataFrame, key: str, value: str, q: float) -> DataFrame:
    """``key, threshold``: the smallest value at or above the linear quantile, which is a value of the data. Values are
    counted, and running sums over ranges of them find the place."""
    by = rows.groupBy(key, value).agg(F.count(F.lit(1)).alias("same"))
    total = by.groupBy(key).agg(F.sum("same").alias("n"))
    reached = running_sums(by, value, {"upto": F.col("same")}, [key]).join(total, key).filter(F.col("upto") > F.ceil(F.lit(q) * (F.col("n") - 1)))
    return reached.groupBy(key).agg(F.min(value).alias("threshold"))


def multiclass_losses(rows: DataFrame, classes: Sequence[str]) -> DataFrame:
    """Weighted Brier and log loss of ``label`` under columns ``p_<class>``."""
    hit = lambda c: F.when(F.col("label") == c, 1.0).otherwise(0.0)
    brier = sum(((F.col(f"p_{c}") - hit(c)) * (F.col(f"p_{c}") - hit(c)) for c in classes), F.lit(0.0))
    own = F.coalesce(*[F.when(F.col("label") == c, F.col(f"p_{c}")) for c in classes])
    log = -F.ln(F.greatest(F.lit(1e-12), own))
    return rows.agg((F.sum(F.col("w") * brier) / F.sum("w")).alias("brier"), (F.sum(F.col("w") * log) / F.sum("w")).alias("log_loss"))
