"""Contracts of published tables, checked in one pass where the checks allow it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Contract:
    """Schema (nullability included), primary key and named rules of a table."""

    schema: StructType
    primary_key: tuple[str, ...]
    rules: tuple[tuple[str, Column], ...] = ()


def schema_errors(df: DataFrame, contract: Contract) -> list[str]:
    """Missing, extra and mistyped columns; reads no data."""
    have, want = {f.name: f.dataType for f in df.schema}, {f.name: f.dataType for f in contract.schema}
    errors = [f"missing {c}" for c in want if c not in have] + [f"unexpected {c}" for c in have if c not in want]
    return errors + [f"{c} is {have[c].simpleString()}, not {t.simpleString()}" for c, t in want.items() if c in have and have[c] != t]


def violations(df: DataFrame, contract: Contract) -> DataFrame:
    """``check, rows``: nulls in required columns, broken rules, and repeated keys.

    Row-wise checks are conditional counts of one aggregate. Keys are counted by key, which is the only shuffle; a rule
    that is null counts as broken.
    """
    required = [(f"null {f.name}", F.col(f.name).isNull()) for f in contract.schema if not f.nullable]
    broken = [(f"rule {n}", ~F.coalesce(c, F.lit(False))) for n, c in contract.rules]
    checks = [*required, *broken]
    counted = df.agg(*[F.coalesce(F.sum(F.when(c, 1)), F.lit(0)).cast("long").alias(f"c{i}") for i, (_, c) in enumerate(checks)], F.count(F.lit(1)).alias("all"))
    rows = counted.select(F.explode(F.array(*[F.struct(F.lit(n).alias("check"), F.col(f"c{i}").alias("rows")) for i, (n, _) in enumerate(checks)], F.struct(F.lit("rows").alias("check"), F.col("all").alias("rows")))).alias("x")).select("x.*")
    keys = df.groupBy(*contract.primary_key).count().filter("count > 1").agg(F.lit("repeated key").alias("check"), F.coalesce(F.sum("count"), F.lit(0)).cast("long").alias("rows"))
    return rows.unionByName(keys)


def null_rates(df: DataFrame, columns: list[str]) -> DataFrame:
    """``column, nulls, rate``."""
    one = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(c).alias(f"k_{c}") for c in columns])
    parts = F.array(*[F.struct(F.lit(c).alias("column"), (F.col("n") - F.col(f"k_{c}")).alias("nulls"), F.when(F.col("n") > 0, (F.col("n") - F.col(f"k_{c}")) / F.col("n")).alias("rate")) for c in columns])
    return one.select(F.explode(parts).alias("x")).select("x.*")


def first_failure(gates: list[tuple[str, Column]]) -> Column:
    """Name of the first gate that a row does not pass; null if it passes all."""
    out = F.lit(None).cast("string")
    for name, passes in reversed(gates):
        out = F.when(~F.coalesce(passes, F.lit(False)), F.lit(name)).otherwise(out)
    return out


def split_by_gates(rows: DataFrame, gates: list[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and the others with the first reason; together all rows."""
    judged = rows.withColumn("reject_reason", first_failure(gates))
    return judged.filter("reject_reason is null").drop("reject_reason"), judged.filter("reject_reason is not null")


def table_identity(df: DataFrame, id_column: str, day: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(id_column).alias("ids"), F.min(day).alias("first_day"), F.max(day).alias("last_day"))


def uncovered(have: DataFrame, need: DataFrame, key: str) -> DataFrame:
    """Keys that are needed but not there."""
    return need.select(key).distinct().join(have.select(key).distinct(), key, "left_anti")


def require(df: DataFrame, what: str) -> None:
    """Raises if a table of violations has a row."""
    sample = df.limit(5).collect()
    if sample:
        raise ValueError(f"{what}: {[r.asDict() for r in sample]}")


def count_identities(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows on which counts contradict each other: fewer reports than sightings, or parts that do not add up."""
    broken = (F.col("source_report_count") < F.col("sighting_count")) | (F.col("observed_count") + F.col("imputed_count") < F.col("sighting_count"))
    return df.filter(broken).select(*keys)


def profile_types(payloads: DataFrame, column: str, fields: list[str]) -> DataFrame:
    """``field, type, rows`` of JSON payloads."""
    typed = F.array(*[F.struct(F.lit(f).alias("field"), F.coalesce(F.schema_of_variant(F.try_variant_get(F.try_parse_json(F.col(column)), f"$.{f}", "variant")), F.lit("MISSING")).alias("type")) for f in fields])
    return payloads.select(F.explode(typed).alias("x")).groupBy("x.field", "x.type").agg(F.count(F.lit(1)).alias("rows"))
