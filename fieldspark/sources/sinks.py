"""Validated, idempotent and atomic writes, with manifests."""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from contextlib import contextmanager
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldspark.operators.quality import Contract, schema_errors, violations


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm.org.apache.hadoop.fs.Path


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at a path of any Hadoop file system."""
    fs, at, _ = _fs(spark, path)
    return fs.exists(at)


def write_validated(df: DataFrame, path: str, contract: Contract, partition_by: list[str] | None = None) -> DataFrame:
    """Stages a table, checks what was staged and swaps it in; a failed candidate goes to ``<path>.quarantine``.

    Works on any Hadoop file system: data are written once, by tasks, and the swap is two renames.
    """
    if errors := schema_errors(df, contract):
        raise ValueError("; ".join(errors))
    spark = df.sparkSession
    staged = f"{path}.staging-{uuid.uuid4().hex}"
    for c in partition_by or []:  # partition columns leave the files, so a copy stays in them
        df = df.withColumn(f"_{c}", F.col(c))
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*[f"_{c}" for c in partition_by])
    writer.parquet(staged)
    found = [r for r in violations(spark.read.schema(df.schema).parquet(staged), contract).collect() if r["check"] != "rows" and r["rows"]]
    fs, source, new = _fs(spark, staged)
    if found:
        fs.rename(source, new(f"{path}.quarantine-{uuid.uuid4().hex}"))
        raise ValueError(f"rejected: {[(r['check'], r['rows']) for r in found]}")
    target, old = new(path), new(f"{path}.old-{uuid.uuid4().hex}")
    if fs.exists(target):
        fs.rename(target, old)
    if not fs.rename(source, target):
        fs.rename(old, target)
        raise OSError(f"{path} was not replaced")
    fs.delete(old, True)
    return spark.read.parquet(path)


def append_new(df: DataFrame, path: str, keys: list[str]) -> int:
    """Appends the rows whose key is not there yet, so that a replay adds nothing; returns how many were new.

    New rows are staged, counted from their files' footers and moved in; the table itself is read for its keys alone.
    """
    spark = df.sparkSession
    fs, target, new = _fs(spark, path)
    fresh = df.dropDuplicates(keys)
    known = fs.exists(target)
    if known:
        fresh = fresh.join(spark.read.parquet(path).select(*keys), keys, "left_anti")
    staged = new(f"{path}.append-{uuid.uuid4().hex}")
    fresh.write.option("compression", "zstd").parquet(staged.toString())
    added = spark.read.schema(df.schema).parquet(staged.toString()).count()
    if not known:
        fs.rename(staged, target)
        return added
    for part in fs.listStatus(staged):
        if part.getPath().getName().startswith("part-"):
            fs.rename(part.getPath(), new(target, part.getPath().getName()))
    fs.delete(staged, True)
    return added


def partition_report(spark: SparkSession, path: str, cell: str, period: str) -> DataFrame:
    """Rows, cells and periods of each data file, for the manifest."""
    rows = spark.read.option("recursiveFileLookup", True).parquet(path)
    return rows.groupBy(F.input_file_name().alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct(cell).alias("cells"), F.min(period).alias("first_period"), F.max(period).alias("last_period")
    )


def content_hash(df: DataFrame, exclude: tuple[str, ...] = ()) -> str:
    """Digest of a table's rows, whatever their order: two sums of row hashes and the number of rows."""
    values = [F.col(c).cast("string") for c in sorted(set(df.columns) - set(exclude))]
    r = df.agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.xxhash64(F.lit(k), *values).cast("decimal(38,0)")).alias(f"h{k}") for k in (0, 1)]).first()
    return hashlib.sha256(f"{r['n']}|{r['h0']}|{r['h1']}".encode()).hexdigest()


def file_checksums(spark: SparkSession, path: str) -> DataFrame:
    """``file, bytes, sha256`` of the files below a path, hashed by tasks."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def write_json(path: str | Path, payload: dict, overwrite: bool = True) -> None:
    """Atomic write of a small driver-side document."""
    path = Path(path)
    if path.exists() and not overwrite:
        raise FileExistsError(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    temporary = path.with_name(f".{path.name}.{uuid.uuid4().hex}")
    temporary.write_text(json.dumps(payload, indent=2, sort_keys=True, default=str))
    os.replace(temporary, path)


def signature(*parts: object) -> str:
    """Digest of a stage's inputs and settings."""
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()


def resumed(manifest: str | Path, wanted: str) -> dict | None:
    """The manifest of a stage that ran with the same signature."""
    path = Path(manifest)
    if not path.exists():
        return None
    found = json.loads(path.read_text())
    return found if found.get("signature") == wanted else None


def promote(root: str | Path, artifacts: dict[str, str], gates: dict[str, bool], metadata: dict) -> Path:
    """Publishes a release: its manifest, named by its content, is written last and then pointed to.

    ``artifacts`` maps names to content hashes. All gates must hold.
    """
    if failed := sorted(k for k, v in gates.items() if not v):
        raise ValueError(f"gates failed: {failed}")
    body = {"artifacts": artifacts, "gates": gates, "metadata": metadata}
    identity = signature(body)
    path = Path(root) / "releases" / identity / "manifest.json"
    if not path.exists():
        write_json(path, {**body, "release_id": identity})
    write_json(Path(root) / "current.json", {"release_id": identity})
    return path


def validate_release(manifest: str | Path) -> list[str]:
    """What is wrong with a release's manifest: nothing if it is as it was published."""
    body = json.loads(Path(manifest).read_text())
    identity = body.pop("release_id", None)
    errors = [] if identity == signature(body) else ["content does not match the release id"]
    return errors + [f"gate {k} does not hold" for k, v in body.get("gates", {}).items() if not v]


def retention(previous: int | None, current: int, max_growth: float = 0.1) -> str:
    """Whether an earlier product may go once a new one is there."""
    if previous is None:
        return "KEEP_NO_BASELINE"
    if previous <= 0:
        return "KEEP_EMPTY_BASELINE"
    growth = (current - previous) / previous
    if growth < 0:
        return "KEEP_SHRUNK"
    return "PRUNE" if growth <= max_growth else "KEEP_GREW_TOO_MUCH"


@contextmanager
def single_writer(root: str | Path) -> Iterator[None]:
    """Fails at once if another process writes below the root."""
    import fcntl

    Path(root).mkdir(parents=True, exist_ok=True)
    with open(Path(root) / ".lock", "w") as lock:
        try:
            fcntl.flock(lock, fcntl.LOCK_EX | fcntl.LOCK_NB)
        except BlockingIOError as e:
            raise RuntimeError(f"{root} is being written by another process") from e
        yield
