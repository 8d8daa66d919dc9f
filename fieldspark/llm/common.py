"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldspark.operators.lineage import shared_root

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: Characters that separate words: space and the controls from tab to carriage return.
SPACES = " \t\n\x0b\x0c\r"


#: Bytes of a batch that goes to a Python worker; ten thousand long documents would be a hundred times as many.
BATCH_BYTES = 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """Bounds the batches that travel between the JVM and Python workers by bytes, unless they are smaller already."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch()
    if not 0 < now <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or a local one where a local master has none."""
    bound_batches(spark)
    where = shared_root(spark)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(where)
    return where


def cut(df: DataFrame) -> DataFrame:
    """Cuts the lineage by a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Removes the tables of the innermost ``scratch`` block.
_made: ContextVar[list[Callable[[], None]] | None] = ContextVar("made", default=None)


@contextmanager
def scratch() -> Iterator[None]:
    """Tables that are stored inside are removed at the end, but for those that are kept."""
    made: list[Callable[[], None]] = []
    before = _made.set(made)
    try:
        yield
    finally:
        _made.reset(before)
        for remove in made:
            remove()


def _scrap(remove: Callable[[], None], keep: bool) -> None:
    if not keep and (made := _made.get()) is not None:
        made.append(remove)


@contextmanager
def _no_shuffle_left(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written inside go when it is written, not when the driver collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stored(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """Writes a table into the shared folder and reads it again: unlike a checkpoint it is columnar and compressed, and
    what it takes is computed once."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    with _no_shuffle_left(spark):
        df.write.parquet(path)
    _scrap(lambda: _remove(spark, path), keep)
    return spark.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def partitions_of(df: DataFrame) -> int:
    """Number of partitions of a table that is read."""
    return df.rdd.getNumPartitions()


def bucketed(df: DataFrame, label: str, column: str, buckets: int) -> DataFrame:
    """Writes a table bucketed by a column into the warehouse: joins and groups by it then need no shuffle of it."""
    spark, name = df.sparkSession, f"{label}_{uuid.uuid4().hex}"
    with _no_shuffle_left(spark):
        df.write.format("parquet").bucketBy(buckets, column).sortBy(column).saveAsTable(name)
    _scrap(lambda: spark.sql(f"DROP TABLE IF EXISTS {name}"), keep=False)
    return spark.table(name)


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(c, UPPER, LOWER)


def crc32_mod(c: Column, modulus: int) -> Column:
    """crc32 of the value as text, modulo ``modulus``; null counts as the empty text."""
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % modulus
