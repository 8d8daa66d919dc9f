"""Cutting the lineage of iterative plans so that lost executors do not replay all rounds."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``. Only a local master may do without it."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return (where or f"file://{os.path.join(tempfile.gettempdir(), 'checkpoints')}").rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder."""
    spark = df.sparkSession
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(shared_root(spark))
    return df.checkpoint(eager=True)


def workspace(spark: SparkSession, label: str) -> str:
    """A new folder in the shared place."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
