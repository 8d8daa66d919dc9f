"""Session defaults shared by the tests, the benchmark and interactive use."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def build_session(app: str = "fieldspark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC timestamps and adaptive execution; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    for key, value in {**defaults, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Makes the package importable in Python workers, once for each application: Spark serves a zip of its sources."""
    context = spark.sparkContext
    if getattr(context, "_fieldspark_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp()) / "fieldspark_sources.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted([*(root / "fieldspark").rglob("*.py"), *root.glob("corpus_pipeline.py")]):
            out.write(path, path.relative_to(root))
    context.addPyFile(str(archive))
    context._fieldspark_shipped = True
