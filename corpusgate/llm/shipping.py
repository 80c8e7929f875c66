"""Sends this package to the executors, so that functions of its modules can run there."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parents[1]
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand the package's source to the application's executors through Spark, once for each application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    target = Path(tempfile.mkdtemp()) / PACKAGE.name
    shutil.copytree(PACKAGE, target / PACKAGE.name, ignore=shutil.ignore_patterns("__pycache__"))
    context.addPyFile(shutil.make_archive(str(target), "zip", target))
    _SHIPPED.add(context.applicationId)
