"""Sends the package to the executors, for sessions whose workers don't have it installed."""

from __future__ import annotations

import os
import tempfile
import zipfile
from functools import cache

from pyspark.sql import SparkSession

import cardspark


def ship(spark: SparkSession) -> None:
    """Make the package importable in the Python workers of the session; once for each application."""
    _add(spark.sparkContext.applicationId)


@cache
def _add(application: str) -> None:
    root = os.path.dirname(os.path.abspath(cardspark.__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="cardspark-code-"), f"cardspark-{application}.zip")
    with zipfile.ZipFile(target, "w") as out:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.join("cardspark", os.path.relpath(path, root)))
    # Spark's own file server hands the archive to every executor
    SparkSession.active().sparkContext.addPyFile(target)
