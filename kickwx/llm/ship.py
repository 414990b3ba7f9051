"""Make this package importable in the Python tasks."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

import kickwx


def ship(spark: SparkSession) -> None:
    """Send the package to the executors once per Spark context (as ``--py-files`` would), if it is a plain folder here."""
    sc = spark.sparkContext
    root = Path(kickwx.__file__).parent.parent
    if root.is_dir() and not any(name.startswith("kickwx-") for name in sc._python_includes):
        sc.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp()}/kickwx-package", "zip", root, "kickwx"))
