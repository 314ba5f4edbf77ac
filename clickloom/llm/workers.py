"""What the Python workers need."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession


def ready(spark: SparkSession) -> None:
    """Lets the Python workers of a local session find the library, wherever it was started.

    On a cluster it comes with ``--py-files``.
    """
    root = str(Path(__file__).resolve().parents[2])
    held = spark.sparkContext.environment
    paths = held.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep)
    if spark.sparkContext.master.startswith("local[") and root not in paths:
        held["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
