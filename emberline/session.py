"""Sessions: where Python workers find this package."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def find_package(spark: SparkSession) -> SparkSession:
    """Python workers look beside this package too, even if the session was made without PYTHONPATH.
    On a cluster it is installed on the executors or in their PYTHONPATH already, which stays first."""
    context = spark.sparkContext
    path = context.environment.get("PYTHONPATH", os.environ.get("PYTHONPATH", ""))
    if ROOT not in path.split(os.pathsep):
        context.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [path, ROOT]))
    return spark
