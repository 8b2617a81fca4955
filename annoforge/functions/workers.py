"""What Python workers need."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def reachable(spark: SparkSession) -> None:
    """Let workers look for this package where the driver found it; a cluster that lacks that path gets it by
    --py-files, as usual. The setting stays for the application."""
    home = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if home not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [home, env.get("PYTHONPATH")]))
