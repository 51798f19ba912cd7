"""Session defaults of the engine."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def session(app: str = "panelmill", **options: str) -> SparkSession:
    """A session in UTC with adaptive execution; ``options`` are Spark settings with ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    defaults = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.ansi.enabled": "true"}
    for key, value in (defaults | {k.replace("__", "."): v for k, v in options.items()}).items():
        builder = builder.config(key, value)
    if not os.environ.get("SPARK_REMOTE") and "spark.master" not in {k.replace("__", ".") for k in options}:
        builder = builder.config("spark.master", os.environ.get("SPARK_MASTER", "local[*]"))
    return builder.getOrCreate()
