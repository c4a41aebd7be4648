"""A session with the settings that the operators assume."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "starfold", **conf: str) -> SparkSession:
    """UTC, adaptive execution, Arrow transfer; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(name)
    settings = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.execution.arrow.pyspark.enabled": "true"}
    for key, value in {**settings, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
