"""Session defaults for the library's plans."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "gridzonal", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the plans rely on; keyword arguments override them.

    Dots in setting names are written as double underscores:
    ``build_session(spark__sql__shuffle__partitions="4000")``.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
