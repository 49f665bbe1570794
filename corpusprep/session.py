"""Session settings that the library is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "corpusprep", **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC; ``conf`` (dots as double underscores) overrides."""
    builder = SparkSession.builder.appName(app)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # the content store is asked for the records that a filter names
        "spark.sql.python.filterPushdown.enabled": "true",
        # a batch of whole files or texts holds few of them
        "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
