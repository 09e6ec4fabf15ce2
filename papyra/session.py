"""A session with the settings the library is meant for."""

from __future__ import annotations

from pyspark.sql import SparkSession

from papyra.shared import ship

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(app: str = "papyra", **more: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for k, v in {**SETTINGS, **more}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ship(spark)
    return spark
