"""Sessions with the settings that the queries expect."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build(app: str = "tidemark", **conf: str) -> SparkSession:
    """UTC, ANSI arithmetic, adaptive execution with skew handling; ``conf`` adds to or replaces these."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    } | conf
    return SparkSession.builder.appName(app).config(map=settings).getOrCreate()
