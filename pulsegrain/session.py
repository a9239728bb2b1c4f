"""Session defaults for standalone use."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app_name: str = "pulsegrain", master: str | None = None, **conf: str) -> SparkSession:
    """A session pinned to UTC with adaptive execution; ANSI stays on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.ansi.enabled": "true",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
