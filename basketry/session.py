"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Everything here is a Spark default or a safe override of one; a cluster may set its own values.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    master: str | None = None, app: str = "basketry", settings: dict[str, str] | None = None
) -> SparkSession:
    """A session with SETTINGS, then the caller's own settings on top."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
