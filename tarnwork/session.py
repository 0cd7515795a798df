"""Session defaults: UTC, ANSI, AQE."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "tarnwork", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings that the operators expect; `conf` keys use `_` for `.`-free overrides."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    for k, v in (base | conf).items():
        b = b.config(k, v)
    return b.getOrCreate()
