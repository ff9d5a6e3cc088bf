"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# ANSI mode stays on (the Spark 4 default): a bad cast must be asked for with try_cast.
_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "assayer", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; `conf` keys use `__` for the dots of a Spark setting."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**_SETTINGS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
