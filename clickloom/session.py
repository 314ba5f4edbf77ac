"""Session settings the operators are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE does the run-time half of the skew handling: it splits the oversized partitions of the
# semi, anti and inner joins, merges the undersized ones after every aggregate, and turns a
# sort-merge join into a broadcast join once it has measured the small side.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Also where an aggregate stands on the join's keys: it is exchanged anew, if skew is found.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Fixed at the start of an application, unlike the settings above.
STATIC_SETTINGS = {
    # Spares a look at the Python stack for every column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "clickloom", master: str | None = None,
                  overrides: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings above, some of them overridden."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **STATIC_SETTINGS, **(overrides or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
