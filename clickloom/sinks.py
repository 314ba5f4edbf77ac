"""Batch sinks: whole tables, as files or catalog tables (databases: ``sources.jdbc``)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def overwrite_table(df: DataFrame, path: str) -> None:
    """Replace a table. ``df`` must not read from it."""
    df.write.mode("overwrite").parquet(path)


def append_table(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def recreate_catalog_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Drop and re-create a catalog table, at ``path`` if given."""
    df.sparkSession.sql(f"drop table if exists {name}")
    df.write.mode("overwrite").saveAsTable(name, format="parquet", path=path)
