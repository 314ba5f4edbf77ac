"""Tables in a database, for the results and the blacklist. Needs the database's driver jar."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Connections a write or a partitioned read opens at once, unless told otherwise.
CONNECTIONS = 10


def connection(url: str, table: str, user: str, password: str) -> dict[str, str]:
    return {"url": url, "dbtable": table, "user": user, "password": password}


def partition_options(column: str, lower: int, upper: int,
                      connections: int = CONNECTIONS) -> dict[str, str]:
    """Read in so many parts, cut by a number, date or time column.

    The bounds only place the cuts: rows outside them, and nulls, are in the outer parts.
    """
    return {"partitionColumn": column, "lowerBound": str(lower), "upperBound": str(upper),
            "numPartitions": str(connections)}


def write_options(target: dict[str, str], connections: int = CONNECTIONS) -> dict[str, str]:
    return {
        **target,
        # Keep the table's own definition on overwrite.
        "truncate": "true",
        # Spark merges the partitions down to this many before it connects.
        "numPartitions": str(connections),
        "batchsize": "10000",
    }


def read_jdbc(spark: SparkSession, source: dict[str, str],
              parts: dict[str, str] | None = None) -> DataFrame:
    """A table such as the blacklist; inside ``foreachBatch`` it is current per batch.

    Without ``parts`` (:func:`partition_options`) one task reads it all: for small tables only.
    """
    return spark.read.format("jdbc").options(**source, **(parts or {})).load()


def write_jdbc(df: DataFrame, target: dict[str, str], mode: str,
               connections: int = CONNECTIONS) -> None:
    """Store a result table; ``mode`` is ``overwrite`` or ``append``."""
    df.write.format("jdbc").options(**write_options(target, connections)).mode(mode).save()
