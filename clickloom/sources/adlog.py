"""Ad-click log lines, ``<epoch millis> <province> <city> <userid> <adid>``, as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom import schemas


def kafka_options(servers: str, topic: str, starting: str = "latest") -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        # Only for the first start: later ones go on from the query's own checkpoint.
        "startingOffsets": starting,
    }


def kafka_lines(spark: SparkSession, servers: str, topic: str,
                starting: str = "latest") -> DataFrame:
    """Lines of a Kafka topic. Needs the spark-sql-kafka package on the class path."""
    stream = spark.readStream.format("kafka").options(**kafka_options(servers, topic, starting))
    return stream.load().select(F.col("value").cast("string").alias("value"))


def file_lines(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Lines of the text files that arrive below a folder."""
    reader = (spark.readStream.format("text")
              .schema("value string")
              .option("recursiveFileLookup", "true"))
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def admitted_clicks(spark: SparkSession, path: str,
                    files_per_trigger: int | None = None) -> DataFrame:
    """Parsed clicks as a stream, from a folder of Parquet files (admitted ones: ``ClickFeed``)."""
    reader = (spark.readStream.format("parquet")
              .schema(schemas.AD_CLICKS)
              .option("recursiveFileLookup", "true"))
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


# Clicks are dated from 1970 on and before this: the year 2100, in milliseconds.
BEFORE_MILLIS = 4_102_444_800_000


def _well_formed(before_millis: int) -> str:
    return f"""
        try_cast(parts[0] as long) >= 0 and try_cast(parts[0] as long) < {before_millis}
        and try_cast(get(parts, 3) as long) is not null
        and try_cast(get(parts, 4) as long) is not null"""


def _parts(lines: DataFrame, *kept: str) -> DataFrame:
    # As a generated row a line is split once; as a plain expression it would be split again for
    # every field and every condition that Catalyst moves below the projection.
    return lines.select(*kept, F.explode(F.array(F.split("value", " "))).alias("parts"))


def parse_ad_log(lines: DataFrame, observed_as: str | None = None,
                 before_millis: int = BEFORE_MILLIS) -> DataFrame:
    """Typed clicks of the well-formed lines, for batches and streams.

    A line is malformed if its fields are no numbers, or if its time lies before 1970 or not before
    ``before_millis``. No clock decides, so a second run over the same lines gives the same clicks.

    With ``observed_as`` the run reports, as an observed metric of that name, how many ``lines``
    it read and how many of them were ``malformed``.
    """
    parts, well_formed = _parts(lines), _well_formed(before_millis)
    if observed_as:
        parts = parts.observe(observed_as, F.count(F.lit(1)).alias("lines"),
                              F.count_if(~F.coalesce(F.expr(well_formed), F.lit(False))).alias("malformed"))
    return (parts.where(well_formed)
            .selectExpr("timestamp_millis(try_cast(parts[0] as long)) as click_time",
                        "parts[1] as province", "parts[2] as city",
                        "cast(parts[3] as long) as userid", "cast(parts[4] as long) as adid")
            .select("click_time", F.to_date("click_time").alias("date"), "province", "city",
                    "userid", "adid"))


def rejected_lines(lines: DataFrame, before_millis: int = BEFORE_MILLIS) -> DataFrame:
    """The lines :func:`parse_ad_log` leaves out."""
    return (_parts(lines, "value")
            .where(f"not coalesce({_well_formed(before_millis)}, false)").select("value"))
