"""The ad log of the test data, replayed through the streaming jobs in day order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.session import SETTINGS
from clickloom.sources import adlog, storage, testdata
from clickloom.streaming import clicks as streams
from clickloom.streaming.clicks import AdTables

_NO_PAUSE = {"processingTime": "0 seconds"}
# Batches of admitted clicks per micro-batch for the queries that only read them.
_ENTRIES_PER_BATCH = 16

# The log is handed over in at most so many parts of whole days. A part costs seconds however small
# it is, so their number must not follow the days of the log.
_PARTS = 20

# Input per state partition.
_BYTES_PER_PARTITION = 64 << 20

_replays: dict[tuple, AdTables] = {}


def stream_session(spark: SparkSession, expected_bytes: int = 0) -> SparkSession:
    """A session for streams over about so much input.

    The number of state partitions stays fixed over the life of a checkpoint, so it follows the
    input that is to come, up to what the cluster can run at once.
    """
    session = spark.newSession()
    for key, value in SETTINGS.items():
        session.conf.set(key, value)
    partitions = min(spark.sparkContext.defaultParallelism,
                     1 + expected_bytes // _BYTES_PER_PARTITION)
    session.conf.set("spark.sql.shuffle.partitions", str(partitions))
    session.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    return session


def _estimated_bytes(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _with_day(lines: DataFrame) -> DataFrame:
    millis = F.get(F.split("value", " "), F.lit(0)).try_cast("long")
    return lines.select("value", F.to_date(F.timestamp_millis(millis)).alias("day"))


def write_days(lines: DataFrame, path: str) -> list[str]:
    """Store log lines as text files, one folder per day; returns the folders in day order."""
    _with_day(lines).hint("rebalance", "day").write.partitionBy("day").text(path)
    return storage.child_dirs(lines.sparkSession, path)


def write_parts(lines: DataFrame, path: str, most: int = _PARTS) -> list[str]:
    """Store log lines in at most ``most`` folders; returns the folders in day order.

    A folder holds whole days, one after the other, and about as many lines as any other, unless
    days are longer than that. Lines without a day are in the first one.
    """
    day = F.unix_date("day")
    days = _with_day(lines)
    shares = [k / most for k in range(1, most)]
    bounds = days.agg(F.percentile_approx(day, shares).alias("b")).first()["b"] or []
    bounds = F.array(*map(F.lit, sorted(set(bounds)))).cast("array<int>")
    number = F.size(F.filter(bounds, lambda bound: bound < day))
    (days.select("value", F.format_string("%06d", number).alias("part"))
     .hint("rebalance", "part").write.partitionBy("part").text(path))
    return storage.child_dirs(lines.sparkSession, path)


def parts_of_days(days: list[str], most: int = _PARTS) -> list[list[str]]:
    """The days in order, cut into at most ``most`` parts of nearly equal length."""
    n = min(most, len(days))
    return [days[k * len(days) // n:(k + 1) * len(days) // n] for k in range(n)]


def run_parts(session: SparkSession, prepared: str, parts: list[str], tables: AdTables,
              threshold: int) -> None:
    """Hand one folder of days after the other to the admission and to the blacklist upkeep.

    Both queries run throughout; a part is published by renaming its folder, and the next one waits
    until both have finished with it. Within a part the admission goes by day itself.
    """
    landing = f"{tables.root}/landing"
    storage.make_dir(session, landing)
    admission = streams.start_admission(adlog.file_lines(session, landing), tables, _NO_PAUSE,
                                        daily_threshold=threshold)
    upkeep = streams.start_user_clicks(
        tables.admitted.stream(session), tables, threshold, trigger=_NO_PAUSE)
    try:
        for folder in parts:
            storage.rename(session, f"{prepared}/{folder}", f"{landing}/{folder}")
            admission.processAllAvailable()
            upkeep.processAllAvailable()
    finally:
        admission.stop()
        upkeep.stop()


def run_days(session: SparkSession, prepared: str, days: list[str], tables: AdTables,
             threshold: int) -> None:
    """:func:`run_parts` for a log that is stored in a folder for each day."""
    folders = []
    for number, part in enumerate(parts_of_days(days)):
        folders.append(f"part={number:06d}")
        storage.make_dir(session, f"{prepared}/{folders[-1]}")
        for day in part:
            storage.rename(session, f"{prepared}/{day}", f"{prepared}/{folders[-1]}/{day}")
    run_parts(session, prepared, folders, tables, threshold)


def ad_stream(spark: SparkSession, sf_dir: str, threshold: int, start=None) -> AdTables:
    """Tables of the replayed ad stream, after ``start`` has run over the admitted clicks too.

    Within one application each part runs once per data set.
    """
    key = (spark.sparkContext.applicationId, sf_dir, threshold)
    size = _estimated_bytes(testdata.ad_lines(spark, sf_dir))
    if key not in _replays:
        session = stream_session(spark, size)
        tables = AdTables(storage.new_run_dir(spark, "ad-stream")).create(session)
        prepared = f"{tables.root}/prepared"
        parts = write_parts(testdata.ad_lines(session, sf_dir), prepared)
        run_parts(session, prepared, parts, tables, threshold)
        _replays[key] = tables
    tables = _replays[key]
    if start and (*key, start) not in _replays:
        session = stream_session(spark, size)
        stream = tables.admitted.stream(session, _ENTRIES_PER_BATCH)
        start(stream, tables, trigger=streams.AVAILABLE_NOW).awaitTermination()
        _replays[(*key, start)] = tables
    return tables
