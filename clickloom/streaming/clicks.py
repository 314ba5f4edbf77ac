"""The streaming jobs on ad clicks.

``start_admission`` drops the clicks of barred users and stores the rest; the other queries read
what it stored. ``start_user_clicks`` feeds the blacklist that the admission re-reads with every
micro-batch. Every query has its own checkpoint and no state: a micro-batch adds the counts of its
own clicks, once, and the current rows are sums. So no click is too late, whatever its day, how its
files are cut into batches, or what clock it came from. Where a batch needs totals, it reads the
stored counts of its own days, which are in a few runs of growing size.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickloom import schemas
from clickloom.operators import ads
from clickloom.sources import storage
from clickloom.sources.adlog import BEFORE_MILLIS, parse_ad_log
from clickloom.streaming import batch_log
from clickloom.streaming.batch_log import BatchLog
from clickloom.streaming.click_feed import ClickFeed, ReaderProgress, read_entries, utc_day
from clickloom.streaming.published import Published

# Triggers: the running service, and "all there is, then stop".
EVERY_BATCH = {"processingTime": "5 seconds"}
AVAILABLE_NOW = {"availableNow": True}

# Batches of the admission that a reader takes at once, when it has some to catch up with.
ENTRIES_PER_BATCH = 1000

_GENERATIONS = "generations"
# The queries that read admitted clicks; a day is closed when all of them have.
READERS = ("ad_user_clicks", "ad_region_counts", "ad_province_top3", "ad_click_trend")


@dataclass(frozen=True)
class AdTables:
    """The tables and checkpoints of the ad stream, below one shared folder.

    Compaction (:func:`compact`) writes the counting tables anew, as the next ``generation``.
    """

    root: str
    generation: int = 0

    @classmethod
    def newest(cls, spark: SparkSession, root: str) -> AdTables:
        """The tables as the last finished compaction has left them."""
        done = f"{root}/{_GENERATIONS}"
        names = storage.child_dirs(spark, done) if storage.exists(spark, done) else []
        return cls(root, max(map(int, names), default=0))

    def _path(self, name: str) -> str:
        suffix = f"-{self.generation}" if self.generation else ""
        return f"{self.root}/{name}{suffix}"

    def _counts(self, name: str, schema) -> BatchLog:
        keys = [c for c in schema.names if c != "clickCount"]
        return batch_log.adding(self._path(name), schema, keys, "clickCount", ("date",))

    @property
    def admitted(self) -> ClickFeed:
        # Streams read this folder and remember its files, so it stays where it is.
        return ClickFeed(f"{self.root}/ad_clicks_admitted")

    @property
    def blacklist(self) -> BatchLog:
        return BatchLog(self._path("ad_blacklist"), schemas.AD_BLACKLIST,
                        resolve=lambda log: log.select("userid").distinct())

    @property
    def user_clicks(self) -> BatchLog:
        return self._counts("ad_user_click_count", schemas.AD_USER_CLICK_COUNT)

    @property
    def regions(self) -> BatchLog:
        return self._counts("ad_stat", schemas.AD_STAT)

    @property
    def province_counts(self) -> BatchLog:
        return self._counts("ad_province_count", schemas.AD_PROVINCE_COUNT)

    @property
    def province_top3(self) -> Published:
        return Published(f"{self.root}/ad_province_top3", schemas.AD_PROVINCE_TOP3,
                         ("date", "province"))

    @property
    def trend(self) -> BatchLog:
        return self._counts("ad_click_trend", schemas.AD_MINUTE_COUNT)

    def progress(self, name: str) -> ReaderProgress:
        return ReaderProgress(f"{self.root}/progress/{name}")

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"

    @property
    def all(self) -> tuple[BatchLog | ClickFeed | Published, ...]:
        return (self.admitted, self.blacklist, self.user_clicks, self.regions,
                self.province_counts, self.province_top3, self.trend)

    def create(self, spark: SparkSession) -> AdTables:
        for table in self.all:
            table.create(spark)
        return self


def _start(stream: DataFrame, name: str, tables: AdTables, write, trigger: dict,
           mode: str = "update") -> StreamingQuery:
    return (stream.writeStream.queryName(name).outputMode(mode)
            .option("checkpointLocation", tables.checkpoint(name))
            .foreachBatch(write)
            .trigger(**trigger)
            .start())


def _start_reader(clicks: DataFrame, name: str, tables: AdTables, write,
                  trigger: dict) -> StreamingQuery:
    """A query over clicks, or over the entries of the feed, which name the clicks of a batch."""
    def write_entries(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        entries = read_entries(row["value"] for row in batch.collect())
        write(tables.admitted.clicks(spark, entries), batch_id)
        tables.progress(name).done(spark, batch_id, [e["day"] for e in entries])

    return _start(clicks, name, tables, write_entries if clicks.columns == ["value"] else write,
                  trigger, mode="append")


def start_admission(lines: DataFrame, tables: AdTables, trigger: dict = EVERY_BATCH,
                    today: Callable[[], dt.date] = utc_day,
                    before_millis: int = BEFORE_MILLIS,
                    daily_threshold: int | None = None) -> StreamingQuery:
    """Parse the log, drop the clicks of users on the blacklist, store the others.

    The blacklist is read anew in every micro-batch. Malformed lines are dropped and counted: the
    query's progress reports ``lines`` and ``malformed`` under ``ad_log``. Days on which clicks
    arrived, by ``today``, are closed when they are over and all readers have done with them.

    A backlog may come in batches of several whole days. With ``daily_threshold`` the rule goes on
    by day inside such a batch: a user who reaches it is barred from the next day on.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark, day = batch.sparkSession, today()
        tables.admitted.close_days(spark, [tables.progress(name) for name in READERS], day)
        clicks = ads.drop_blacklisted(batch, tables.blacklist.read(spark))
        if daily_threshold is None:
            tables.admitted.append(clicks, batch_id, day)
            return
        # Read twice, for the counts and to be stored; the lines are parsed and counted once.
        clicks.persist()
        try:
            tables.admitted.append(ads.ad_clicks_admitted(clicks, daily_threshold), batch_id, day)
        finally:
            clicks.unpersist()

    return _start(parse_ad_log(lines, "ad_log", before_millis), "ad_admission", tables, write,
                  trigger, mode="append")


def _in_days_of(log: BatchLog, spark: SparkSession, batch_id: int) -> DataFrame:
    """What the log has for the days of its last batch; no other days are listed."""
    return log.read(spark, log.days_of(spark, batch_id))


def start_user_clicks(clicks: DataFrame, tables: AdTables,
                      threshold: int = ads.BLACKLIST_THRESHOLD,
                      trigger: dict = EVERY_BATCH) -> StreamingQuery:
    """Clicks per day, user and ad, and the blacklist that follows from their sums.

    A batch bars the users whose total reaches the threshold with it, so it does not look at the
    list as it is: a user who is barred for two ads is in it twice until runs are merged. With
    another threshold than before, all totals are looked at once.
    """
    keys = ["date", "userid", "adid"]

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, log = batch.sparkSession, tables.user_clicks
        log.append(ads.ad_user_daily_clicks(batch), batch_id)
        same = tables.blacklist.note(spark) == threshold
        if same:
            added = log.batch(spark, batch_id).withColumnRenamed("clickCount", "added")
            totals = (_in_days_of(log, spark, batch_id).join(added, keys)
                      .groupBy(*keys, "added").agg(F.sum("clickCount").alias("clickCount"))
                      .where(F.col("clickCount") - F.col("added") < threshold))
        else:
            totals = log.rows(spark)
        tables.blacklist.append(ads.over_threshold(totals, threshold).distinct(), batch_id,
                                keep_empty=not same, note=threshold)

    return _start_reader(clicks, "ad_user_clicks", tables, write, trigger)


def start_region_counts(clicks: DataFrame, tables: AdTables,
                        trigger: dict = EVERY_BATCH) -> StreamingQuery:
    """Clicks per day, province, city and ad."""
    def write(batch: DataFrame, batch_id: int) -> None:
        tables.regions.append(ads.ad_region_counts(batch), batch_id)

    return _start_reader(clicks, "ad_region_counts", tables, write, trigger)


def start_province_top3(clicks: DataFrame, tables: AdTables, top: int = ads.TOP_ADS,
                        trigger: dict = EVERY_BATCH) -> StreamingQuery:
    """The most clicked ads per day and province, refreshed with every micro-batch.

    Counts only grow, so an ad that the batch has no click of can stay in a list or leave it, not
    enter it: the new lists of a province come from its old ones and the new totals of the batch's
    ads. They are published together, and readers see either the old or the new ones.
    """
    keys = ["date", "province", "adid"]

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        counts = ads.ad_province_counts(ads.ad_region_counts(batch))
        tables.province_counts.append(counts, batch_id)
        if tables.province_top3.note(spark) == top:
            changed = tables.province_counts.batch(spark, batch_id).select(keys)
            totals = batch_log.current_sum(
                _in_days_of(tables.province_counts, spark, batch_id)
                .join(changed, keys, "left_semi"), keys, "clickCount")
            old = tables.province_top3.read(spark, tables.province_counts.days_of(spark, batch_id))
            groups = changed.select(keys[:2]).distinct()
            candidates = (old.join(groups, keys[:2], "left_semi")
                          .join(changed, keys, "left_anti").select(*keys, "clickCount")
                          .union(totals))
        else:  # the first lists, or lists of another length
            candidates = batch_log.current_sum(tables.province_counts.read(spark), keys,
                                               "clickCount")
        tables.province_top3.replace(ads.ad_province_top3(candidates, top), batch_id, top)

    return _start_reader(clicks, "ad_province_top3", tables, write, trigger)


def start_click_trend(clicks: DataFrame, tables: AdTables,
                      trigger: dict = EVERY_BATCH) -> StreamingQuery:
    """Clicks per minute and ad."""
    def write(batch: DataFrame, batch_id: int) -> None:
        minutes = ads.minute_counts(batch).withColumn("date", F.to_date("minute_start"))
        tables.trend.append(minutes, batch_id)

    return _start_reader(clicks, "ad_click_trend", tables, write, trigger)


def start_all(lines: DataFrame, tables: AdTables, threshold: int = ads.BLACKLIST_THRESHOLD,
              trigger: dict = EVERY_BATCH) -> list[StreamingQuery]:
    """The whole service on a stream of log lines; wait with ``spark.streams``."""
    spark = lines.sparkSession
    tables.create(spark)
    admitted = tables.admitted.stream(spark, ENTRIES_PER_BATCH)
    return [
        start_admission(lines, tables, trigger),
        start_user_clicks(admitted, tables, threshold, trigger=trigger),
        start_region_counts(admitted, tables, trigger=trigger),
        start_province_top3(admitted, tables, trigger=trigger),
        start_click_trend(admitted, tables, trigger=trigger),
    ]


# Current rows of the result tables.

def user_clicks(spark: SparkSession, tables: AdTables) -> DataFrame:
    return batch_log.current_sum(tables.user_clicks.read(spark), ["date", "userid", "adid"],
                                  "clickCount")


def region_counts(spark: SparkSession, tables: AdTables) -> DataFrame:
    return batch_log.current_sum(tables.regions.read(spark),
                                  ["date", "province", "city", "adid"], "clickCount")


def province_top3(spark: SparkSession, tables: AdTables) -> DataFrame:
    return tables.province_top3.read(spark)


def minute_counts(spark: SparkSession, tables: AdTables, since: dt.datetime | None = None,
                  until: dt.datetime | None = None) -> DataFrame:
    """Clicks per minute and ad, of the minutes that start in ``[since, until)``."""
    log = tables.trend.read(spark)
    # The days prune folders; a day to spare on either side covers other time zones.
    if since is not None:
        log = log.where((F.col("date") >= F.date_sub(F.to_date(F.lit(since)), 1))
                        & (F.col("minute_start") >= F.lit(since)))
    if until is not None:
        log = log.where((F.col("date") <= F.date_add(F.to_date(F.lit(until)), 1))
                        & (F.col("minute_start") < F.lit(until)))
    return batch_log.current_sum(log, ["minute_start", "adid"], "clickCount")


def click_trend(spark: SparkSession, tables: AdTables) -> DataFrame:
    return ads.ad_click_trend(minute_counts(spark, tables))


def recent_hour(spark: SparkSession, tables: AdTables, since: dt.datetime | None = None,
                until: dt.datetime | None = None) -> DataFrame:
    """Clicks per ad in every 60 minutes, from the stored minute counts.

    With bounds: of the windows that start in ``[since, until)``, from the days they touch.
    """
    end = until + dt.timedelta(hours=1) if until is not None else None
    windows = ads.ad_recent_hour(minute_counts(spark, tables, since, end))
    if since is not None:
        windows = windows.where(F.col("window_start") >= F.lit(since))
    if until is not None:
        windows = windows.where(F.col("window_start") < F.lit(until))
    return windows


# Upkeep.

def sweep(spark: SparkSession, tables: AdTables,
          keep_seconds: int = batch_log.KEEP_SECONDS) -> list[str]:
    """Remove the folders that killed batches have left, also while the service runs; returns them.

    A folder that was written to within ``keep_seconds`` may be a batch's that is still running.
    """
    return [f"{table.path}/{folder}" for table in tables.all
            for folder in table.sweep(spark, keep_seconds)]


def compact(spark: SparkSession, tables: AdTables) -> AdTables:
    """Write the counting tables anew with one batch each, and return the new tables.

    Run it while the service is stopped; it goes on with ``AdTables.newest``. The compacted batch
    bears the number of the last one that is in it, so a batch that is replayed after the restart
    is recognised. An interrupted compaction leaves the old tables in charge.
    """
    target = AdTables(tables.root, tables.generation + 1)

    def summed(log: BatchLog, *keys: str) -> DataFrame:
        return batch_log.current_sum(log.read(spark), list(keys), "clickCount")

    steps = [
        (tables.blacklist, target.blacklist, lambda log: log.rows(spark)),
        (tables.user_clicks, target.user_clicks,
         lambda log: summed(log, "date", "userid", "adid")),
        (tables.regions, target.regions,
         lambda log: summed(log, "date", "province", "city", "adid")),
        (tables.province_counts, target.province_counts,
         lambda log: summed(log, "date", "province", "adid")),
        (tables.trend, target.trend, lambda log: summed(log, "date", "minute_start", "adid")),
    ]
    for old, new, resolved in steps:
        storage.remove(spark, new.path)
        batch_log.compact(old, resolved(old), new, old.last_batch(spark))
    storage.make_dir(spark, f"{tables.root}/{_GENERATIONS}/{target.generation}")
    return target
