"""The streaming jobs: their tables against the batch operators and against hand-worked runs."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from clickloom.operators import ads
from clickloom.registry.replay import (
    parts_of_days, run_days, run_parts, stream_session, write_days, write_parts)
from clickloom.sources import adlog, storage
from clickloom.streaming import clicks as streams
from clickloom.streaming.clicks import AVAILABLE_NOW, AdTables
from tests.tables import click, lines, rows, texted

READERS = (streams.start_region_counts, streams.start_province_top3, streams.start_click_trend)


class Run:
    """An ad stream fed by hand; every call of ``feed`` is one micro-batch of every query."""

    def __init__(self, spark, threshold=3):
        self.session = stream_session(spark, 100 << 20)
        self.threshold = threshold
        self.tables = AdTables(storage.new_run_dir(spark, "ads")).create(self.session)
        self.landing = f"{self.tables.root}/landing"
        storage.make_dir(self.session, self.landing)
        self.fed = 0

    def admit(self, *texts):
        if texts:
            self.fed += 1
            (lines(self.session, *texts).coalesce(1).write
             .text(f"{self.landing}/{self.fed:03d}"))
        return self._finish(streams.start_admission(
            adlog.file_lines(self.session, self.landing), self.tables, AVAILABLE_NOW))

    def count(self):
        return self._finish(streams.start_user_clicks(
            self.tables.admitted.stream(self.session), self.tables,
            self.threshold, trigger=AVAILABLE_NOW))

    def read(self, start):
        return self._finish(start(
            self.tables.admitted.stream(self.session), self.tables, trigger=AVAILABLE_NOW))

    def feed(self, *texts):
        self.admit(*texts)
        self.count()

    @staticmethod
    def _finish(query):
        query.awaitTermination()
        assert query.exception() is None
        return query


@pytest.fixture
def run(spark):
    return Run(spark)


def test_blacklisted_from_the_next_batch_on(spark, run):
    run.feed(*[click(1, user=7)] * 2, click(1, user=8))
    assert rows(run.tables.blacklist.rows(spark)) == []
    run.feed(*[click(1, user=7)] * 2)  # reaches the threshold: still counted
    assert rows(run.tables.blacklist.rows(spark)) == [(7,)]
    run.feed(click(1, user=7), click(2, user=7), click(2, user=8))  # dropped
    assert rows(run.tables.admitted.rows(spark).groupBy("userid").count()) == [(7, 4), (8, 2)]
    assert rows(texted(streams.user_clicks(spark, run.tables))) == [
        ("2024-01-01", 7, 1, 4), ("2024-01-01", 8, 1, 1), ("2024-01-02", 8, 1, 1)]


def test_malformed_lines_are_counted_and_dropped(spark, run):
    query = run.admit("abc", "1 2", click(1))
    observed = query.lastProgress.observedMetrics["ad_log"]
    assert (observed["lines"], observed["malformed"]) == (3, 2)
    assert run.tables.admitted.rows(spark).count() == 1


def test_restarts_go_on_from_the_checkpoint(spark, run):
    for _ in range(3):  # every feed starts each query anew
        run.feed(click(1, user=5, ad=1), click(1, user=6, ad=1))
        run.read(streams.start_region_counts)
    run.admit()  # nothing new
    assert rows(texted(streams.region_counts(spark, run.tables))) == [
        ("2024-01-01", "0", "0", 1, 6)]


def test_late_days_are_counted(spark, run):
    for day in (1, 2, 3, 9, 9, 8, 1):
        run.feed(click(day, user=day))
        for start in READERS:
            run.read(start)
    counts = rows(texted(streams.region_counts(spark, run.tables).groupBy("date").agg(
        F.sum("clickCount").alias("clickCount"))), "date", "clickCount")
    assert counts == [("2024-01-01", 2), ("2024-01-02", 1), ("2024-01-03", 1),
                      ("2024-01-08", 1), ("2024-01-09", 2)]
    assert streams.click_trend(spark, run.tables).agg({"clickCount": "sum"}).first()[0] == 7
    assert streams.province_top3(spark, run.tables).agg({"clickCount": "sum"}).first()[0] == 7


def test_many_files_in_any_order_lose_nothing(spark, run):
    run.admit(*[click(day, user=k, ad=k % 3, second=97 * k % 80000)
                for day in (3, 1, 2) for k in range(70)])
    run.tables.admitted.rows(spark).repartition(200).write.parquet(f"{run.tables.root}/spread")
    clicks = adlog.admitted_clicks(run.session, f"{run.tables.root}/spread", 64)
    for start in READERS:
        run._finish(start(clicks, run.tables, trigger=AVAILABLE_NOW))
    batch = run.tables.admitted.rows(spark)
    assert rows(streams.region_counts(spark, run.tables)) == rows(ads.ad_region_counts(batch))
    assert rows(streams.click_trend(spark, run.tables)) == rows(
        ads.ad_click_trend(ads.minute_counts(batch)))


def test_times_out_of_range_are_malformed(spark, run):
    query = run.admit("9223372036854775807 0 0 1 2", "4102444800000 0 0 1 2", "-1 0 0 1 2",
                      click(1))
    assert query.lastProgress.observedMetrics["ad_log"]["malformed"] == 3
    assert run.tables.admitted.rows(spark).count() == 1


def test_another_checkpoint_is_refused(spark, run):
    run.feed(click(1), click(1))
    run.read(streams.start_region_counts)
    other = AdTables(storage.new_run_dir(spark, "other"))

    class Moved(AdTables):
        def checkpoint(self, name):
            return other.checkpoint(name)

    moved = Moved(run.tables.root)
    query = streams.start_region_counts(
        moved.admitted.stream(run.session), moved, trigger=AVAILABLE_NOW)
    with pytest.raises(Exception, match="another checkpoint"):
        query.awaitTermination()
    assert streams.region_counts(spark, run.tables).agg({"clickCount": "sum"}).first()[0] == 2


def test_tables_equal_the_batch_operators(spark):
    # Clicks of a few days in random batches; one province and one ad have most of them.
    rng = random.Random(3)
    run = Run(spark, threshold=10**6)
    texts = []
    for day in (1, 2, 3):
        for _ in range(2):
            batch = [click(day, user=rng.randrange(50), ad=rng.choice([1, 1, 1, *range(9)]),
                           province=rng.choice("000123"), second=rng.randrange(900))
                     for _ in range(80)]
            texts += batch
            run.admit(*batch)
            for start in READERS:
                run.read(start)
    clicks = adlog.parse_ad_log(lines(spark, *texts))
    regions = ads.ad_region_counts(clicks)
    tables = run.tables
    assert rows(streams.region_counts(spark, tables)) == rows(regions)
    assert rows(streams.province_top3(spark, tables)
                .select("date", "province", "adid", "clickCount")) == rows(
        ads.ad_province_top3(ads.ad_province_counts(regions)))
    minutes = ads.minute_counts(clicks)
    assert rows(streams.click_trend(spark, tables)) == rows(ads.ad_click_trend(minutes))
    assert rows(streams.recent_hour(spark, tables)) == rows(ads.ad_recent_hour(minutes))


def test_recent_hour_with_bounds_reads_the_days_it_needs(spark, run):
    texts = [click(day, ad=day % 2, second=s) for day in (1, 4, 8) for s in (0, 60, 4000)]
    run.admit(*texts)
    run.read(streams.start_click_trend)
    since = dt.datetime(2024, 1, 4, 12, 0, tzinfo=dt.timezone.utc)
    until = since + dt.timedelta(minutes=30)
    bounded = streams.recent_hour(spark, run.tables, since, until)
    every = streams.recent_hour(spark, run.tables)
    assert rows(bounded) == rows(every.where(
        F.col("window_start").between(F.lit(since), F.lit(until - dt.timedelta(minutes=1)))))
    plan = bounded._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "date" in filters and ">= 2024-01-03" in filters and "<= 2024-01-05" in filters


def test_minutes_of_one_name_are_counted_apart(spark, run):
    """The hour that autumn repeats: 05:30 and 06:30 UTC are both 01:30 in New York."""
    moments = [int(dt.datetime(2023, 11, 5, h, 30, tzinfo=dt.timezone.utc).timestamp() * 1000)
               for h in (5, 6)]
    run.session.conf.set("spark.sql.session.timeZone", "America/New_York")
    run.admit(*[f"{m} 0 0 1 1" for m in moments])
    run.read(streams.start_click_trend)
    assert rows(streams.minute_counts(run.session, run.tables), "clickCount") == [(1,), (1,)]
    assert rows(streams.click_trend(run.session, run.tables), "hour", "minute") == [
        ("01", "30")] * 2


def test_service_goes_on_after_compaction(spark, run):
    for second in (0, 30):
        run.feed(*[click(1, user=u, ad=u % 2, second=second) for u in range(6)])
        for start in READERS:
            run.read(start)
    reads = (streams.user_clicks, streams.region_counts, streams.province_top3,
             streams.click_trend)
    before = [rows(read(spark, run.tables)) for read in reads]
    run.tables = streams.compact(run.session, run.tables)
    assert run.tables == AdTables.newest(spark, run.tables.root) != AdTables(run.tables.root)
    assert [rows(read(spark, run.tables)) for read in reads] == before
    assert run.tables.user_clicks.read(spark).select("batch_id").distinct().count() == 1
    # The third click of each user and ad; two of them are in the compacted tables.
    run.feed(*[click(1, user=u, ad=u % 2, second=90) for u in range(6)])
    for start in READERS:
        run.read(start)
    for read in reads:
        assert read(spark, run.tables).agg({"clickCount": "sum"}).first()[0] == 18
    assert run.tables.blacklist.rows(spark).count() == 6


def test_whole_service(spark):
    run = Run(spark)
    lines(spark, *[click(1, user=u, ad=u % 2) for u in range(9)]).write.text(f"{run.landing}/1")
    queries = streams.start_all(adlog.file_lines(run.session, run.landing), run.tables, 1,
                                {"processingTime": "0 seconds"})
    try:
        for query in queries:
            query.processAllAvailable()
    finally:
        for query in queries:
            query.stop()
    assert run.tables.blacklist.rows(spark).count() == 9
    for read in (streams.user_clicks, streams.region_counts, streams.province_top3,
                 streams.click_trend):
        assert read(spark, run.tables).agg({"clickCount": "sum"}).first()[0] == 9


def test_stored_totals(spark):
    clicks = adlog.parse_ad_log(lines(spark, *[click(1, user=1)] * 2, click(1, user=2)))
    counts = ads.ad_user_daily_clicks(clicks)
    stored = counts.where("userid = 1").selectExpr("date", "userid", "adid", "5L as clickCount")
    assert rows(ads.add_stored(counts, stored), "userid", "clickCount") == [(1, 7), (2, 1)]


def test_recent_hour_equals_sliding_windows(spark):
    rng = random.Random(1)
    texts = [click(day, ad=rng.choice([1, 1, 2]), second=rng.choice([0, 59, rng.randrange(9000)]))
             for day in (1, 1, 2) for _ in range(40)]
    clicks = adlog.parse_ad_log(lines(spark, *texts))
    windows = (clicks.groupBy(F.window("click_time", "60 minutes", "1 minute").alias("w"), "adid")
               .count().select("w.start", "w.end", "adid", "count"))
    assert rows(ads.ad_recent_hour(ads.minute_counts(clicks))) == rows(windows)


def test_batch_admission_is_day_by_day(spark):
    texts = [click(1, user=1)] * 4 + [click(2, user=1), click(1, user=2), click(2, user=2)]
    texts += [click(3, user=3)] * 2 + [click(3, user=3, ad=2)] * 2
    clicks = adlog.parse_ad_log(lines(spark, *texts))
    admitted = ads.ad_clicks_admitted(clicks, threshold=3)
    assert rows(texted(admitted).groupBy("date", "userid").count()) == [
        ("2024-01-01", 1, 4), ("2024-01-01", 2, 1), ("2024-01-02", 2, 1), ("2024-01-03", 3, 4)]
    assert rows(ads.ad_blacklist(clicks, 3)) == [(1,)]
    assert rows(ads.drop_blacklisted(clicks, ads.ad_blacklist(clicks, 3)).select("userid")
                .distinct()) == [(2,), (3,)]


def test_days_are_written_in_order(spark):
    path = storage.new_run_dir(spark, "days")
    log = lines(spark, click(3), click(1), click(2), click(1))
    assert write_days(log, path) == ["day=2024-01-01", "day=2024-01-02", "day=2024-01-03"]
    assert spark.read.text(f"{path}/day=2024-01-01").count() == 2


def test_a_long_log_is_replayed_in_few_batches(spark, run):
    """More days than parts; users are barred within a part, and by an earlier part."""
    rng = random.Random(8)
    texts = ["bad line", *(click(day, user=rng.randrange(5 * day), ad=rng.randrange(2),
                                 second=rng.randrange(900))
                           for day in range(1, 29) for _ in range(30))]
    texts += [click(1, user=900)] * 3 + [click(2, user=900), click(28, user=900)]
    log, threshold = lines(spark, *texts), 3
    prepared = f"{run.tables.root}/prepared"
    days = write_days(log, prepared)
    assert len(days) == 29  # one folder for the line without a day
    run_days(run.session, prepared, days, run.tables, threshold)
    assert len(run.tables.admitted.entries(spark, run.tables.admitted.open_days(spark))) == 20
    clicks = adlog.parse_ad_log(log)
    admitted = ads.ad_clicks_admitted(clicks, threshold)
    assert 0 < admitted.count() < clicks.count()
    assert rows(run.tables.admitted.rows(spark)) == rows(admitted)
    assert rows(run.tables.blacklist.rows(spark)) == rows(ads.ad_blacklist(admitted, threshold))
    assert rows(streams.user_clicks(spark, run.tables)) == rows(
        ads.ad_user_daily_clicks(admitted))


def test_a_log_of_many_days_is_stored_in_few_folders(spark, run):
    """Whole days in order, a long day, lines without a day; nothing is moved day by day."""
    texts = ["bad line", *[click(3, user=1)] * 200,
             *(click(day, user=day % 5, ad=k % 2, second=k) for day in range(1, 29)
               for k in range(9))]
    log, threshold = lines(spark, *texts), 3
    prepared = f"{run.tables.root}/prepared"
    parts = write_parts(log, prepared, 6)
    assert 3 <= len(parts) <= 6
    held = [[r.value for r in spark.read.text(f"{prepared}/{part}").collect()] for part in parts]
    assert sorted(line for part in held for line in part) == sorted(texts)
    days = [sorted({int(line.split()[0]) // 86400000 for line in part if line != "bad line"})
            for part in held]
    assert all(a[-1] < b[0] for a, b in zip(days, days[1:])) and sum(map(len, days)) == 28
    run_parts(run.session, prepared, parts, run.tables, threshold)
    admitted = ads.ad_clicks_admitted(adlog.parse_ad_log(log), threshold)
    assert rows(run.tables.admitted.rows(spark)) == rows(admitted)
    assert rows(run.tables.blacklist.rows(spark)) == rows(ads.ad_blacklist(admitted, threshold))


def test_an_empty_log_has_no_parts(spark, run):
    assert write_parts(lines(spark, "x").limit(0), f"{run.tables.root}/prepared") == []


@pytest.mark.parametrize("n, parts", [(0, []), (1, [1]), (20, [1] * 20), (45, [2, 2, 2, 3] * 5),
                                      (300, [15] * 20)])
def test_parts_hold_all_days_in_order(n, parts):
    days = [f"day={k:04d}" for k in range(n)]
    found = parts_of_days(days)
    assert [day for part in found for day in part] == days
    assert [len(part) for part in found] == parts


def test_days_of_a_batch_are_admitted_in_order_and_lines_counted_once(spark, run):
    (lines(run.session, *[click(1, user=1)] * 3, click(2, user=1), click(2, user=2), "bad")
     .coalesce(1).write.text(f"{run.landing}/001"))
    query = run._finish(streams.start_admission(
        adlog.file_lines(run.session, run.landing), run.tables, AVAILABLE_NOW,
        daily_threshold=3))
    assert rows(run.tables.admitted.rows(spark).groupBy("userid").count()) == [(1, 3), (2, 1)]
    seen = [p["observedMetrics"]["ad_log"] for p in query.recentProgress if p["observedMetrics"]]
    assert [(m["lines"], m["malformed"]) for m in seen] == [(6, 1)]


def test_recent_hour_carries_over_midnight_and_empty_days(spark):
    """Windows that begin on the day before their clicks, and days without any click of an ad."""
    texts = [click(day, ad=1, second=s) for day, s in (
        (1, 43000), (1, 43199), (2, -43200), (2, -40000), (5, -43190), (9, 5))]
    texts += [click(2, ad=2, second=-43200)] * 3
    clicks = adlog.parse_ad_log(lines(spark, *texts))
    windows = (clicks.groupBy(F.window("click_time", "60 minutes", "1 minute").alias("w"), "adid")
               .count().select("w.start", "w.end", "adid", "count"))
    found = ads.ad_recent_hour(ads.minute_counts(clicks))
    assert rows(found) == rows(windows)


def test_recent_hour_spreads_an_ad_over_its_days(spark):
    texts = [click(day, ad=1, second=s * 60) for day in range(1, 29) for s in range(0, 600, 7)]
    counts = ads.minute_counts(adlog.parse_ad_log(lines(spark, *texts)))
    found = ads.ad_recent_hour(counts)
    plan = found._jdf.queryExecution().executedPlan().toString()
    running = [p for p in plan.split("\n") if "Window [" in p and "sum(n" in p]
    assert running and all("adid" in p and "day" in p.split("], [")[1] for p in running)
    assert "hashpartitioning(adid" in plan
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spread = ads.ad_recent_hour(counts).select(F.spark_partition_id().alias("p"))
        assert spread.distinct().count() > 4  # all rows are of one ad
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
