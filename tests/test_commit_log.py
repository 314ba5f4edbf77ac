"""Tables behind a commit log: failures at every step, levels, days that are closed."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.operators import ads
from clickloom.sources import adlog, storage
from clickloom.streaming import batch_log, clicks as streams
from clickloom.streaming.click_feed import ClickFeed, ReaderProgress
from clickloom.sources.commit_log import CommitLog, Conflict
from clickloom.streaming.published import Published
from tests.tables import click, lines, rows
from tests.test_ads_stream import Run

KEYS = ["date", "userid", "adid"]


class Killed(Exception):
    pass


@pytest.fixture
def killed(monkeypatch):
    """The process dies before a commit: the data is written, nothing names it."""
    def at(calls=1, target=CommitLog, name="commit"):
        left, method = [calls], getattr(target, name)

        def wrapped(self, *args):
            left[0] -= 1
            if not left[0]:
                raise Killed
            return method(self, *args)

        monkeypatch.setattr(target, name, wrapped)
        return monkeypatch.undo

    return at


def counts(spark, *values):
    df = spark.createDataFrame(values, "day int, userid long, adid long, clickCount long")
    return df.selectExpr("date_add(date'2024-01-01', day) as date", "userid", "adid", "clickCount")


def table(spark, **settings):
    return batch_log.adding(storage.new_run_dir(spark, "log"), schemas.AD_USER_CLICK_COUNT, KEYS,
                            "clickCount", ("date",), **settings).create(spark)


def current(spark, log, days=None):
    return rows(batch_log.current_sum(log.read(spark, days), KEYS, "clickCount"))


def test_a_file_appears_once_and_whole(spark):
    folder = storage.new_run_dir(spark, "files")
    storage.make_dir(spark, folder)
    assert storage.put_new(spark, f"{folder}/a", "é one")
    assert not storage.put_new(spark, f"{folder}/a", "two")
    assert storage.read_text(spark, f"{folder}/a") == "é one"
    assert storage.child_files(spark, folder) == ["a"]
    assert storage.child_files(spark, f"{folder}/none") == []


def test_of_two_writers_one_fails(spark):
    log = CommitLog(storage.new_run_dir(spark, "versions"), keep=3)
    assert log.latest(spark) == (-1, {})
    for version in range(6):
        log.commit(spark, version, {"n": version})
    assert log.latest(spark) == (5, {"n": 5})
    with pytest.raises(Conflict):
        log.commit(spark, 5, {"n": 0})
    assert len(storage.child_files(spark, log.path)) == 3


def test_a_killed_batch_is_never_seen(spark, killed):
    log = table(spark)
    log.append(counts(spark, (0, 1, 1, 5)), 0)
    revive = killed()
    with pytest.raises(Killed):
        log.append(counts(spark, (0, 1, 1, 7)), 1)
    revive()
    # A store without atomic renames leaves half a copy: some files under a name of their own.
    counts(spark, (0, 9, 9, 9)).write.parquet(f"{log.path}/batch_id=1/run=half/date=2024-01-01")
    assert current(spark, log) == [(dt.date(2024, 1, 1), 1, 1, 5)]
    for _ in range(2):  # the replay
        log.append(counts(spark, (0, 1, 1, 7)), 1)
    assert current(spark, log) == [(dt.date(2024, 1, 1), 1, 1, 12)]


def test_a_killed_merge_changes_nothing(spark, killed):
    log = table(spark, fan=2)
    for batch in (0, 1):
        log.append(counts(spark, (0, 1, 1, 1)), batch)
    revive = killed()  # the first commit of the next batch is that of the merge
    with pytest.raises(Killed):
        log.append(counts(spark, (0, 1, 1, 1)), 2)
    revive()
    assert log.last_batch(spark) == 1 and current(spark, log)[0][-1] == 2
    log.append(counts(spark, (0, 1, 1, 1)), 2)
    assert log.last_batch(spark) == 2 and current(spark, log)[0][-1] == 3


def test_files_of_a_day_stay_few(spark):
    """Sums after many batches equal those of all rows, from a logarithmic number of runs."""
    rng, log, fan = random.Random(2), table(spark, fan=3, keep_seconds=0), 3
    every, most = [], 0
    for batch in range(30):
        values = [(rng.randrange(2), rng.randrange(3), 1, rng.randrange(1, 9)) for _ in range(3)]
        every += values
        log.append(counts(spark, *values).groupBy(KEYS).agg(F.sum("clickCount").alias("clickCount"))
                   .coalesce(1), batch)
        runs = log._state(spark)[1]["runs"]
        most = max(most, len(runs))
        assert rows(log.batch(spark, batch).agg(F.sum("clickCount"))) == [
            (sum(v[-1] for v in values),)]
    assert most <= 4 * fan and max(r["level"] for r in runs) == 3
    assert current(spark, log) == rows(counts(spark, *every).groupBy(KEYS).agg(F.sum("clickCount")))
    one_day = log.read(spark, ["2024-01-01"])
    assert len(one_day.inputFiles()) <= len(runs)
    assert all("date=2024-01-01" in f for f in one_day.inputFiles())
    # Replaced runs are gone, but for those of the last merge.
    kept = [f for f in storage.child_dirs(spark, log.path) if storage.child_dirs(
        spark, f"{log.path}/{f}")]
    assert len(kept) <= len(runs) + fan


@pytest.mark.parametrize("fan", [2, 8])
def test_levels_over_thousands_of_batches(fan):
    levels, written = [], 0
    for batch in range(1, 20_001):
        while (level := batch_log.due(levels, fan)) is not None:
            levels = [x for x in levels if x != level] + [level + 1]
            written += fan ** (level + 1)
        levels.append(0)
        depth = next(k for k in range(64) if fan ** k >= batch)
        assert len(levels) <= fan * (depth + 1)
    assert sum(fan ** level for level in levels) == 20_000  # every batch is in one run
    assert written <= 20_000 * depth


def test_replacing_tables_keep_the_newest_value_over_merges(spark):
    log = batch_log.replacing(storage.new_run_dir(spark, "set"), schemas.AD_USER_CLICK_COUNT, KEYS,
                              "clickCount", ("date",), fan=2)
    for batch in range(7):
        log.append(counts(spark, (0, batch % 3, 1, batch)), batch)
    assert rows(batch_log.current_last(log.read(spark), KEYS, "clickCount"),
                "userid", "clickCount") == [(0, 6), (1, 4), (2, 5)]


def test_users_are_barred_when_they_reach_the_threshold(spark):
    """By any ad and day, once; a lower threshold bars those who had reached it before."""
    run = Run(spark, threshold=3)
    run.feed(*[click(1, user=1)] * 2, *[click(1, user=2)] * 3, *[click(1, user=3)] * 2)
    assert rows(run.tables.blacklist.rows(spark)) == [(2,)]
    run.feed(click(1, user=1), *[click(2, user=3)] * 2)
    assert rows(run.tables.blacklist.rows(spark)) == [(1,), (2,)]
    # A batch that bars nobody adds nothing.
    listed = len(run.tables.blacklist.read(spark).inputFiles())
    run.feed(click(4, user=4))
    assert len(run.tables.blacklist.read(spark).inputFiles()) == listed
    run.threshold = 2
    run.feed(click(4, user=5))
    assert rows(run.tables.blacklist.rows(spark)) == [(1,), (2,), (3,)]
    run.feed(click(4, user=4))
    assert rows(run.tables.blacklist.rows(spark)) == [(1,), (2,), (3,), (4,)]


# --- published lists ------------------------------------------------------------------------

def lists(spark, *values):
    df = spark.createDataFrame(values, "day int, province string, adid long, clickCount long")
    return df.selectExpr("date_add(date'2024-01-01', day) as date", "province", "adid", "clickCount")


def test_readers_see_old_or_new_lists(spark, killed):
    top = Published(storage.new_run_dir(spark, "top"), schemas.AD_PROVINCE_TOP3,
                    ("date", "province")).create(spark)
    assert rows(top.read(spark)) == []
    top.replace(lists(spark, (0, "0", 1, 5), (0, "1", 2, 4), (1, "0", 3, 3)), 0, "note")
    before = top.read(spark)
    revive = killed()
    with pytest.raises(Killed):
        top.replace(lists(spark, (0, "0", 9, 9), (1, "0", 9, 9)), 1)
    revive()
    assert rows(top.read(spark), "adid") == [(1,), (2,), (3,)]
    top.replace(lists(spark, (0, "0", 9, 9), (1, "0", 9, 9)), 1)
    # A reader that began with the old lists goes on with them.
    assert rows(before, "adid") == [(1,), (2,), (3,)]
    assert rows(top.read(spark), "adid") == [(2,), (9,), (9,)]
    assert rows(top.read(spark, ["2024-01-01"]), "adid") == [(2,), (9,)]
    assert top.read(spark, []).count() == 0
    # The old folder has no day left and goes after a while.
    later = Published(top.path, top.schema, top.groups, keep_seconds=0)
    later.replace(lists(spark, (5, "0", 7, 7)), 2)
    assert len(storage.child_dirs(spark, top.path)) == 3
    assert rows(later.read(spark), "adid") == [(2,), (7,), (9,), (9,)]


def test_top_lists_from_changed_ads_equal_those_of_all(spark):
    rng, run, texts = random.Random(7), Run(spark), []
    for feed in range(5):
        batch = [click(1 + rng.randrange(2), ad=rng.choice([1, 1, 2, 3, 4, 5]),
                       province=rng.choice("01")) for _ in range(rng.choice([2, 30]))]
        texts += batch
        run.admit(*batch)
        # The lists grow longer in between: then they come from all counts.
        top = 2 if feed < 3 else 4
        run.read(lambda clicks, tables, trigger: streams.start_province_top3(
            clicks, tables, top, trigger))
        found = streams.province_top3(spark, run.tables)
        every = ads.ad_region_counts(adlog.parse_ad_log(lines(spark, *texts)))
        assert rows(found.select("date", "province", "adid", "clickCount")) == rows(
            ads.ad_province_top3(ads.ad_province_counts(every), top))


# --- the feed -------------------------------------------------------------------------------

def clicks_of(spark, *users):
    return adlog.parse_ad_log(lines(spark, *[click(1, user=u) for u in users]))


def users_of(df):
    return sorted(r["userid"] for r in df.collect())


def test_days_are_closed_when_every_reader_is_sure(spark, killed):
    feed = ClickFeed(storage.new_run_dir(spark, "feed")).create(spark)
    readers = [ReaderProgress(storage.new_run_dir(spark, f"reader{k}")) for k in range(2)]
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    for batch, (day, users) in enumerate([(0, [1]), (0, [2, 3]), (1, [4]), (2, [5])]):
        assert feed.append(clicks_of(spark, *users), batch, days[day])
        assert not feed.append(clicks_of(spark, 99), batch, days[day])
    first, second = str(days[0]), str(days[1])
    assert feed.close_days(spark, readers, days[2]) == []
    readers[0].done(spark, 0, [first, first])
    readers[1].done(spark, 0, [first])
    readers[1].done(spark, 0, [first])  # a replay counts once
    readers[1].done(spark, 1, [first, second])
    # What the last batch of a reader took may be asked for again after a restart.
    assert feed.close_days(spark, readers, days[2]) == []
    readers[0].done(spark, 1, [second])
    readers[1].done(spark, 2, [])
    revive = killed(target=ClickFeed, name="_read")
    with pytest.raises(Killed):
        feed.close_days(spark, readers, days[2])
    revive()
    assert users_of(feed.rows(spark)) == [1, 2, 3, 4, 5]
    assert feed.close_days(spark, readers, days[2]) == [first]
    assert feed.open_days(spark) == [second, str(days[2])]
    assert users_of(feed.rows(spark)) == [1, 2, 3, 4, 5]
    assert not feed.append(clicks_of(spark, 99), 1, days[2])  # a batch of the closed day


def test_a_failure_while_entries_are_removed(spark, monkeypatch):
    feed = ClickFeed(storage.new_run_dir(spark, "feed")).create(spark)
    feed.append(clicks_of(spark, 1, 2), 0, dt.date(2024, 1, 1))
    with monkeypatch.context() as patch:
        patch.setattr(storage, "remove", lambda *_: (_ for _ in ()).throw(Killed()))
        with pytest.raises(Killed):
            feed.close_days(spark, [], dt.date(2024, 1, 2))
    assert feed.open_days(spark) == ["2024-01-01"]
    assert users_of(feed.rows(spark)) == [1, 2]  # not twice
    assert feed.close_days(spark, [], dt.date(2024, 1, 2)) == ["2024-01-01"]
    assert users_of(feed.rows(spark)) == [1, 2] and feed.open_days(spark) == []


def test_the_service_lists_open_days_only(spark):
    """Days go by; readers restart with every one of them, lose nothing and count nothing twice."""
    run = Run(spark, threshold=10**6)
    readers = (streams.start_region_counts, streams.start_province_top3, streams.start_click_trend)
    listed = []
    for day in range(1, 5):
        run.fed += 1
        (lines(run.session, *[click(day, user=u) for u in range(3)]).coalesce(1).write
         .text(f"{run.landing}/{run.fed:03d}"))
        run._finish(streams.start_admission(
            adlog.file_lines(run.session, run.landing), run.tables, streams.AVAILABLE_NOW,
            today=lambda: dt.date(2024, 5, day)))
        run.count()
        for start in readers:
            run.read(start)
        listed.append(len(run.tables.admitted.open_days(spark)))
    assert listed == [1, 2, 2, 2]
    assert run.tables.admitted.rows(spark).count() == 12
    for read in (streams.user_clicks, streams.region_counts, streams.click_trend):
        assert read(spark, run.tables).agg({"clickCount": "sum"}).first()[0] == 12


def test_what_killed_batches_left_is_swept(spark, killed):
    run = Run(spark, threshold=1)
    for feed in range(2):
        run.feed(click(1, user=feed), click(2, user=feed))
        run.read(streams.start_province_top3)
    tables = run.tables
    before = [rows(read(spark, tables)) for read in (streams.user_clicks, streams.province_top3)]
    admitted = users_of(tables.admitted.rows(spark))
    late = clicks_of(spark, 8)
    revive = killed()
    with pytest.raises(Killed):
        tables.user_clicks.append(ads.ad_user_daily_clicks(late), 7)
    revive()
    revive = killed()
    with pytest.raises(Killed):
        tables.province_top3.replace(lists(spark, (0, "0", 9, 9)), 7)
    revive()
    revive = killed(target=storage, name="put_new")
    with pytest.raises(Killed):
        tables.admitted.append(late, 7, dt.date(2024, 1, 1))
    revive()
    assert streams.sweep(spark, tables) == []  # they may still be at work
    swept = streams.sweep(spark, tables, keep_seconds=-1)
    assert len(swept) == 3 and streams.sweep(spark, tables, keep_seconds=-1) == []
    assert [rows(read(spark, tables)) for read in (streams.user_clicks,
                                                   streams.province_top3)] == before
    assert users_of(tables.admitted.rows(spark)) == admitted
    run.feed(click(3, user=5))
    assert streams.user_clicks(spark, tables).count() == len(before[0]) + 1
