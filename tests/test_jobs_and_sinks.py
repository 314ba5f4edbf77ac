import pytest

from clickloom import app, schemas, sinks
from clickloom.operators import ads, categories, sessions
from clickloom.plans import jobs
from clickloom.sources import adlog, jdbc, storage, tables
from clickloom.streaming import batch_log
from clickloom.streaming.batch_log import BatchLog
from clickloom.streaming.published import Published
from tests.tables import PARAMS, action, actions, click, lines, rows, users

KEYS = ["date", "userid", "adid"]


def test_session_job_and_its_tables(spark):
    acts = actions(spark, action("s1", 0, click_category_id=4), action("s1", 5),
                   action("s2", 9, user=2, pay_category_ids="4"), action("s3", user=3))
    people = users(spark, (1, 20, "p", "c", "m"), (2, 20, "p", "c", "m"))
    results = jobs.session_job(acts, people, PARAMS)
    assert sorted(results) == ["session_aggr_stat", "session_detail", "session_random_extract",
                               "top10_category", "top10_session"]
    root = storage.new_run_dir(spark, "results")
    for _ in range(2):
        jobs.write_results(results, root)
    stat = spark.read.parquet(f"{root}/session_aggr_stat")
    assert rows(stat, "session_count", "step_length_1_3_ratio", "visit_length_4s_6s_ratio") == [
        (2, 1.0, 0.5)] * 2
    assert spark.read.parquet(f"{root}/session_random_extract").count() == 4
    assert rows(spark.read.parquet(f"{root}/top10_category")) == [("task", 4, 1, 0, 1)]
    assert rows(spark.read.parquet(f"{root}/top10_session")) == [("task", 4, "s1", 1)]
    jobs.publish_views(results)
    assert spark.sql("select count(*) from session_detail").first()[0] == 3


def test_overwrite_append_and_catalog(spark):
    path = storage.new_run_dir(spark, "t")
    sinks.overwrite_table(spark.range(5), path)
    sinks.overwrite_table(spark.range(2), path)
    sinks.append_table(spark.range(2), path)
    assert rows(spark.read.parquet(path)) == [(0,), (0,), (1,), (1,)]
    for n in (5, 3):
        sinks.recreate_catalog_table(spark.range(n), "numbers", storage.new_run_dir(spark, "n"))
    assert spark.table("numbers").count() == 3


def test_jdbc_options():
    target = jdbc.connection("jdbc:x", "t", "u", "p")
    assert target == {"url": "jdbc:x", "dbtable": "t", "user": "u", "password": "p"}
    options = jdbc.write_options(target)
    assert options["truncate"] == "true" and options["dbtable"] == "t"


def test_jdbc_reads_in_parts():
    assert jdbc.partition_options("id", 0, 100, 4) == {
        "partitionColumn": "id", "lowerBound": "0", "upperBound": "100", "numPartitions": "4"}


def test_ingest_feeds_the_jobs(spark):
    delivered = [action("s1", time="2024-01-10 8:00:00"), action("s1", 5, page=2),
                 action("s2", time="2024-01-40 08:00:00"), action("s2", time="2024-01-11 noon")]
    names = schemas.ACTIONS_TEXT.names
    spark.createDataFrame([tuple(row[n] for n in names) for row in delivered],
                          schemas.ACTIONS_TEXT).createOrReplaceTempView("delivered")
    users(spark, (1, 20, "p", "c", "m")).createOrReplaceTempView("user_info")
    stored, root = storage.new_run_dir(spark, "actions"), storage.new_run_dir(spark, "results")
    assert tables.ingest_actions(spark.table("delivered"), f"{stored}/counted") == {
        "rows": 4, "rejected": 2}
    app.main(["ingest", "--input", "delivered", "--output", stored + "/a"])
    def staged():
        held = storage.child_dirs(spark, f"{storage.shared_dir(spark)}/clickloom")
        return [name for name in held if name.startswith("staged-")]

    before = staged()
    app.main(["session", "--params", '{startDate:"2024-01-01", endDate:"2024-01-31"}',
              "--output", root, "--actions", stored + "/a"])
    stat = spark.read.parquet(f"{root}/session_aggr_stat")
    assert rows(stat, "session_count", "visit_length_4s_6s_ratio") == [(1, 1.0)]
    assert staged() == before


def test_programs(spark):
    acts = actions(spark, action("s1", 0, click_product_id=2, city_id=1), action("s1", 5, page=2))
    acts.createOrReplaceTempView("user_visit_action")
    users(spark, (1, 20, "p", "c", "m")).createOrReplaceTempView("user_info")
    spark.createDataFrame([(2, "p2", '{"product_status": 0}')],
                          schemas.PRODUCTS).createOrReplaceTempView("product_info")
    root = storage.new_run_dir(spark, "programs")
    params = '{startDate:"2024-01-01", endDate:"2024-01-31", targetPageFlow:"1,2"}'
    for job in ("session", "page", "area"):
        app.main([job, "--params", params, "--task-id", "t", "--output", root])
    assert rows(spark.read.parquet(f"{root}/page_conver_rates")) == [("t", "1_2:1.0")]
    assert rows(spark.read.parquet(f"{root}/area_top3_product"),
                "area", "cityInfos", "productStatus") == [("华东", "1:上海", "self")]
    assert spark.read.parquet(f"{root}/session_aggr_stat").count() == 1


@pytest.fixture
def small_splits(spark):
    """Settings under which AQE takes a few kilobytes for a skewed partition."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


def _final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_session_is_split(spark, small_splits):
    path = storage.new_run_dir(spark, "hot")
    actions(spark, *[action(f"s{i % 97}" if i % 3 else "hot", i, page=i % 7)
                     for i in range(6000)]).repartition(20).write.parquet(path)
    acts = spark.read.parquet(path)
    found = sessions.filtered_actions(acts, sessions.session_facts(acts)).groupBy("page_id").count()
    assert sum(row["count"] for row in found.collect()) == 6000
    assert "skew=true" in _final_plan(found)


def test_hot_session_is_split_under_the_next_aggregate(spark, small_splits):
    path = storage.new_run_dir(spark, "hot")
    actions(spark, *[action(f"s{i % 97}" if i % 3 else "hot", i, click_category_id=i)
                     for i in range(6000)]).repartition(20).write.parquet(path)
    acts = spark.read.parquet(path)
    kept = sessions.filtered_actions(acts, sessions.session_facts(acts))
    found = categories.session_category_counts(kept)
    assert found.count() == 6000
    found.collect()
    assert "skew=true" in _final_plan(found)


def test_no_session_and_no_barred_user(spark, small_splits):
    acts = actions(spark, action("s1"), action("s2"))
    none = sessions.session_facts(acts).where("step_length > 5")
    assert sessions.filtered_actions(acts, none).count() == 0
    clicks = adlog.parse_ad_log(lines(spark, click(1)))
    assert ads.ad_clicks_admitted(clicks, 5).count() == 1
    assert ads.drop_blacklisted(clicks, clicks.where("userid < 0")).count() == 1


def test_hot_user_is_split(spark, small_splits):
    path = storage.new_run_dir(spark, "hot")
    lines(spark, *[click(1 + i % 2, user=i % 97 if i % 3 else 7, second=i)
                   for i in range(6000)]).repartition(20).write.text(path)
    clicks = adlog.parse_ad_log(spark.read.text(path))
    found = ads.ad_clicks_admitted(clicks, 100).groupBy("date").count()
    counts = {str(row["date"]): row["count"] for row in found.collect()}
    plan = _final_plan(found)
    assert "skew=true" in plan
    # User 7 is barred after the first day.
    first_day = clicks.where("date = '2024-01-01' or userid <> 7").count()
    assert sum(counts.values()) == first_day


def _log(spark, schema=schemas.AD_USER_CLICK_COUNT):
    return BatchLog(storage.new_run_dir(spark, "log"), schema).create(spark)


def _counts(spark, *values):
    df = spark.createDataFrame(values, "day string, userid long, adid long, clickCount long")
    return df.selectExpr("cast(day as date) as date", "userid", "adid", "clickCount")


def test_new_log_is_empty(spark):
    assert rows(_log(spark).rows(spark)) == []


def test_adding_and_replacing_tables_survive_replays(spark):
    log = _log(spark)
    log.append(_counts(spark, ("2024-01-01", 1, 1, 5), ("2024-01-01", 2, 1, 1)), 0)
    for _ in range(3):
        log.append(_counts(spark, ("2024-01-01", 1, 1, 7)), 1)
    assert rows(batch_log.current_sum(log.read(spark), KEYS, "clickCount"),
                "userid", "clickCount") == [(1, 12), (2, 1)]
    assert rows(batch_log.current_last(log.read(spark), KEYS, "clickCount"),
                "userid", "clickCount") == [(1, 7), (2, 1)]


def test_compaction_keeps_the_current_rows(spark):
    log, target = _log(spark), _log(spark)
    for batch_id, n in enumerate((5, 7)):
        log.append(_counts(spark, ("2024-01-01", 1, 1, n)), batch_id)
    current = batch_log.current_last(log.read(spark), KEYS, "clickCount")
    batch_log.compact(log, current, target, 1)
    target.append(_counts(spark, ("2024-01-01", 1, 1, 9)), 2)
    assert rows(batch_log.current_last(target.read(spark), KEYS, "clickCount"),
                "clickCount") == [(9,)]


def test_insert_new_skips_known_and_repeated_keys(spark):
    log = _log(spark, schemas.AD_BLACKLIST)
    for batch_id, users_ in enumerate(([1, 1, 2], [2], [2, 3])):
        for _ in range(2):
            df = spark.createDataFrame([(u,) for u in users_], schemas.AD_BLACKLIST)
            batch_log.insert_new(df, log, ["userid"], batch_id)
    assert rows(log.read(spark)) == [(1, 0), (2, 0), (3, 2)]


def _groups(spark, *values):
    df = spark.createDataFrame(values, "d string, province string, adid long, clickCount long")
    return df.selectExpr("cast(d as date) as date", "province", "adid", "clickCount")


def _top_lists(spark):
    return Published(storage.new_run_dir(spark, "top"), schemas.AD_PROVINCE_TOP3,
                     ("date", "province")).create(spark)


def test_groups_are_replaced_whole(spark):
    table = _top_lists(spark)
    first = _groups(spark, ("2024-01-01", "0", 1, 5), ("2024-01-01", "0", 2, 4),
                    ("2024-01-01", "1", 1, 3))
    second = _groups(spark, ("2024-01-01", "0", 3, 9))
    table.replace(first, 0)
    for _ in range(2):
        table.replace(second, 1)
    assert rows(table.read(spark), "province", "adid", "clickCount") == [("0", 3, 9), ("1", 1, 3)]


def test_a_replay_changes_nothing(spark):
    table = _top_lists(spark)
    assert table.replace(_groups(spark, ("2024-01-01", "0", 1, 5)), 0)
    assert not table.replace(_groups(spark, ("2024-01-01", "0", 2, 1)), 0)
    assert rows(table.read(spark), "adid") == [(1,)]


def test_failed_rename_is_an_error(spark):
    with pytest.raises(Exception):
        storage.rename(spark, "/nowhere/a", "/nowhere/b")


def test_top_ads_ties(spark):
    counts = _groups(spark, *[("2024-01-01", "0", ad, 5) for ad in (9, 8, 7, 6)])
    assert rows(ads.ad_province_top3(counts), "adid") == [(6,), (7,), (8,)]


def test_counts_come_with_the_write(spark):
    """The same row as a pass of its own gives, without a scan of the staged sessions."""
    acts = actions(spark, *[action(f"s{k % 40}", k * 13, page=k % 5) for k in range(300)])
    facts = sessions.session_facts(acts).repartition(7)
    stored, found = storage.materialize_counted(facts, "facts", *sessions.bucket_aggregates())
    assert found.collect() == sessions.session_bucket_counts(stored).collect()
    assert found.schema == sessions.session_bucket_counts(stored).schema
    assert "FileScan" not in found._jdf.queryExecution().executedPlan().toString()
    none, found = storage.materialize_counted(facts.where("step_length < 0"), "none",
                                              *sessions.bucket_aggregates())
    assert none.count() == 0 and set(found.first()) == {0}
