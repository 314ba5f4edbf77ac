import datetime as dt

import pytest
from pyspark.sql import functions as F

from clickloom import TaskParams, schemas
from clickloom.functions import columns as C
from clickloom.functions.sql import register_sql_functions
from clickloom.sources import adlog, storage, tables
from clickloom.sources.commit_log import CommitLog
from tests.tables import PARAMS, action, actions, lines, rows

LENIENT = """{startDate:"2020-06-01", endDate:"2020-06-30", startAge: 20, endAge: 50,
 professionals: "",  cities: "", sex:"", keywords:"", categoryIds:"",
 targetPageFlow:"1,2,3,4,5,6,7"}"""


def test_lenient_json_and_empty_text(spark):
    params = TaskParams.from_json(spark, LENIENT, "t")
    assert params == TaskParams(
        dt.date(2020, 6, 1), dt.date(2020, 6, 30), 20, 50,
        page_flow=(1, 2, 3, 4, 5, 6, 7), task_id="t")


def test_json_without_optional_fields(spark):
    params = TaskParams.from_json(spark, '{startDate:"2020-06-01", endDate:"2020-06-02"}')
    assert params.start_age is None and params.keywords == () and params.page_flow == ()
    with pytest.raises(ValueError):
        TaskParams.from_json(spark, "{}")


def test_unpadded_hour(spark):
    found = actions(spark, action(time="2020-06-24 5:03:04")).first()
    assert found["action_time"] == dt.datetime(2020, 6, 24, 5, 3, 4)
    assert found["date"] == dt.date(2020, 6, 24)


def test_date_range_includes_both_ends(spark):
    days = ["2023-12-31", "2024-01-01", "2024-01-31", "2024-02-01"]
    found = tables.actions_in_range(
        actions(spark, *[action(session=d, time=f"{d} 10:00:00") for d in days]), PARAMS)
    assert rows(found, "session_id") == [("2024-01-01",), ("2024-01-31",)]


def test_date_range_prunes_partitions(spark):
    path = storage.new_run_dir(spark, "actions")
    stored = actions(spark, *[action(time=f"2024-01-{d:02d} 10:00:00") for d in range(1, 29)])
    tables.write_actions(stored, path)
    params = TaskParams.of("2024-01-05", "2024-01-06")
    found = tables.product_clicks_in_range(tables.read_actions(spark, path), params)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert "PushedFilters: [IsNotNull(click_product_id), Not(EqualTo(click_product_id,-1))]" in plan
    assert "ReadSchema: struct<click_product_id:bigint,city_id:bigint>" in plan
    assert tables.actions_in_range(tables.read_actions(spark, path), params).count() == 2


def test_product_clicks(spark):
    found = tables.product_clicks_in_range(
        actions(spark, action(click_product_id=7, city_id=3), action()), PARAMS)
    assert rows(found) == [(3, 7)]


def test_catalog_tables(spark):
    spark.createDataFrame([(1, "p", "{}")], schemas.PRODUCTS).createOrReplaceTempView("pi")
    assert tables.product_table(spark, "pi").count() == 1
    assert tables.city_dimension(spark).count() == 10
    assert tables.city_dimension(spark).schema.names == schemas.CITIES.names


def test_id_list(spark):
    df = spark.createDataFrame([("1,2,",), ("",), ("5,5",), ("x,3",), (None,)], "ids string")
    assert [row[0] for row in df.select(C.id_list(F.col("ids"))).collect()] == [
        [1, 2], [], [5, 5], [3], None]


def test_status_and_level(spark):
    info = ['{"product_status": 0}', '{"product_status": 1}', '{"product_status": "0"}', "{}",
            None]
    df = spark.createDataFrame([(i,) for i in info], "info string")
    assert [row[0] for row in df.select(C.product_status(F.col("info"))).collect()] == [
        "self", "others", "self", "others", "others"]
    df = spark.createDataFrame([(a,) for a in ["华北", "华中", "西北", "东北", None]], "a string")
    assert [row[0] for row in df.select(C.area_level(F.col("a"))).collect()] == [
        "A Level", "B Level", "C Level", "D Level", "D Level"]


def test_time_keys(spark):
    row = spark.range(1).select(
        F.lit(dt.datetime(2024, 1, 2, 3, 4, 5)).alias("ts")).select(
        C.date_key(F.col("ts")), C.minute_key(F.col("ts")), C.time_text(F.col("ts")),
        C.parse_date_key(F.lit("20240102"))).first()
    assert tuple(row) == ("20240102", "202401020304", "2024-01-02 03:04:05",
                          dt.date(2024, 1, 2))


def test_sql_functions(spark):
    register_sql_functions(spark)
    row = spark.sql("""
        select concat_long_string(1, 'X', ':') as a,
               get_json_field('{"product_status": 0}', 'product_status') as b,
               (select listagg(distinct x, ',') within group (order by x)
                from values ('1:X'), ('11:X'), ('1:X') as t(x)) as c""").first()
    assert tuple(row) == ("1:X", "0", "11:X,1:X")


def test_ad_log(spark):
    log = lines(spark, "1593351577272 0 0 90 2", "abc", "1 2", "", "1 0 0 x 2", "1593351577272")
    assert rows(adlog.parse_ad_log(log)) == [
        (dt.datetime(2020, 6, 28, 13, 39, 37, 272000), dt.date(2020, 6, 28), "0", "0", 90, 2)]
    assert rows(adlog.rejected_lines(log)) == [("",), ("1 0 0 x 2",), ("1 2",),
                                               ("1593351577272",), ("abc",)]


def test_kafka_options():
    assert adlog.kafka_options("a:9092", "t") == {
        "kafka.bootstrap.servers": "a:9092", "subscribe": "t", "startingOffsets": "latest"}


def test_shared_dir_is_the_configured_one(spark):
    assert storage.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def delivered(spark, *sessions, day="2024-01-10"):
    data = [tuple(action(session=s, time=f"{day} 08:00:00")[name] for name in
                  schemas.ACTIONS_TEXT.names) for s in sessions]
    return spark.createDataFrame(data, schemas.ACTIONS_TEXT)


def sessions_of(df):
    return sorted(r["session_id"] for r in df.collect())


def test_a_delivery_counts_once(spark):
    path = storage.new_run_dir(spark, "actions")
    for _ in range(2):  # the second run is that of a scheduler that retries
        seen = tables.ingest_actions(delivered(spark, "a", "b"), path, "monday")
        assert seen == {"rows": 2, "rejected": 0}
    tables.ingest_actions(delivered(spark, "c", day="2024-01-11"), path, "tuesday")
    for _ in range(2):  # without an id each is a delivery
        tables.ingest_actions(delivered(spark, "d"), path)
    assert sessions_of(tables.read_actions(spark, path)) == ["a", "b", "c", "d", "d"]
    params = TaskParams.of("2024-01-11", "2024-01-11")
    found = tables.actions_in_range(tables.read_actions(spark, path), params)
    assert sessions_of(found) == ["c"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "2024-01-11" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    # What was stored before there was a log is read along.
    tables.write_actions(tables.actions_from_text(delivered(spark, "old")), path)
    assert sessions_of(tables.read_actions(spark, path)) == ["a", "b", "c", "d", "d", "old"]


def test_a_failed_delivery_is_not_seen(spark, monkeypatch):
    path = storage.new_run_dir(spark, "actions")
    tables.ingest_actions(delivered(spark, "a"), path, "monday")
    with monkeypatch.context() as patch:
        patch.setattr(CommitLog, "commit", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            tables.ingest_actions(delivered(spark, "b"), path, "tuesday")
    assert sessions_of(tables.read_actions(spark, path)) == ["a"]
    tables.ingest_actions(delivered(spark, "b"), path, "tuesday")
    assert sessions_of(tables.read_actions(spark, path)) == ["a", "b"]


def test_deliveries_at_one_time(spark, monkeypatch):
    """Another run commits between the write and the commit, once of another and once of the same."""
    path = storage.new_run_dir(spark, "actions")
    write = tables.write_actions

    def overtaken(by):
        def run(actions, folder, mode="append"):
            write(actions, folder, mode)
            monkeypatch.setattr(tables, "write_actions", write)
            tables.ingest_actions(delivered(spark, by), path, by)
        return run

    monkeypatch.setattr(tables, "write_actions", overtaken("x"))
    tables.ingest_actions(delivered(spark, "a"), path, "a")
    assert sessions_of(tables.read_actions(spark, path)) == ["a", "x"]
    monkeypatch.setattr(tables, "write_actions", overtaken("b"))
    tables.ingest_actions(delivered(spark, "b"), path, "b")
    assert sessions_of(tables.read_actions(spark, path)) == ["a", "b", "x"]


def test_no_clock_decides_which_lines_are_clicks(spark):
    late = lines(spark, "4102444799999 0 0 1 2", "4102444800000 0 0 1 2", "1704067200000 0 0 1 2")
    assert adlog.parse_ad_log(late).count() == 2
    assert adlog.rejected_lines(late).count() == 1
    assert adlog.parse_ad_log(late, before_millis=1704067200001).count() == 1
