"""Every operator as a named query over the test data: ``(spark, sf_dir) -> DataFrame``.

Days and times leave as text, as in the result tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom import schemas, sinks
from clickloom.functions import columns as C
from clickloom.functions.sql import register_sql_functions
from clickloom.operators import ads, areas, categories, funnel, sampling, sessions
from clickloom.params import TaskParams
from clickloom.plans import jobs
from clickloom.registry.replay import ad_stream
from clickloom.sources import adlog, storage, tables, testdata
from clickloom.streaming import batch_log, clicks as streams
from clickloom.streaming.batch_log import BatchLog
from clickloom.streaming.published import Published

Query = Callable[[SparkSession, str], DataFrame]

PARAMS = TaskParams.of(
    "2024-01-03", "2024-01-28", start_age=20, end_age=50, sex="male",
    professionals="BUILDING,MACHINERY", page_flow="1,2,3,4,5,6,7", task_id="task-1")
# The same sessions, if they also searched and clicked for certain things.
INTERESTS = TaskParams.of(
    "2024-01-03", "2024-01-28", start_age=20, end_age=50, sex="male",
    professionals="BUILDING,MACHINERY", keywords="kw1,kw3,kw7",
    category_ids="1,3,5,7,11,20,21,22,23,24,25,26,27,28,29,50,51,52,53,54,55,56,57,58,59",
    task_id="task-2")
# With the reference threshold of 100 clicks nobody in the test data would be barred.
THRESHOLD = 4
# Where the sink queries cut their input in two.
NOON = 12
CUT = "2024-01-15"

_QUERIES: dict[str, Query] = {}


def _query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.actions_in_range(testdata.actions(spark, sf_dir), PARAMS)


def _kept_sessions(spark: SparkSession, sf_dir: str,
                   params: TaskParams = PARAMS) -> DataFrame:
    return sessions.filtered_sessions(_actions(spark, sf_dir), testdata.users(spark, sf_dir),
                                      params)


def _kept_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.filtered_actions(_actions(spark, sf_dir), _kept_sessions(spark, sf_dir))


def _action_text(actions: DataFrame) -> DataFrame:
    return (actions.withColumn("date", C.date_text(F.col("date")))
            .withColumn("action_time", C.time_text(F.col("action_time"))))


def _session_text(summary: DataFrame) -> DataFrame:
    return summary.select(
        "session_id", "user_id", C.time_text(F.col("start_time")).alias("start_time"),
        C.time_text(F.col("end_time")).alias("end_time"), "visit_length", "step_length",
        C.joined(F.col("search_keywords")).alias("search_keywords"),
        C.joined(F.col("click_category_ids")).alias("click_category_ids"),
        "age", "professional", "sex", "city")


def _date_text(df: DataFrame) -> DataFrame:
    return df.withColumn("date", C.date_text(F.col("date")))


# Scans.

@_query
def actions_in_range(spark, sf_dir):
    return _action_text(_actions(spark, sf_dir))


@_query
def product_clicks_in_range(spark, sf_dir):
    return tables.product_clicks_in_range(testdata.actions(spark, sf_dir), PARAMS)


@_query
def ingest_deliveries(spark, sf_dir):
    """Two deliveries of actions with text times, each run twice, stored by day and read back."""
    path = storage.new_run_dir(spark, "ingest")
    delivered = _action_text(testdata.actions(spark, sf_dir))
    for name, part in (("early", F.col("date") < CUT), ("late", F.col("date") >= CUT)):
        for _ in range(2):  # the second run changes nothing
            tables.ingest_actions(delivered.where(part), path, name)
    return _action_text(tables.read_actions(spark, path))


@_query
def day_and_minute_keys(spark, sf_dir):
    """Days and minutes as keys of actions, and the day that a key stands for."""
    keyed = testdata.actions(spark, sf_dir).select(
        C.date_key(F.col("date")).alias("day_key"),
        C.minute_key(F.col("action_time")).alias("minute_key"))
    return (keyed.groupBy("day_key", "minute_key").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("date", C.date_text(C.parse_date_key(F.col("day_key")))))


@_query
def sql_functions(spark, sf_dir):
    """The SQL functions, in SQL text over views of the tables."""
    jobs.publish_views({"product_info": testdata.products(spark, sf_dir),
                        "city_info": tables.city_dimension(spark)})
    register_sql_functions(spark)
    return spark.sql("""
        select product_id, concat_long_string(c.city_id, city_name, ':') as city,
               get_json_field(extend_info, 'product_status') as status
        from product_info p join city_info c on c.city_id = p.product_id % 10""")


# Sessions.

@_query
def sessions_of_json_task(spark, sf_dir):
    """The sessions that a task's parameters choose, given as lenient JSON."""
    params = TaskParams.from_json(spark, """{startDate: "2024-01-03", endDate: "2024-01-28",
        startAge: 20, endAge: 50, sex: "male", professionals: "BUILDING,MACHINERY", cities: "",
        keywords: "", categoryIds: ""}""")
    return _session_text(_kept_sessions(spark, sf_dir, params))


@_query
def session_summary(spark, sf_dir):
    return _session_text(sessions.session_summary(_actions(spark, sf_dir),
                                                  testdata.users(spark, sf_dir)))


@_query
def filtered_sessions(spark, sf_dir):
    return _session_text(_kept_sessions(spark, sf_dir))


@_query
def filtered_sessions_by_interest(spark, sf_dir):
    return _session_text(_kept_sessions(spark, sf_dir, INTERESTS))


@_query
def filtered_actions(spark, sf_dir):
    return _action_text(_kept_actions(spark, sf_dir))


@_query
def session_bucket_counts(spark, sf_dir):
    return sessions.session_bucket_counts(_kept_sessions(spark, sf_dir))


def _ratio(spark: SparkSession, sf_dir: str, params: TaskParams) -> DataFrame:
    counts = sessions.session_bucket_counts(_kept_sessions(spark, sf_dir, params))
    return sessions.session_ratio(counts, params.task_id)


@_query
def session_ratio(spark, sf_dir):
    return _ratio(spark, sf_dir, PARAMS)


@_query
def session_hour_counts(spark, sf_dir):
    return _date_text(sessions.session_hour_counts(_kept_sessions(spark, sf_dir)))


@_query
def session_extract_quota(spark, sf_dir):
    hours = sessions.session_hour_counts(_kept_sessions(spark, sf_dir))
    return _date_text(sampling.session_extract_quota(hours))


@_query
def session_extract(spark, sf_dir):
    return sampling.session_extract(_actions(spark, sf_dir), _kept_sessions(spark, sf_dir),
                                    PARAMS)


@_query
def session_extract_detail(spark, sf_dir):
    return sampling.session_extract_detail(_actions(spark, sf_dir),
                                           _kept_sessions(spark, sf_dir), PARAMS)


# Categories.

@_query
def click_category_counts(spark, sf_dir):
    return categories.click_category_counts(_kept_actions(spark, sf_dir))


@_query
def order_category_counts(spark, sf_dir):
    return categories.order_category_counts(_kept_actions(spark, sf_dir))


@_query
def pay_category_counts(spark, sf_dir):
    return categories.pay_category_counts(_kept_actions(spark, sf_dir))


@_query
def category_universe(spark, sf_dir):
    return categories.category_universe(_kept_actions(spark, sf_dir))


@_query
def category_counts(spark, sf_dir):
    return categories.category_counts(_kept_actions(spark, sf_dir))


@_query
def top10_categories(spark, sf_dir):
    return categories.top10_categories(categories.category_counts(_kept_actions(spark, sf_dir)),
                                       PARAMS.task_id)


@_query
def category_session_counts(spark, sf_dir):
    return categories.category_session_counts(_kept_actions(spark, sf_dir))


@_query
def top10_sessions(spark, sf_dir):
    return jobs.top_lists(_kept_actions(spark, sf_dir), PARAMS)["top10_session"]


# Page flow.

@_query
def page_pairs(spark, sf_dir):
    pairs = funnel.page_pairs(funnel.page_runs(_actions(spark, sf_dir)))
    return pairs.withColumn("action_time", C.time_text(F.col("action_time")))


@_query
def page_pair_counts(spark, sf_dir):
    return funnel.page_pair_counts(funnel.page_runs(_actions(spark, sf_dir)), PARAMS)


@_query
def start_page_count(spark, sf_dir):
    return funnel.start_page_count(_actions(spark, sf_dir), PARAMS)


@_query
def page_conversion(spark, sf_dir):
    return funnel.page_conversion(_actions(spark, sf_dir), PARAMS)


@_query
def page_conversion_report(spark, sf_dir):
    return funnel.conversion_report(page_conversion(spark, sf_dir), PARAMS.task_id)


# Areas.

def _clicks_and_cities(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return product_clicks_in_range(spark, sf_dir), tables.city_dimension(spark)


@_query
def area_clicks(spark, sf_dir):
    return areas.area_clicks(*_clicks_and_cities(spark, sf_dir))


@_query
def area_product_counts(spark, sf_dir):
    return areas.area_product_counts(*_clicks_and_cities(spark, sf_dir))


@_query
def area_product_info(spark, sf_dir):
    return areas.area_product_info(area_product_counts(spark, sf_dir),
                                   testdata.products(spark, sf_dir))


@_query
def area_top3_products(spark, sf_dir):
    return jobs.area_job(testdata.actions(spark, sf_dir), testdata.products(spark, sf_dir),
                         tables.city_dimension(spark), PARAMS)["area_top3_product"]


# Ad clicks, as batches.

def _clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adlog.parse_ad_log(testdata.ad_lines(spark, sf_dir))


def _admitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads.ad_clicks_admitted(_clicks(spark, sf_dir), THRESHOLD)


def _click_text(clicks: DataFrame) -> DataFrame:
    return _date_text(clicks).withColumn(
        "click_time", F.date_format("click_time", "yyyy-MM-dd HH:mm:ss.SSS"))


def _window_text(df: DataFrame) -> DataFrame:
    return (df.withColumn("window_start", C.time_text(F.col("window_start")))
            .withColumn("window_end", C.time_text(F.col("window_end"))))


@_query
def ad_log_parsed(spark, sf_dir):
    return _click_text(_clicks(spark, sf_dir))


@_query
def ad_clicks_admitted(spark, sf_dir):
    return _click_text(_admitted(spark, sf_dir))


@_query
def ad_user_daily_clicks(spark, sf_dir):
    return _date_text(ads.ad_user_daily_clicks(_admitted(spark, sf_dir)))


def _is_morning():
    return F.hour("click_time") < NOON


@_query
def ad_running_totals(spark, sf_dir):
    clicks = _clicks(spark, sf_dir)
    stored = ads.ad_user_daily_clicks(clicks.where(_is_morning()))
    counts = ads.ad_user_daily_clicks(clicks.where(~_is_morning()))
    return _date_text(ads.add_stored(counts, stored))


@_query
def ad_blacklist(spark, sf_dir):
    return ads.ad_blacklist(_clicks(spark, sf_dir), THRESHOLD)


@_query
def ad_region_counts(spark, sf_dir):
    return _date_text(ads.ad_region_counts(_admitted(spark, sf_dir)))


@_query
def ad_province_counts(spark, sf_dir):
    return _date_text(ads.ad_province_counts(ads.ad_region_counts(_admitted(spark, sf_dir))))


@_query
def ad_province_top3(spark, sf_dir):
    counts = ads.ad_province_counts(ads.ad_region_counts(_admitted(spark, sf_dir)))
    return _date_text(ads.ad_province_top3(counts))


@_query
def ad_click_trend(spark, sf_dir):
    return _date_text(ads.ad_click_trend(ads.minute_counts(_admitted(spark, sf_dir))))


@_query
def ad_recent_hour(spark, sf_dir):
    return _window_text(ads.ad_recent_hour(ads.minute_counts(_admitted(spark, sf_dir))))


# Sinks: each writes to a new folder and returns the table read back.

@_query
def sink_overwrite(spark, sf_dir):
    path = storage.new_run_dir(spark, "sink-overwrite")
    sinks.overwrite_table(_date_text(session_hour_counts(spark, sf_dir)), path)
    sinks.overwrite_table(category_counts(spark, sf_dir), path)
    return spark.read.parquet(path)


@_query
def sink_append(spark, sf_dir):
    path = storage.new_run_dir(spark, "sink-append")
    for params in (PARAMS, INTERESTS):
        sinks.append_table(_ratio(spark, sf_dir, params), path)
    return spark.read.parquet(path)


@_query
def sink_upsert_add(spark, sf_dir):
    clicks = _clicks(spark, sf_dir)
    log = batch_log.adding(storage.new_run_dir(spark, "sink-upsert-add"),
                           schemas.AD_USER_CLICK_COUNT, ["date", "userid", "adid"], "clickCount")
    log.append(ads.ad_user_daily_clicks(clicks.where(_is_morning())), 0)
    for _ in range(2):  # the second time is a replay
        log.append(ads.ad_user_daily_clicks(clicks.where(~_is_morning())), 1)
    return _date_text(batch_log.current_sum(log.read(spark), ["date", "userid", "adid"],
                                            "clickCount"))


@_query
def sink_levelled_totals(spark, sf_dir):
    """Running totals from a batch for each seventh of the users, in runs that are merged two by two."""
    clicks = _clicks(spark, sf_dir)
    keys = ["date", "userid", "adid"]
    log = batch_log.adding(storage.new_run_dir(spark, "sink-levels"), schemas.AD_USER_CLICK_COUNT,
                           keys, "clickCount", ("date",), fan=2)
    for batch_id in range(7):
        part = clicks.where(F.pmod("userid", F.lit(7)) == batch_id)
        log.append(ads.ad_user_daily_clicks(part), batch_id)
    return _date_text(batch_log.current_sum(log.read(spark), keys, "clickCount"))


@_query
def sink_upsert_set(spark, sf_dir):
    clicks = _clicks(spark, sf_dir)
    keys = ["date", "province", "city", "adid"]
    log = batch_log.replacing(storage.new_run_dir(spark, "sink-upsert-set"), schemas.AD_STAT, keys,
                              "clickCount")
    changed = clicks.where(~_is_morning()).select(keys).distinct()
    totals = ads.ad_region_counts(clicks).join(changed, keys, "left_semi")
    log.append(ads.ad_region_counts(clicks.where(_is_morning())), 0)
    for _ in range(2):
        log.append(totals, 1)
    return _date_text(batch_log.current_last(log.read(spark), keys, "clickCount"))


@_query
def sink_replace_groups(spark, sf_dir):
    clicks = _clicks(spark, sf_dir)
    table = Published(storage.new_run_dir(spark, "sink-replace"), schemas.AD_PROVINCE_TOP3,
                      ("date", "province"))

    def top3(part):
        return ads.ad_province_top3(ads.ad_province_counts(ads.ad_region_counts(part)))

    late = (ads.ad_clicks_admitted(clicks, THRESHOLD)
            .where(F.col("date") >= F.lit(CUT).cast("date")))
    for batch_id, part in enumerate((clicks, late)):
        table.replace(top3(part), batch_id)
    return _date_text(table.read(spark))


@_query
def sink_insert_new(spark, sf_dir):
    clicks = _clicks(spark, sf_dir)
    log = BatchLog(storage.new_run_dir(spark, "sink-insert-new"), schemas.AD_BLACKLIST)
    early = clicks.where(F.col("date") < F.lit(CUT).cast("date"))
    for batch_id, part in enumerate((early, clicks)):
        batch_log.insert_new(ads.ad_blacklist(part, THRESHOLD), log, ["userid"], batch_id)
    return log.rows(spark)


@_query
def table_overwrite(spark, sf_dir):
    path = storage.new_run_dir(spark, "table-overwrite")
    name = "clickloom_" + path.rsplit("-", 1)[1]
    for _ in range(2):
        sinks.recreate_catalog_table(testdata.products(spark, sf_dir), name, path)
    return spark.table(name)


# Ad clicks, as streams: the log is replayed in day order, the result tables are read back.

@_query
def stream_ad_clicks_admitted(spark, sf_dir):
    return _click_text(ad_stream(spark, sf_dir, THRESHOLD).admitted.rows(spark))


@_query
def stream_ad_blacklist(spark, sf_dir):
    return ad_stream(spark, sf_dir, THRESHOLD).blacklist.rows(spark)


@_query
def stream_ad_user_daily_clicks(spark, sf_dir):
    return _date_text(streams.user_clicks(spark, ad_stream(spark, sf_dir, THRESHOLD)))


@_query
def stream_ad_region_counts(spark, sf_dir):
    return _date_text(streams.region_counts(
        spark, ad_stream(spark, sf_dir, THRESHOLD, streams.start_region_counts)))


@_query
def stream_ad_province_top3(spark, sf_dir):
    return _date_text(streams.province_top3(
        spark, ad_stream(spark, sf_dir, THRESHOLD, streams.start_province_top3)))


@_query
def stream_ad_click_trend(spark, sf_dir):
    return _date_text(streams.click_trend(
        spark, ad_stream(spark, sf_dir, THRESHOLD, streams.start_click_trend)))


@_query
def stream_ad_recent_hour(spark, sf_dir):
    return _window_text(streams.recent_hour(
        spark, ad_stream(spark, sf_dir, THRESHOLD, streams.start_click_trend)))
