"""The input tables derived from the shared test data (TPC-H-like tables and an event table).

The same formulas, for another engine, are in ``clickloom.registry.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The columns that are read (fixed: the schemas of the given files). Naming them spares Spark a
# look into the files before every query.
_SCHEMAS = {
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, props string",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_mktsegment string",
    "part": "p_partkey long, p_name string, p_size int",
}

# 2024-01-01 00:00:00 UTC, the first day of the events.
_EPOCH = 1704067200


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    # Days and times are those of UTC, whatever the session was set to.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.schema(_SCHEMAS[table]).parquet(f"{sf_dir}/{table}.parquet")


def actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = _read(spark, sf_dir, "events").selectExpr(
        "event_id", "user_id", "event_type", "cast(get_json_object(props, '$.k') as long) as k",
        "unix_seconds(cast(ts as timestamp)) as es",
        "case user_id % 10 when 0 then 30 when 1 then 10 when 2 then 5 else 1 end * 86400 as span",
        "case user_id % 5 when 0 then 1 when 1 then 10 when 2 then 100 when 3 then 1000 "
        "else 10000 end as pace")
    placed = timed.selectExpr(
        "event_id", "user_id", "event_type", "k", f"(es - {_EPOCH}) div span as seg",
        f"timestamp_seconds({_EPOCH} + ((es - {_EPOCH}) div span) * span + (user_id % 24) * 3600"
        f" + ((es - {_EPOCH}) % span) div pace) as action_time")
    return placed.selectExpr(
        "to_date(action_time) as date", "user_id",
        "concat('s', user_id, '-', seg) as session_id",
        "(event_id * 7 + user_id) % 10 as page_id",
        "action_time",
        "case when event_type = 'signup' then concat('kw', k % 12) end as search_keyword",
        "case when event_type = 'click' then k else -1 end as click_category_id",
        "case when event_type = 'click' then (k * 7 + event_id) % 100 else -1 end"
        " as click_product_id",
        "case when event_type = 'error' then concat(k, ',', (k + event_id % 2) % 100) end"
        " as order_category_ids",
        "case when event_type = 'error' then cast(k * 3 % 100 as string) end"
        " as order_product_ids",
        "case when event_type = 'purchase' then cast(k as string) end as pay_category_ids",
        "case when event_type = 'purchase' then cast(k * 3 % 100 as string) end"
        " as pay_product_ids",
        "event_id % 11 as city_id")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "customer").selectExpr(
        "c_custkey as user_id", "concat('user', c_custkey) as username", "c_name as name",
        "cast(18 + c_custkey * 7 % 43 as int) as age", "c_mktsegment as professional",
        "concat('city', c_nationkey) as city",
        "case when c_custkey % 2 = 0 then 'male' else 'female' end as sex")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "part").selectExpr(
        "p_partkey as product_id", "concat(p_name, ' ', p_partkey) as product_name",
        """concat('{"product_status": ', p_size % 2, '}') as extend_info""")


def ad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "events").selectExpr(
        "concat_ws(' ', unix_millis(cast(ts as timestamp)), user_id % 10, user_id % 10, user_id,"
        " cast(get_json_object(props, '$.k') as long) % 4) as value")
