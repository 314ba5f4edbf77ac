"""Batch sources: user actions, users, products and cities."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.functions import columns as C
from clickloom.params import TaskParams
from clickloom.sources import storage
from clickloom.sources.commit_log import CommitLog, Conflict

ACTION_TABLE = "user_visit_action"
USER_TABLE = "user_info"
PRODUCT_TABLE = "product_info"

# City dimension: id, name, area (fixed values).
CITIES = (
    (0, "北京", "华北"),
    (1, "上海", "华东"),
    (2, "南京", "华东"),
    (3, "广州", "华南"),
    (4, "三亚", "华南"),
    (5, "武汉", "华中"),
    (6, "长沙", "华中"),
    (7, "西安", "西北"),
    (8, "成都", "西南"),
    (9, "哈尔滨", "东北"),
)


def actions_from_text(raw: DataFrame) -> DataFrame:
    """Actions as delivered (text times) turned into the stored form."""
    return raw.select(
        F.col("date").try_cast("date").alias("date"), "user_id", "session_id", "page_id",
        C.parse_time(F.col("action_time")).alias("action_time"), "search_keyword",
        "click_category_id", "click_product_id", "order_category_ids", "order_product_ids",
        "pay_category_ids", "pay_product_ids", "city_id")


def write_actions(actions: DataFrame, path: str, mode: str = "append") -> None:
    """Store actions partitioned by day, so that a date range prunes whole folders.

    The rows of one day are spread over as many files as they need: AQE's rebalance splits the
    large days and merges the small ones.
    """
    actions.hint("rebalance", "date").write.mode(mode).partitionBy("date").parquet(path)


def ingest_actions(raw: DataFrame, path: str, delivery: str | None = None) -> dict[str, int]:
    """Add a delivery of actions to a stored table, once.

    Returns how many ``rows`` came and how many were ``rejected``, because their day or time is
    missing or cannot be read. The rows are written into a folder of their own, which counts as
    soon as the table's log names it for the ``delivery``: of a failed run nothing is seen, and a
    second run of a delivery changes nothing. Without an id each call is a delivery of its own.
    """
    spark = raw.sparkSession
    log, delivery = _deliveries(path), delivery or uuid.uuid4().hex
    version, state = log.latest(spark)
    if delivery in state:
        return state[delivery]["seen"]
    seen = Observation()
    bad = F.col("date").isNull() | F.col("action_time").isNull()
    typed = actions_from_text(raw).observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("rejected"))
    folder = f"delivery={uuid.uuid4().hex}"
    write_actions(typed.where(~bad), f"{path}/{folder}")
    while True:
        try:
            log.commit(spark, version + 1,
                       {**state, delivery: {"folder": folder, "seen": seen.get}})
            return seen.get
        except Conflict:  # another delivery came first, or the same one by another run
            version, state = log.latest(spark)
            if delivery in state:
                storage.remove(spark, f"{path}/{folder}")
                return state[delivery]["seen"]


def _deliveries(path: str) -> CommitLog:
    return CommitLog(f"{path}/_commits")


def read_actions(spark: SparkSession, path: str) -> DataFrame:
    """Stored actions: the deliveries that are in the log, and what :func:`write_actions` stored."""
    if not storage.exists(spark, _deliveries(path).path):
        return spark.read.schema(schemas.ACTIONS).parquet(path)
    _, state = _deliveries(path).latest(spark)
    folders = [f"{path}/{d['folder']}" for d in state.values()]
    delivered = (spark.read.schema(schemas.ACTIONS).option("basePath", path).parquet(*folders)
                 .select(schemas.ACTIONS.names))
    stored = [f"{path}/{d}" for d in storage.child_dirs(spark, path) if d.startswith("date=")]
    if not stored:
        return delivered
    return delivered.union(spark.read.schema(schemas.ACTIONS).option("basePath", path)
                           .parquet(*stored).select(schemas.ACTIONS.names))


def actions_in_range(actions: DataFrame, params: TaskParams) -> DataFrame:
    """Actions of the parameters' inclusive date range."""
    return actions.where(
        F.col("date").between(F.lit(params.start_date), F.lit(params.end_date)))


def product_clicks_in_range(actions: DataFrame, params: TaskParams) -> DataFrame:
    """City and product of every product click in the date range."""
    return (actions_in_range(actions, params)
            .where(F.col("click_product_id") != C.NO_CLICK)
            .select("city_id", "click_product_id"))


def action_table(spark: SparkSession, name: str = ACTION_TABLE) -> DataFrame:
    """A catalog table, or the folder that :func:`ingest_actions` fills."""
    return read_actions(spark, name) if "/" in name else spark.table(name)


def user_table(spark: SparkSession, name: str = USER_TABLE) -> DataFrame:
    return spark.table(name)


def product_table(spark: SparkSession, name: str = PRODUCT_TABLE) -> DataFrame:
    return spark.table(name)


def city_dimension(spark: SparkSession) -> DataFrame:
    """The built-in cities, as an inline table: its size is known, so joins broadcast it."""
    values = ", ".join(f"({city}L, '{name}', '{area}')" for city, name, area in CITIES)
    return spark.sql(f"select * from values {values} as cities(city_id, city_name, area)")
