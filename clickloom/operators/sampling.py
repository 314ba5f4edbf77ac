"""Stratified sample of sessions: every hour of every day gives its share of a fixed total."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions import columns as C
from clickloom.operators.sessions import session_facts, session_hour_counts
from clickloom.params import TaskParams

SAMPLE_TOTAL = 100

# A sample is broadcast only while its bound (see _sample_bound) stays below this many ids.
_MAX_BROADCAST_IDS = 100_000


def session_extract_quota(hour_counts: DataFrame, total: int = SAMPLE_TOTAL) -> DataFrame:
    """Sessions to draw per (date, hour).

    A day gets ``total / days`` (whole number), an hour its share of the day's part, rounded, and
    never more than it has. The windows run over hour counts, at most 24 rows a day.
    """
    by_day = Window.partitionBy("date")
    first_of_day = F.row_number().over(by_day.orderBy("hour")) == 1
    marked = hour_counts.select(
        "date", "hour", "session_count",
        F.sum("session_count").over(by_day).alias("day_count"),
        first_of_day.cast("int").alias("is_first"))
    everything = Window.partitionBy(F.lit(1))
    per_day = F.floor(F.lit(total) / F.sum("is_first").over(everything))
    share = F.col("session_count") / F.col("day_count") * F.col("per_day")
    return (marked
            .withColumn("per_day", per_day)
            .select("date", "hour", "session_count", "day_count", "per_day",
                    F.least("session_count", F.floor(share + 0.5)).alias("quota")))


def _draw(sessions: DataFrame, total: int, seed: str) -> DataFrame:
    """Ids of the drawn sessions, in hash order within each hour.

    No quota exceeds ``total``, so the ranking is cut at that literal first: Spark then keeps only
    ``total`` rows of an hour per map task, and an hour with a third of all sessions is no burden.
    """
    starts = sessions.select("session_id", "start_time")
    quota = session_extract_quota(session_hour_counts(starts), total)
    draw_order = F.md5(F.concat("session_id", F.lit(f"-{seed}")))
    by_hour = Window.partitionBy("date", "hour").orderBy("draw_order", "session_id")
    ranked = (starts
              .select("session_id", F.to_date("start_time").alias("date"),
                      F.hour("start_time").alias("hour"), draw_order.alias("draw_order"))
              .withColumn("place", F.row_number().over(by_hour))
              .where(F.col("place") <= total))
    return (ranked.join(quota.select("date", "hour", "quota"), ["date", "hour"])
            .where(F.col("place") <= F.col("quota"))
            .select("session_id"))


def _sample_bound(total: int) -> int:
    """Most sessions a sample can have: the days' parts, plus 1 for rounding in every hour of
    every day; more than ``total`` days draw nothing."""
    return total + 24 * total


def _small(ids: DataFrame, total: int) -> DataFrame:
    return F.broadcast(ids) if _sample_bound(total) <= _MAX_BROADCAST_IDS else ids


def session_extract(actions: DataFrame, sessions: DataFrame, params: TaskParams,
                    total: int = SAMPLE_TOTAL, seed: str = "0") -> DataFrame:
    """The sampled sessions with their keywords and clicked categories.

    Only the few drawn sessions get their lists built: a second scan of three columns, reduced by
    the broadcast ids before anything is shuffled.
    """
    drawn = _draw(sessions, total, seed)
    facts = session_facts(actions.join(_small(drawn, total), "session_id", "left_semi"))
    return facts.select(
        F.lit(params.task_id).alias("taskid"),
        F.col("session_id").alias("sessionid"),
        C.time_text(F.col("start_time")).alias("startTime"),
        C.joined(F.col("search_keywords")).alias("searchKeywords"),
        C.joined(F.col("click_category_ids")).alias("clickCategoryIds"))


def session_extract_detail(actions: DataFrame, sessions: DataFrame, params: TaskParams,
                           total: int = SAMPLE_TOTAL, seed: str = "0") -> DataFrame:
    """All actions of the sampled sessions."""
    drawn = _draw(sessions, total, seed)
    return actions.join(_small(drawn, total), "session_id", "left_semi").select(
        F.lit(params.task_id).alias("taskid"),
        F.col("user_id").alias("userid"),
        F.col("session_id").alias("sessionid"),
        F.col("page_id").alias("pageid"),
        C.time_text(F.col("action_time")).alias("actionTime"),
        F.col("search_keyword").alias("searchKeyword"),
        F.col("click_category_id").alias("clickCategoryId"),
        F.col("click_product_id").alias("clickProductId"),
        F.col("order_category_ids").alias("orderCategoryIds"),
        F.col("order_product_ids").alias("orderProductIds"),
        F.col("pay_category_ids").alias("payCategoryIds"),
        F.col("pay_product_ids").alias("payProductIds"))
