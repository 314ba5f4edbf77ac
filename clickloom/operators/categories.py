"""Popular categories, and the most active sessions within them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions import columns as C

TOP_CATEGORIES = 10
TOP_SESSIONS = 10

_CLICK, _ORDER, _PAY = "click", "order", "pay"


def click_category_counts(actions: DataFrame) -> DataFrame:
    """Clicks per category."""
    return (actions.where(F.col("click_category_id") != C.NO_CLICK)
            .groupBy(F.col("click_category_id").alias("category_id"))
            .agg(F.count(F.lit(1)).alias("click_count")))


def _listed_counts(actions: DataFrame, ids: str, count: str) -> DataFrame:
    return (actions.where(F.col(ids).isNotNull())
            .select(F.explode(C.id_list(F.col(ids))).alias("category_id"))
            .groupBy("category_id").agg(F.count(F.lit(1)).alias(count)))


def order_category_counts(actions: DataFrame) -> DataFrame:
    """Orders per category; a category named twice in one order counts twice."""
    return _listed_counts(actions, "order_category_ids", "order_count")


def pay_category_counts(actions: DataFrame) -> DataFrame:
    """Payments per category."""
    return _listed_counts(actions, "pay_category_ids", "pay_count")


def _tagged(ids: Column, kind: str) -> Column:
    tagged = F.transform(ids, lambda item: F.struct(item.alias("category_id"),
                                                    F.lit(kind).alias("kind")))
    return F.coalesce(tagged, F.array().cast("array<struct<category_id:bigint,kind:string>>"))


def category_events(actions: DataFrame) -> DataFrame:
    """One row per category touched by an action: session, category and kind of touch."""
    clicked = F.when(F.col("click_category_id") != C.NO_CLICK, F.array("click_category_id"))
    touched = F.concat(_tagged(clicked, _CLICK),
                       _tagged(C.id_list(F.col("order_category_ids")), _ORDER),
                       _tagged(C.id_list(F.col("pay_category_ids")), _PAY))
    return actions.select("session_id", F.inline(touched))


def _kind_counts() -> list[Column]:
    return [F.count_if(F.col("kind") == kind).alias(f"{kind}_count")
            for kind in (_CLICK, _ORDER, _PAY)]


def category_universe(actions: DataFrame) -> DataFrame:
    """Categories that were clicked, ordered or paid for."""
    return category_events(actions).select("category_id").distinct()


def category_counts(actions: DataFrame) -> DataFrame:
    """Clicks, orders and payments per category, in one pass and one aggregate."""
    return category_events(actions).groupBy("category_id").agg(*_kind_counts())


def session_category_counts(actions: DataFrame) -> DataFrame:
    """Clicks, orders and payments per session and category: both top lists derive from it."""
    return category_events(actions).groupBy("session_id", "category_id").agg(*_kind_counts())


def total_by_category(session_counts: DataFrame) -> DataFrame:
    """Roll the counts per session and category up to categories."""
    return session_counts.groupBy("category_id").agg(
        *[F.sum(f"{kind}_count").alias(f"{kind}_count") for kind in (_CLICK, _ORDER, _PAY)])


def top10_categories(counts: DataFrame, task_id: str, top: int = TOP_CATEGORIES) -> DataFrame:
    """The most popular categories by clicks, then orders, then payments, then smallest id."""
    best = counts.orderBy(F.desc("click_count"), F.desc("order_count"), F.desc("pay_count"),
                          "category_id").limit(top)
    return best.select(
        F.lit(task_id).alias("taskid"), F.col("category_id").alias("categoryid"),
        F.col("click_count").alias("clickCount"), F.col("order_count").alias("orderCount"),
        F.col("pay_count").alias("payCount"))


def category_session_counts(actions: DataFrame) -> DataFrame:
    """Clicks per category and session."""
    return (actions.where(F.col("click_category_id") != C.NO_CLICK)
            .groupBy(F.col("click_category_id").alias("category_id"), "session_id")
            .agg(F.count(F.lit(1)).alias("click_count")))


def top10_sessions(session_counts: DataFrame, categories: DataFrame, task_id: str,
                   top: int = TOP_SESSIONS) -> DataFrame:
    """The sessions with most clicks in each of the given top categories.

    ``categories`` is a top-k list, so its size is bounded and it may be broadcast. The rank is
    cut at a literal, so every map task sends at most ``top`` rows of a category.
    """
    wanted = categories.select(F.col("categoryid").alias("category_id"))
    by_category = (Window.partitionBy("category_id")
                   .orderBy(F.desc("click_count"), "session_id"))
    return (session_counts
            .where(F.col("click_count") > 0)
            .join(F.broadcast(wanted), "category_id", "left_semi")
            .withColumn("place", F.row_number().over(by_category))
            .where(F.col("place") <= top)
            .select(F.lit(task_id).alias("taskid"), F.col("category_id").alias("categoryid"),
                    F.col("session_id").alias("sessionid"),
                    F.col("click_count").alias("clickCount")))
