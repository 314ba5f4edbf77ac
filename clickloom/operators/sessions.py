"""Session summaries, session filters, and the distribution of session lengths."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions import columns as C
from clickloom.functions.partitioning import forget_partitioning
from clickloom.params import TaskParams

# Length classes as (name, first, last) in whole seconds and in actions, both ends included
# (fixed values). Length 0 is in no class.
VISIT_CLASSES = (
    ("visit_length_1s_3s", 1, 3),
    ("visit_length_4s_6s", 4, 6),
    ("visit_length_7s_9s", 7, 9),
    ("visit_length_10s_30s", 10, 30),
    ("visit_length_30s_60s", 31, 60),
    ("visit_length_1m_3m", 61, 180),
    ("visit_length_3m_10m", 181, 600),
    ("visit_length_10m_30m", 601, 1800),
    ("visit_length_30m", 1801, None),
)
STEP_CLASSES = (
    ("step_length_1_3", 1, 3),
    ("step_length_4_6", 4, 6),
    ("step_length_7_9", 7, 9),
    ("step_length_10_30", 10, 30),
    ("step_length_30_60", 31, 60),
    ("step_length_60", 61, None),
)
CLASS_NAMES = tuple(name for name, _, _ in VISIT_CLASSES + STEP_CLASSES)


def session_facts(actions: DataFrame, params: TaskParams | None = None) -> DataFrame:
    """One row per session.

    Everything is an aggregate with a map-side part, so a session that holds a large share of all
    actions arrives at its reducer as one row per map task. ``keyword_hit`` and ``category_hit``
    answer the interest filters of ``params`` inside the same aggregate; the two lists are only
    built when a result shows them, because Catalyst drops unused aggregates.
    """
    keyword = C.non_empty(F.col("search_keyword"))
    category = F.when(F.col("click_category_id") != C.NO_CLICK, F.col("click_category_id"))
    aggregates = [
        F.min("user_id").alias("user_id"),
        F.min("action_time").alias("start_time"),
        F.max("action_time").alias("end_time"),
        F.count(F.lit(1)).alias("step_length"),
        F.array_sort(F.collect_set(keyword)).alias("search_keywords"),
        F.array_sort(F.collect_set(category)).alias("click_category_ids"),
    ]
    if params and params.keywords:
        aggregates.append(F.bool_or(keyword.isin(*params.keywords)).alias("keyword_hit"))
    if params and params.category_ids:
        aggregates.append(F.bool_or(category.isin(*params.category_ids)).alias("category_hit"))
    facts = actions.groupBy("session_id").agg(*aggregates)
    return facts.withColumn(
        "visit_length", C.seconds_between(F.col("start_time"), F.col("end_time")))


def session_summary(actions: DataFrame, users: DataFrame,
                    params: TaskParams | None = None) -> DataFrame:
    """Sessions with their user's attributes; sessions of unknown users are left out."""
    attributes = users.select("user_id", "age", "professional", "sex", "city")
    return session_facts(actions, params).join(attributes, "user_id", "inner")


def _conditions(params: TaskParams) -> list[Column]:
    conditions = []
    if params.start_age is not None and params.end_age is not None:
        conditions.append(F.col("age").between(params.start_age, params.end_age))
    # The value "-1" stands for "none" and matches nothing.
    for name, wanted in (("professional", params.professionals), ("city", params.cities)):
        if wanted:
            conditions.append(F.col(name).isin(*wanted) & (F.col(name) != "-1"))
    if params.sex:
        conditions.append(F.col("sex") == params.sex)
    if params.keywords:
        conditions.append(F.col("keyword_hit"))
    if params.category_ids:
        conditions.append(F.col("category_hit"))
    return conditions


def filtered_sessions(actions: DataFrame, users: DataFrame, params: TaskParams) -> DataFrame:
    """Sessions that pass every active filter.

    The user conditions end up on the scan of the users, below the join.
    """
    summary = session_summary(actions, users, params)
    conditions = _conditions(params)
    kept = summary.where(reduce(Column.__and__, conditions)) if conditions else summary
    return kept.drop("keyword_hit", "category_hit")


def filtered_actions(actions: DataFrame, sessions: DataFrame) -> DataFrame:
    """Actions of the given sessions.

    A semi join, so no column of the sessions travels along; where one session holds a large share
    of the actions, AQE splits its partition on the actions' side.
    """
    kept = forget_partitioning(sessions.select("session_id"))
    return actions.join(kept, "session_id", "left_semi")


def _class_count(length: str, name: str, first: int, last: int | None) -> Column:
    upper = "" if last is None else f" and {length} <= {last}"
    return F.expr(f"count_if({length} >= {first}{upper}) as {name}")


def bucket_aggregates() -> list[Column]:
    """The number of sessions, in all and in every length class."""
    counts = [_class_count("visit_length", *visit) for visit in VISIT_CLASSES]
    counts += [_class_count("step_length", *step) for step in STEP_CLASSES]
    return [F.count(F.lit(1)).alias("session_count"), *counts]


def session_bucket_counts(sessions: DataFrame) -> DataFrame:
    """One row: the number of sessions, in all and in every length class."""
    return sessions.agg(*bucket_aggregates())


def session_ratio(bucket_counts: DataFrame, task_id: str) -> DataFrame:
    """The share of every length class, rounded half up to two places; all 0.0 where no session
    is left."""
    shares = [F.expr(f"coalesce(round(try_divide({name}, session_count), 2), 0d) as {name}_ratio")
              for name in CLASS_NAMES]
    return bucket_counts.select(F.lit(task_id).alias("taskid"), "session_count", *shares)


def session_hour_counts(sessions: DataFrame) -> DataFrame:
    """Sessions per day and hour of their start."""
    return (sessions
            .groupBy(F.to_date("start_time").alias("date"), F.hour("start_time").alias("hour"))
            .agg(F.count(F.lit(1)).alias("session_count")))
