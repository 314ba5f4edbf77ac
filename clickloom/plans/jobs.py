"""The batch jobs: from input tables and parameters to result tables.

Each returns its result tables by name, as DataFrames; :func:`write_results` stores them. What
several results share is written to the shared folder once (:func:`storage.materialize`), and
only what is small next to the actions: one narrow row per session, and the counts per session and
category.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from clickloom import sinks
from clickloom.operators import areas, categories, funnel, sampling, sessions
from clickloom.params import TaskParams
from clickloom.sources import storage, tables


def session_job(actions: DataFrame, users: DataFrame, params: TaskParams,
                seed: str = "0") -> dict[str, DataFrame]:
    """Session statistics, session sample, top categories and their top sessions."""
    in_range = tables.actions_in_range(actions, params)
    kept, bucket_counts = storage.materialize_counted(
        sessions.filtered_sessions(in_range, users, params)
        .select("session_id", "start_time", "visit_length", "step_length"), "sessions",
        *sessions.bucket_aggregates())
    return {
        "session_aggr_stat": sessions.session_ratio(bucket_counts, params.task_id),
        "session_random_extract": sampling.session_extract(in_range, kept, params, seed=seed),
        "session_detail": sampling.session_extract_detail(in_range, kept, params, seed=seed),
        **top_lists(sessions.filtered_actions(in_range, kept), params),
    }


def top_lists(actions: DataFrame, params: TaskParams) -> dict[str, DataFrame]:
    """Top categories and top sessions, both from one pass over the actions."""
    counts = storage.materialize(categories.session_category_counts(actions), "session_category")
    top = categories.top10_categories(categories.total_by_category(counts), params.task_id)
    return {
        "top10_category": top,
        "top10_session": categories.top10_sessions(counts, top, params.task_id),
    }


def page_job(actions: DataFrame, params: TaskParams) -> dict[str, DataFrame]:
    """Conversion along the page flow."""
    conversion = funnel.page_conversion(tables.actions_in_range(actions, params), params)
    return {"page_conver_rates": funnel.conversion_report(conversion, params.task_id)}


def area_job(actions: DataFrame, products: DataFrame, cities: DataFrame,
             params: TaskParams) -> dict[str, DataFrame]:
    """Top products of every area."""
    clicks = tables.product_clicks_in_range(actions, params)
    info = areas.area_product_info(areas.area_product_counts(clicks, cities), products)
    return {"area_top3_product": areas.area_top3_products(info, params.task_id)}


# Results that collect the runs of all tasks; the others are replaced by the newest run.
_APPENDED = ("session_aggr_stat", "session_random_extract", "session_detail")


def write_results(results: dict[str, DataFrame], root: str) -> None:
    """Store result tables as folders below ``root``."""
    for name, df in results.items():
        write = sinks.append_table if name in _APPENDED else sinks.overwrite_table
        write(df, f"{root}/{name}")


def publish_views(frames: dict[str, DataFrame]) -> None:
    """Make results available to SQL text under their names."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
