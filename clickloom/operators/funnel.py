"""Page-to-page conversion along a page flow."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom.functions import columns as C
from clickloom.params import TaskParams

# Sessions are cut into chunks of this length, so that no task has to order a whole session.
_CHUNK = "hour"


def page_runs(actions: DataFrame) -> DataFrame:
    """Page visits of every session in time order, each with the page that follows it.

    Columns: session_id, action_time, page_id, visits, next_page_id (null at a session's end).
    Visits of one page at one time in one session cannot be told apart, so they are one row with a
    count; this shrinks copied rows before the first shuffle. The page that follows is looked up
    per session and hour; the last visit of an hour is followed by the first one of the session's
    next hour, and these are a row per hour. So a session with a large share of all actions spreads
    over as many tasks as it has hours. Ties in time are ordered by page.
    """
    # A struct as key: sessions without an id are one session, also in the join.
    chunk = F.struct("session_id", F.date_trunc(_CHUNK, "action_time").alias("hour"))
    runs = (actions.groupBy("session_id", "action_time", "page_id")
            .agg(F.count(F.lit(1)).alias("visits"))
            .withColumn("chunk", chunk)
            # The partitioning of all that follows on the chunk; both sides of the join read it.
            .repartition("chunk"))
    by_session = Window.partitionBy("chunk.session_id").orderBy("chunk.hour")
    first = F.min(F.struct("action_time", "page_id")).alias("first")
    later = (runs.groupBy("chunk").agg(first)
             .select("chunk", F.lead("first.page_id").over(by_session).alias("later_page_id")))
    in_chunk = Window.partitionBy("chunk").orderBy("action_time", "page_id")
    # A missing next page may also be a visit without a page, so the last visit is marked.
    return (runs.withColumns({"next_page_id": F.lead("page_id").over(in_chunk),
                              "is_last": F.lead(F.lit(True)).over(in_chunk).isNull()})
            .join(later, "chunk")
            .select("session_id", "action_time", "page_id", "visits",
                    F.when(F.col("is_last"), F.col("later_page_id"))
                    .otherwise(F.col("next_page_id")).alias("next_page_id")))


def page_pairs(runs: DataFrame) -> DataFrame:
    """Consecutive pages per session and time, with the number of times they follow each other.

    A run of n visits of one page is n - 1 pairs of the page with itself, then one pair with the
    page that follows; where that is the same page again, the two are one row.
    """
    page, following = F.col("page_id"), F.col("next_page_id")
    with_itself = F.col("visits") - 1
    same = following.eqNullSafe(page)
    pairs = F.array(
        F.struct(following, F.when(same, with_itself + 1).otherwise(F.lit(1)).alias("pair_count")),
        F.struct(page.alias("next_page_id"),
                 F.when(same, F.lit(0)).otherwise(with_itself).alias("pair_count")))
    return (runs.select("session_id", "action_time", "page_id", F.inline(pairs))
            .where(F.col("next_page_id").isNotNull() & (F.col("pair_count") > 0)))


def _flow(params: TaskParams) -> list[tuple[int, int, int | None]]:
    """The flow as (step, page, next page). Step -1 stands for arriving at the first page."""
    flow = params.page_flow
    arrival = [(-1, flow[0], None)] if flow else []
    return arrival + [(i, *pair) for i, pair in enumerate(zip(flow, flow[1:]))]


def _inline(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    """Rows of the parameters as an inline table: its size is known, so joins broadcast it."""
    def text(value):
        return "cast(null as bigint)" if value is None else f"{int(value)}L"

    # A row of zeros gives the types, also where there are no other rows.
    zeros = (0,) * len(columns.split(","))
    values = ", ".join(f"({', '.join(map(text, row))}, {real})"
                       for row, real in [(zeros, "false"), *((row, "true") for row in rows)])
    return spark.sql(f"select {columns} from values {values} as t({columns}, is_real) "
                     "where is_real")


def _flow_pairs(runs: DataFrame, params: TaskParams) -> DataFrame:
    """Counts of the flow's pairs and of the arrivals at its first page, from one pass."""
    arrivals = F.when(F.col("page_id").isin(*params.page_flow[:1]), F.col("visits"))
    none = F.lit(None).cast("long")
    events = F.array(
        F.struct(F.col("next_page_id"), F.lit(1).cast("long").alias("n"),
                 F.col("next_page_id").isNotNull().alias("counts")),
        F.struct(F.col("page_id").alias("next_page_id"), (F.col("visits") - 1).alias("n"),
                 (F.col("visits") > 1).alias("counts")),
        F.struct(none.alias("next_page_id"), arrivals.alias("n"),
                 arrivals.isNotNull().alias("counts")))
    wanted = _inline(runs.sparkSession, list(dict.fromkeys(row[1:] for row in _flow(params))),
                     "page_id, next_page_id")
    counted = runs.select("page_id", F.inline(events)).where("counts")
    return (_on_pair(counted, wanted, "left_semi")
            .groupBy("page_id", "next_page_id").agg(F.sum("n").alias("pair_count")))


def _on_pair(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    # Arrivals have no next page, hence the null-safe comparison.
    same = ((left["page_id"] == right["page_id"])
            & left["next_page_id"].eqNullSafe(right["next_page_id"]))
    return left.join(right, same, how)


def page_pair_counts(runs: DataFrame, params: TaskParams) -> DataFrame:
    """How often the pairs of the flow occur, over all sessions."""
    return _flow_pairs(runs, params).where(F.col("next_page_id").isNotNull())


def start_page_count(actions: DataFrame, params: TaskParams) -> DataFrame:
    """Number of actions on the first page of the flow."""
    return (actions.where(F.col("page_id").isin(*params.page_flow[:1]))
            .agg(F.count(F.lit(1)).alias("start_count")))


def page_conversion(actions: DataFrame, params: TaskParams) -> DataFrame:
    """Rate of every step of the flow to the step before it, the first to the arrivals.

    0.0 where the step or the one before never happened. The window runs over the steps of the
    flow, which is a parameter.
    """
    steps = _inline(actions.sparkSession, _flow(params), "step, page_id, next_page_id")
    counts = _flow_pairs(page_runs(actions), params)
    counted = (_on_pair(steps, counts, "left")
               .select("step", steps["page_id"], steps["next_page_id"],
                       F.coalesce("pair_count", F.lit(0)).alias("pair_count")))
    before = F.lag("pair_count").over(Window.partitionBy(F.lit(1)).orderBy("step"))
    return (counted.withColumn("before", before)
            .where(F.col("step") >= 0)
            .select(F.col("step").cast("int").alias("step"), "page_id", "next_page_id",
                    "pair_count",
                    F.when(F.col("before") > 0, F.col("pair_count") / F.col("before"))
                    .otherwise(F.lit(0.0)).alias("rate")))


def conversion_report(conversion: DataFrame, task_id: str) -> DataFrame:
    """The conversion as the packed text of the result table, ``<page>_<next>:<rate>``."""
    pair = C.pair_text(F.col("page_id"), F.col("next_page_id"))
    return conversion.select(
        F.lit(task_id).alias("taskid"),
        F.concat(pair, F.lit(":"), F.col("rate").cast("string")).alias("convertRate"))
