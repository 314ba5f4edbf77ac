"""Ad-click counts. The plain ``*_counts`` work on batches and, where noted, on streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.partitioning import forget_partitioning

BLACKLIST_THRESHOLD = 100
TOP_ADS = 3

# Minutes of the recent-hour window, and of the stretches its running sums are cut into.
_HOUR, _DAY = 60, 24 * 60


def ad_user_daily_clicks(clicks: DataFrame) -> DataFrame:
    """Clicks per day, user and ad."""
    return clicks.groupBy("date", "userid", "adid").agg(F.count(F.lit(1)).alias("clickCount"))


def add_stored(counts: DataFrame, stored: DataFrame) -> DataFrame:
    """Running totals of the keys in ``counts``: what a table has stored so far, plus the counts.

    For totals kept in a table that is read and written anew.
    """
    keys = ["date", "userid", "adid"]
    before = stored.select(*keys, F.col("clickCount").alias("before"))
    total = F.col("clickCount") + F.coalesce("before", F.lit(0))
    return counts.join(before, keys, "left").select(*keys, total.alias("clickCount"))


def over_threshold(user_counts: DataFrame, threshold: int = BLACKLIST_THRESHOLD) -> DataFrame:
    """Users who clicked one ad at least ``threshold`` times on one day, once per day and ad."""
    return user_counts.where(F.col("clickCount") >= threshold).select("userid")


def ad_blacklist(clicks: DataFrame, threshold: int = BLACKLIST_THRESHOLD) -> DataFrame:
    """Users to be barred, from all clicks of a batch."""
    return over_threshold(ad_user_daily_clicks(clicks), threshold).distinct()


def drop_blacklisted(clicks: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Clicks of users who are not on the blacklist."""
    barred = forget_partitioning(blacklist.select("userid"))
    return clicks.join(barred, "userid", "left_anti").select(clicks.columns)


def ad_clicks_admitted(clicks: DataFrame,
                       threshold: int = BLACKLIST_THRESHOLD) -> DataFrame:
    """The clicks a day-by-day run admits.

    A user who reaches the threshold is barred from the next day on: the clicks of that day still
    count, later ones are dropped. One row per barred user meets the clicks in an anti join, which
    AQE turns into a broadcast if that side is small and splits on the clicks' side if one user
    has a large share of them.
    """
    barred = (ad_user_daily_clicks(clicks)
              .where(F.col("clickCount") >= threshold)
              .groupBy(F.col("userid").alias("barred_userid"))
              .agg(F.min("date").alias("barred_after")))
    is_barred = ((F.col("userid") == F.col("barred_userid"))
                 & (F.col("date") > F.col("barred_after")))
    return clicks.join(forget_partitioning(barred), is_barred, "left_anti")


def ad_region_counts(clicks: DataFrame) -> DataFrame:
    """Clicks per day, province, city and ad."""
    return (clicks.groupBy("date", "province", "city", "adid")
            .agg(F.count(F.lit(1)).alias("clickCount")))


def ad_province_counts(region_counts: DataFrame) -> DataFrame:
    """Region counts rolled up to day, province and ad."""
    return (region_counts.groupBy("date", "province", "adid")
            .agg(F.sum("clickCount").alias("clickCount")))


def ad_province_top3(province_counts: DataFrame, top: int = TOP_ADS) -> DataFrame:
    """The most clicked ads per day and province; equal counts by smallest ad id."""
    by_group = Window.partitionBy("date", "province").orderBy(F.desc("clickCount"), "adid")
    return (province_counts.withColumn("place", F.row_number().over(by_group))
            .where(F.col("place") <= top)
            .drop("place"))


def minute_counts(clicks: DataFrame) -> DataFrame:
    """Clicks per minute and ad, for batches and streams."""
    return (clicks.groupBy(F.window("click_time", "1 minute").alias("w"), "adid")
            .agg(F.count(F.lit(1)).alias("clickCount"))
            .select(F.col("w.start").alias("minute_start"), "adid", "clickCount"))


def ad_click_trend(counts: DataFrame) -> DataFrame:
    """Minute counts in the form of the result table: day, hour and minute apart."""
    start = F.col("minute_start")
    return counts.select(F.to_date(start).alias("date"),
                         F.date_format(start, "HH").alias("hour"),
                         F.date_format(start, "mm").alias("minute"), "adid", "clickCount")


def ad_recent_hour(counts: DataFrame) -> DataFrame:
    """Clicks per ad in every 60 minutes that start on a full minute and hold a click.

    A minute's clicks are in the 60 windows that start up to it. Instead of 60 rows a minute gives
    two: its clicks enter with the first of these windows and leave after the last. The running
    sum per ad then is the content of every window; it changes only at these rows, and in between
    it is repeated. The sum runs within an ad and a day of window starts: where midnight is among a
    minute's 60 windows, its clicks leave before it and enter again, so every day begins and ends
    with nothing. An ad is spread over its days, with at most two rows per minute, however many
    clicks it drew.
    """
    spans = counts.selectExpr(
        "adid", "clickCount as n", f"unix_seconds(minute_start) div 60 - {_HOUR - 1} as low",
        "unix_seconds(minute_start) div 60 + 1 as high").selectExpr(
        "*", f"cast(floor(low / {_DAY}) as long) as day",
        f"cast(floor((high - 1) / {_DAY}) as long) as last_day")

    def change(day: str, first: str, n: str) -> str:
        return f"named_struct('day', {day}, 'first', {first}, 'n', {n})"

    enter, leave = change("day", "low", "n"), change("last_day", "high", "-n")
    midnight = f"last_day * {_DAY}"
    changes = (spans
               .select("adid", F.expr(f"""inline(if(day = last_day, array({enter}, {leave}),
                   array({enter}, {change("day", midnight, "-n")},
                         {change("last_day", midnight, "n")}, {leave})))"""))
               .groupBy("adid", "day", "first").agg(F.sum("n").alias("n")))
    by_day = Window.partitionBy("adid", "day").orderBy("first")
    return (changes
            .withColumn("clickCount", F.sum("n").over(by_day))
            .withColumn("next", F.lead("first").over(by_day))
            .where(F.col("clickCount") > 0)
            .select("adid", "clickCount", F.explode(F.expr("sequence(first, next - 1)")).alias("m"))
            .select(F.expr("timestamp_seconds(m * 60)").alias("window_start"),
                    F.expr(f"timestamp_seconds((m + {_HOUR}) * 60)").alias("window_end"),
                    "adid", "clickCount"))
