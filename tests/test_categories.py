from pyspark.sql import functions as F

from clickloom.operators import categories
from clickloom.plans import jobs
from tests.tables import PARAMS, action, actions, rows


def _mixed(spark):
    return actions(
        spark,
        action(click_category_id=1, order_category_ids="2,2", pay_category_ids="3"),
        action("s2", click_category_id=1),
        action("s2", order_category_ids="5,5,"),
        action("s2", order_category_ids=""),
        action("s3", pay_category_ids="1,x"),
        action("s3"))


def test_counts(spark):
    acts = _mixed(spark)
    assert rows(categories.click_category_counts(acts)) == [(1, 2)]
    assert rows(categories.order_category_counts(acts)) == [(2, 2), (5, 2)]
    assert rows(categories.pay_category_counts(acts)) == [(1, 1), (3, 1)]
    # Also what the first action ordered and paid for, though it clicked as well.
    assert rows(categories.category_universe(acts)) == [(1,), (2,), (3,), (5,)]


def test_one_pass_equals_joins(spark):
    acts = _mixed(spark)
    joined = (categories.category_universe(acts)
              .join(categories.click_category_counts(acts), "category_id", "left")
              .join(categories.order_category_counts(acts), "category_id", "left")
              .join(categories.pay_category_counts(acts), "category_id", "left")
              .fillna(0))
    assert rows(categories.category_counts(acts)) == rows(joined) == [
        (1, 2, 0, 1), (2, 0, 2, 0), (3, 0, 0, 1), (5, 0, 2, 0)]


def test_totals_of_session_counts(spark):
    acts = _mixed(spark)
    assert rows(categories.total_by_category(categories.session_category_counts(acts))) == rows(
        categories.category_counts(acts))
    assert rows(categories.category_session_counts(acts)) == [(1, "s1", 1), (1, "s2", 1)]


def test_order_of_top_categories(spark):
    counts = spark.createDataFrame(
        [(9, 5, 0, 0), (8, 5, 0, 1), (7, 5, 1, 0), (6, 5, 1, 0), (5, 2**40, 0, 0), (4, 0, 9, 9)],
        "category_id long, click_count long, order_count long, pay_count long")
    found = categories.top10_categories(counts, "t", top=5)
    assert rows(found, "categoryid", order=False) == [(5,), (6,), (7,), (8,), (9,)]


def test_top_sessions_compare_numbers(spark):
    clicks = [action("nine", i, click_category_id=1) for i in range(9)]
    clicks += [action("ten", i, click_category_id=1) for i in range(10)]
    clicks += [action("a", i, click_category_id=1) for i in range(9)]
    clicks += [action("other", click_category_id=2)]
    acts = actions(spark, *clicks)
    top = categories.top10_categories(categories.category_counts(acts), "t", top=1)
    found = categories.top10_sessions(categories.category_session_counts(acts), top, "t", top=2)
    assert rows(found.orderBy(F.desc("clickCount")), order=False) == [
        ("t", 1, "ten", 10), ("t", 1, "a", 9)]


def test_top_lists_share_one_pass(spark):
    found = jobs.top_lists(_mixed(spark), PARAMS)
    assert rows(found["top10_category"], "categoryid", "clickCount") == [
        (1, 2), (2, 0), (3, 0), (5, 0)]
    assert rows(found["top10_session"], "categoryid", "sessionid", "clickCount") == [
        (1, "s1", 1), (1, "s2", 1)]


def test_at_most_ten_per_category(spark):
    acts = actions(spark, *[action(f"s{i:02d}", click_category_id=c)
                            for i in range(30) for c in range(12)])
    found = jobs.top_lists(acts, PARAMS)
    assert found["top10_category"].count() == 10
    per_category = found["top10_session"].groupBy("categoryid").count()
    assert {row["count"] for row in per_category.collect()} == {10}
