from pyspark.sql import functions as F

from clickloom import TaskParams
from clickloom.functions import columns as C
from clickloom.operators import sampling, sessions
from tests.tables import PARAMS, action, actions, at, rows, users

LENGTHS = [0, 3, 4, 10, 30, 31, 60, 61, 180, 181, 600, 601, 1800, 1801]


def _params(**filters):
    return TaskParams.of("2024-01-01", "2024-01-31", **filters)


def _kept(spark, action_rows, user_rows, **filters):
    found = sessions.filtered_sessions(actions(spark, *action_rows), users(spark, *user_rows),
                                       _params(**filters))
    return [row[0] for row in rows(found, "session_id")]


def test_summary(spark):
    found = sessions.session_summary(
        actions(spark,
                action(seconds=5, search_keyword="kw1"),
                action(seconds=65, search_keyword="kw10"),
                action(seconds=9, search_keyword="kw1"),
                action(seconds=10, search_keyword=""),
                action(seconds=20, click_category_id=11),
                action(seconds=21, click_category_id=1),
                action(session="s2", user=9)),
        users(spark, (1, 30, "p", "c", "male")))
    text = found.select("session_id", "user_id", C.time_text(F.col("start_time")),
                        C.time_text(F.col("end_time")), "visit_length", "step_length",
                        C.joined(F.col("search_keywords")), C.joined(F.col("click_category_ids")),
                        "age", "professional", "sex", "city")
    # kw1 is part of kw10 and 1 of 11; the session of the unknown user 9 is gone.
    assert rows(text) == [("s1", 1, at(5), at(65), 60, 6, "kw1,kw10", "1,11",
                           30, "p", "male", "c")]


def test_empty_lists_are_null(spark):
    found = sessions.session_facts(actions(spark, action()))
    assert rows(found.select(C.joined(F.col("search_keywords")))) == [(None,)]


def test_age_needs_both_bounds(spark):
    acts = [action(session=f"s{u}", user=u) for u in (1, 2, 3)]
    people = [(1, 10, "p", "c", "m"), (2, 30, "p", "c", "m"), (3, None, "p", "c", "m")]
    assert _kept(spark, acts, people, start_age=20) == ["s1", "s2", "s3"]
    assert _kept(spark, acts, people, end_age=20) == ["s1", "s2", "s3"]
    assert _kept(spark, acts, people, start_age=10, end_age=29) == ["s1"]


def test_user_filters(spark):
    acts = [action(session=f"s{u}", user=u) for u in (1, 2, 3)]
    people = [(1, 20, "a", "x", "male"), (2, 20, "b", "y", "female"), (3, 20, None, "-1", "male")]
    assert _kept(spark, acts, people, professionals="a,b") == ["s1", "s2"]
    assert _kept(spark, acts, people, cities="y,-1") == ["s2"]
    assert _kept(spark, acts, people, sex="male") == ["s1", "s3"]
    assert _kept(spark, acts, people, sex="male", professionals="b") == []
    assert _kept(spark, acts, people, professionals="", sex="") == ["s1", "s2", "s3"]


def test_interest_filters_match_whole_values(spark):
    acts = [action(session="s1", search_keyword="kw1", user=1),
            action(session="s1", click_category_id=11, user=1),
            action(session="s2", search_keyword="kw10", user=2),
            action(session="s2", click_category_id=1, user=2),
            action(session="s3", user=3)]
    people = [(u, 20, "a", "x", "male") for u in (1, 2, 3)]
    assert _kept(spark, acts, people, keywords="kw1") == ["s1"]
    assert _kept(spark, acts, people, keywords="kw10,zz") == ["s2"]
    assert _kept(spark, acts, people, category_ids="1") == ["s2"]
    assert _kept(spark, acts, people, category_ids="1,11") == ["s1", "s2"]
    assert _kept(spark, acts, people, category_ids="1", keywords="kw1") == []


def test_filtered_actions(spark):
    acts = actions(spark, action("s1"), action("s1", 1), action("s2"))
    kept = sessions.session_facts(acts).where("session_id = 's1'")
    assert sessions.filtered_actions(acts, kept).count() == 2


def test_bucket_edges(spark):
    acts = [action(session=f"s{n}", seconds=s) for n in LENGTHS for s in (0, n)]
    found = sessions.session_bucket_counts(sessions.session_facts(actions(spark, *acts))).first()
    visits = [found[name] for name, _, _ in sessions.VISIT_CLASSES]
    assert found["session_count"] == 14
    assert visits == [1, 1, 0, 2, 2, 2, 2, 2, 1]
    assert [found[name] for name, _, _ in sessions.STEP_CLASSES] == [14, 0, 0, 0, 0, 0]


def test_step_edges(spark):
    sizes = [1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61]
    acts = [action(session=f"s{n}", seconds=i) for n in sizes for i in range(n)]
    found = sessions.session_bucket_counts(sessions.session_facts(actions(spark, *acts))).first()
    assert [found[name] for name, _, _ in sessions.STEP_CLASSES] == [2, 2, 2, 2, 2, 1]


def test_ratio_rounds_half_up(spark):
    counts = ", ".join(f"{n}L as {name}" for name, n in
                       zip(sessions.CLASS_NAMES, [1, 57, 199, 200, 0] + [0] * 10))
    found = sessions.session_ratio(
        spark.sql(f"select 200L as session_count, {counts}"), "t").first()
    assert list(found)[:7] == ["t", 200, 0.01, 0.29, 1.0, 1.0, 0.0]


def test_no_session_left(spark):
    acts, people = actions(spark, action()), users(spark, (1, 10, "p", "c", "m"))
    kept = sessions.filtered_sessions(acts, people, _params(sex="none"))
    found = list(sessions.session_ratio(sessions.session_bucket_counts(kept), "t").first())
    assert found == ["t", 0] + [0.0] * 15
    assert sampling.session_extract(acts, kept, PARAMS).count() == 0


def _hours(spark, *counts):
    return spark.createDataFrame(counts, "date string, hour int, session_count long")


def test_quota(spark):
    hours = _hours(spark, ("2024-01-01", 1, 30), ("2024-01-01", 2, 10), ("2024-01-02", 5, 400))
    found = sampling.session_extract_quota(hours)
    assert rows(found, "date", "hour", "day_count", "per_day", "quota") == [
        ("2024-01-01", 1, 40, 50, 30), ("2024-01-01", 2, 40, 50, 10),
        ("2024-01-02", 5, 400, 50, 50)]


def test_more_days_than_sample(spark):
    hours = _hours(spark, *[(f"d{i}", 1, 5) for i in range(101)])
    assert sampling.session_extract_quota(hours).agg(F.sum("quota")).first()[0] == 0


def _sessions(spark, per_hour):
    acts = [action(session=f"s{hour}-{i}", time=f"2024-01-10 {hour:02d}:00:00",
                   search_keyword=f"k{i}")
            for hour, n in per_hour.items() for i in range(n)]
    acts = actions(spark, *acts)
    return acts, sessions.session_facts(acts)


def test_sample_is_repeatable_and_within_quota(spark):
    acts, facts = _sessions(spark, {1: 60, 2: 20, 3: 120})
    first = rows(sampling.session_extract(acts, facts, PARAMS))
    assert first == rows(sampling.session_extract(acts, facts.repartition(5), PARAMS))
    per_hour = [sum(r[1].startswith(f"s{hour}-") for r in first) for hour in (1, 2, 3)]
    assert per_hour == [30, 10, 60]
    other = rows(sampling.session_extract(acts, facts, PARAMS, seed="7"))
    assert len(other) == len(first) and other != first


def test_sample_total(spark):
    acts, facts = _sessions(spark, {1: 30, 2: 10})
    assert sampling.session_extract(acts, facts, PARAMS, total=4).count() == 4


def test_detail_has_all_actions_of_the_sample(spark):
    acts = actions(spark, action("s1"), action("s1", 5, page=2), action("s2", 9))
    facts = sessions.session_facts(acts)
    found = sampling.session_extract_detail(acts, facts, PARAMS)
    assert rows(found, "taskid", "sessionid", "pageid", "actionTime") == [
        ("task", "s1", 1, at(0)), ("task", "s1", 2, at(5)), ("task", "s2", 1, at(9))]
