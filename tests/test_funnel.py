import random
from collections import Counter

from clickloom import TaskParams
from clickloom.operators import funnel
from tests.tables import action, actions, rows


def _flow(text):
    return TaskParams.of("2024-01-01", "2024-01-31", page_flow=text, task_id="t")


def _walk(session, *pages, start=0, step=1):
    return [action(session, start + i * step, page=page) for i, page in enumerate(pages)]


def _rates(spark, flow, *walks):
    acts = actions(spark, *[a for walk in walks for a in walk])
    return rows(funnel.page_conversion(acts, _flow(flow)).orderBy("step"),
                "step", "page_id", "next_page_id", "pair_count", "rate", order=False)


def test_missing_step_stops_the_flow(spark):
    found = _rates(spark, "1,2,3,4", _walk("a", 1, 2), _walk("b", 1, 2), _walk("c", 1, 9),
                   _walk("d", 1), _walk("e", 3, 4))
    assert found == [(0, 1, 2, 2, 0.5), (1, 2, 3, 0, 0.0), (2, 3, 4, 1, 0.0)]


def test_repeated_pair(spark):
    found = _rates(spark, "1,2,1,2", _walk("a", 1, 2, 1), _walk("b", 1, 2), _walk("c", 1))
    assert found == [(0, 1, 2, 2, 0.5), (1, 2, 1, 1, 0.5), (2, 1, 2, 2, 2.0)]


def test_unseen_start_and_short_flows(spark):
    walk = _walk("a", 1, 2)
    assert _rates(spark, "8,1,2", walk) == [(0, 8, 1, 0, 0.0), (1, 1, 2, 1, 0.0)]
    assert _rates(spark, "1", walk) == []
    assert _rates(spark, "", walk) == []


def test_flow_with_a_page_after_itself(spark):
    same_time = [action("b", 0, page=4)] * 3
    assert _rates(spark, "4,4", _walk("a", 4, 4, 5, 4), same_time) == [(0, 4, 4, 3, 0.5)]


def test_report(spark):
    acts = actions(spark, *_walk("a", 1, 2), *_walk("b", 1))
    report = funnel.conversion_report(funnel.page_conversion(acts, _flow("1,2,3")), "t")
    assert rows(report) == [("t", "1_2:0.5"), ("t", "2_3:0.0")]


def test_start_count_counts_actions(spark):
    acts = actions(spark, *_walk("a", 1, 2, 1), *_walk("b", 1))
    assert funnel.start_page_count(acts, _flow("1,2")).first()[0] == 3


def _brute_force(visits):
    """Pairs of each session in (time, page) order, one session after the other."""
    pairs, by_session = Counter(), {}
    for session, seconds, page in visits:
        by_session.setdefault(session, []).append((seconds, page))
    for steps in by_session.values():
        steps.sort()
        pairs.update((a[1], b[1]) for a, b in zip(steps, steps[1:]))
    return pairs


def test_pairs_equal_brute_force(spark):
    # One session has most of the rows, spread over days with gaps; many rows are copies.
    rng = random.Random(5)
    visits = [("hot", rng.choice([rng.randrange(300_000), rng.randrange(50)]), rng.randrange(5))
              for _ in range(1500)]
    visits += [(f"s{rng.randrange(40)}", rng.randrange(9000), rng.randrange(5))
               for _ in range(500)]
    visits += [("hot", 7, 3)] * 200
    acts = actions(spark, *[action(s, t, page=p) for s, t, p in visits])
    runs = funnel.page_runs(acts)
    assert runs.agg({"visits": "sum"}).first()[0] == len(visits)

    found = funnel.page_pairs(runs).groupBy("page_id", "next_page_id").sum("pair_count")
    expected = _brute_force(visits)
    assert {(a, b): n for a, b, n in found.collect()} == dict(expected)

    wanted = funnel.page_pair_counts(runs, _flow("0,1,1,4"))
    assert {(a, b): n for a, b, n in wanted.collect()} == {
        pair: expected[pair] for pair in [(0, 1), (1, 1), (1, 4)]}


def test_no_task_orders_a_whole_session(spark):
    acts = actions(spark, *_walk("hot", *[1, 2] * 50, step=1800))
    plan = funnel.page_runs(acts)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") >= 2 and "chunk" in plan


def test_one_window_over_the_visits_of_an_hour(spark):
    acts = actions(spark, *[action(f"s{k % 3}", k * 700, page=k % 4) for k in range(60)])
    plan = funnel.page_pairs(funnel.page_runs(acts))._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.split("\n") if "- Window [" in line]
    assert sum("action_time" in line for line in windows) == 1 and len(windows) == 2


def test_sessions_and_pages_without_an_id(spark):
    """A missing session id is one session over its hours; a missing page is a page like others."""
    acts = actions(spark, *[action(None, k * 2000, page=p) for k, p in enumerate([1, None, 2, 3])],
                   action("s", 0, page=None), action("s", 9000, page=7))
    found = funnel.page_runs(acts).orderBy("session_id", "action_time").select(
        "session_id", "page_id", "next_page_id").collect()
    assert [tuple(r) for r in found] == [
        (None, 1, None), (None, None, 2), (None, 2, 3), (None, 3, None), ("s", None, 7),
        ("s", 7, None)]
