"""All operators against plain loops, on random rows that provoke the hard cases."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest

import anchorctx as ac
import brute
from frames import ACTIVITY, ANCHORS, LOG, bag, frame

PERIODS = [("b", "before", 180), ("a", "after", 180), ("h", "before", 3600), ("z", "after", 0)]


def random_tables(seed, start):
    """Few devices, ids and distinct times, so that all kinds of copies and ties occur;
    one device holds most rows."""
    draw = random.Random(seed)
    steps = [0, 1, 500_000, 999_999, 1_000_000, 60_000_000, 179_999_999, 180_000_000]

    def time():
        if draw.random() < 0.03:
            return None
        offset = draw.choice([draw.randrange(40) * 250_000, draw.randrange(9_000_000_000)])
        return start + timedelta(microseconds=offset + draw.choice(steps))

    def device():
        return draw.choice(["hot", "hot", "hot", "a", "b", None])

    anchors = [(draw.choice([*range(25), None]), device(), time()) for _ in range(45)]
    activity = [
        (device(), time(), draw.choice([200, 0, 401, None]), draw.choice(["X", "Y", None]))
        for _ in range(160)
    ]
    log = [
        (device(), draw.choice([n, n // 3, None]), time(), draw.choice(["ON", "OFF", None]))
        for n in range(80)
    ]
    # Events at exactly an anchor's time, and exact copies of rows.
    activity += [(a[1], a[2], 200, "X") for a in anchors[::4]] + activity[:20]
    log += [(a[1], 500 + n, a[2], "ON") for n, a in enumerate(anchors[::5])] + log[:10]
    return anchors + anchors[:5], activity, log


# Seed, first time, zoned or not, chunk length. Seconds around 1970 are special.
CASES = [
    (1, datetime(2024, 3, 10, 0, 30), False, 60),
    (2, datetime(2024, 1, 1), True, 100_000),
    (3, datetime(1969, 12, 31, 23, 0), False, 7),
    (4, datetime(1969, 12, 31, 23, 30), True, 1800),
]


@pytest.fixture(params=CASES, ids=lambda case: f"seed{case[0]}")
def case(request, spark):
    seed, start, zoned, chunk = request.param
    rows = random_tables(seed, start)
    schemas = (ANCHORS, ACTIVITY, LOG)
    return rows, [frame(spark, r, s, zoned) for r, s in zip(rows, schemas)], chunk


def periods():
    return [ac.Period(*p) for p in PERIODS]


def test_window_join(case):
    (anchors, activity, _), (a, p, _), chunk = case
    for period in PERIODS:
        joined = ac.window_join(a, p, ac.Period(*period), bucket_seconds=max(chunk, 50))
        expected = Counter(
            (*anchor, *event[1:])
            for anchor, event in brute.pairs(anchors, activity, *period[1:])
        )
        columns = (
            "order_id",
            "device_id",
            "order_creation_time",
            "polling_creation_time",
            "status_code",
            "error_code",
        )
        assert bag(joined, *columns) == expected


def test_profile_forms_agree_with_loops(case):
    (anchors, activity, _), (a, p, _), chunk = case
    expected = Counter(brute.profile(anchors, activity, PERIODS))
    assert bag(ac.period_counts(a, p, periods())) == expected
    for name, *rest in PERIODS[1:3]:
        joined = ac.window_join(a, p, ac.Period(name, *rest))
        one = Counter((r[0], *r[2:]) for r in expected.elements() if r[1] == name)
        assert bag(ac.window_profile(joined)) == one


def test_multi_period_profile(case):
    (anchors, activity, _), (a, p, _), chunk = case
    expected = Counter(brute.multi_period(anchors, activity, PERIODS))
    assert bag(ac.multi_period_profile(a, p, periods())) == expected


def test_neighbours(case):
    (anchors, activity, _), (a, p, _), chunk = case
    expected = Counter(brute.neighbours(anchors, activity))
    assert bag(ac.neighbours(a, p, chunk_seconds=chunk)) == expected
    assert bag(ac.previous_event(a, p)) == Counter(r[:2] for r in expected if r[1])
    assert bag(ac.next_event(a, p)) == Counter((r[0], r[2]) for r in expected if r[2])


def test_states(case):
    (anchors, _, log), (a, _, s), chunk = case
    columns = ("device_id", "row_num", "cs_creation_time", "status", "status_change_time")
    changes = ac.state_changes(s, chunk_seconds=chunk)
    assert bag(changes, *columns) == Counter(brute.changes(log))
    got = bag(ac.state_as_of(a, s, chunk_seconds=chunk))
    assert got == Counter(brute.state(anchors, log))


def test_context(case):
    (anchors, activity, log), (a, p, s), chunk = case
    expected = Counter(brute.context(anchors, activity, log))
    assert bag(ac.unbounded_context(a, p, s, chunk_seconds=chunk)) == expected


def test_report(case):
    (anchors, activity, log), (a, p, s), chunk = case
    expected = Counter(brute.report(anchors, activity, log, PERIODS))
    assert bag(ac.context_report(a, p, s, periods(), chunk_seconds=chunk)) == expected


def test_time_zone_does_not_move_wall_clock_times(spark, clock):
    """The night the clocks change in the session's zone."""
    rows = random_tables(1, datetime(2024, 3, 10, 0, 30))
    a, p, s = (frame(spark, r, t) for r, t in zip(rows, (ANCHORS, ACTIVITY, LOG)))
    clock("America/New_York")
    expected = Counter(brute.report(*rows, PERIODS))
    assert bag(ac.context_report(a, p, s, periods())) == expected


def test_several_key_columns(spark):
    anchors, activity, log = random_tables(7, datetime(2024, 1, 1))
    split = ["substr(device_id, 1, 1) as k1", "substr(device_id, 2) as k2", "*"]
    wide = [
        frame(spark, rows, schema).selectExpr(*split).drop("device_id")
        for rows, schema in ((anchors, ANCHORS), (activity, ACTIVITY), (log, LOG))
    ]
    expected = Counter(brute.report(anchors, activity, log, PERIODS))
    assert bag(ac.context_report(*wide, periods(), key=["k1", "k2"])) == expected
