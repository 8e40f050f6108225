"""Trailing windows, velocity and version selection."""

import random
import re
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from opsloom.operators import windows as Wn

BASE = datetime(2026, 1, 15, 12, tzinfo=timezone.utc)

# Event offsets in minutes, breach flags, window, expected counts.
SCENARIOS = [
    ([-10, -5, -2], [True, False, True], 60, (3, 2)),
    ([-90, -70, -10], [True, True, False], 60, (1, 0)),
    ([-61, -60, -59], [True, True, True], 60, (2, 2)),
    ([-120, -110], [True, True], 60, (0, 0)),
    ([], [], 60, (0, 0)),
    ([-45, -30, -15, -5], [False] * 4, 60, (4, 0)),
    ([-45, -30, -15, -5], [True] * 4, 60, (4, 4)),
    ([-20, -10, -5], [True, True, False], 15, (2, 1)),
    ([-5, 5], [True, True], 60, (1, 1)),
]


@pytest.mark.parametrize("offsets,flags,minutes,want", SCENARIOS)
def test_window_metrics(spark, offsets, flags, minutes, want):
    rows = [(BASE + timedelta(minutes=o), f) for o, f in zip(offsets, flags)]
    df = spark.createDataFrame(rows, "ts timestamp, is_breach boolean")
    got = Wn.window_metrics(df, "ts", F.col("is_breach"), BASE, minutes).first()
    n, b = want
    assert tuple(got) == (minutes, n, b, round(b / n * 100.0, 2) if n else 0.0)


def brute_force(rows, minutes):
    width = timedelta(minutes=minutes)
    out = {}
    for i, ts, key, _ in rows:
        inside = [f for _, t, k, f in rows if k == key and ts - width <= t <= ts]
        out[i] = (len(inside), sum(inside), round(sum(inside) / len(inside) * 100.0, 2))
    return out


def test_trailing_window_is_one_shuffle_without_hot_buckets(spark):
    rows = [(i, BASE + timedelta(minutes=i), "k", True) for i in range(50)]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp, key string, flag boolean")
    found = Wn.trailing_window(df, "ts", F.col("flag"), 60, ("key",))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
    assert found.columns == [*df.columns, "rolling_event_count", "rolling_breach_count", "rolling_breach_rate_pct"]


def test_trailing_window_adds_no_window_up_anew(spark):
    """Frames that slide cost rows times window; ones that start at the bucket's first row only grow."""
    df = spark.range(50).selectExpr("id AS event_id", "timestamp_seconds(id) AS ts", "id % 2 = 0 AS flag")
    found = Wn.trailing_window(df, "ts", F.col("flag"))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    frames = re.findall(r"specifiedwindowframe\((\w+), ([^,]+),", plan)
    assert frames and {start for _, start in frames} == {"unboundedpreceding$()"}


def test_trailing_window_with_absent_flags_and_odd_times(spark):
    """A missing flag counts as an event without a breach; times before 1970 and on a bucket's edge."""
    hour = 3_600_000_000
    rows = [(0, -hour - 1, True), (1, -hour, None), (2, -1, None), (3, 0, True), (4, 0, False), (5, hour, None), (6, hour + 1, True)]
    df = spark.createDataFrame(rows, "event_id long, at long, flag boolean").withColumn("ts", F.timestamp_micros("at"))
    got = Wn.trailing_window(df, "ts", F.col("flag")).collect()
    want = {}
    for i, t, _ in rows:
        inside = [f for _, u, f in rows if t - hour <= u <= t]
        want[i] = (len(inside), sum(bool(f) for f in inside))
    assert {r.event_id: (r.rolling_event_count, r.rolling_breach_count) for r in got} == want


@pytest.mark.parametrize("hot_rows", [10, 40, 10**9])
@pytest.mark.parametrize("by", [(), ("key",)])
def test_trailing_window_on_skewed_events(spark, by, hot_rows):
    """A third of the rows at one instant of one key, ties, and an event exactly on the old edge."""
    rng = random.Random(9)
    rows = [(0, BASE, "hot", True), (1, BASE + timedelta(minutes=60), "hot", False)]
    for i in range(2, 300):
        if i % 3 == 0:
            rows.append((i, BASE + timedelta(minutes=30), "hot", i % 2 == 0))
        else:
            at = BASE + timedelta(microseconds=rng.randrange(6 * 3600) * 1_000_000 + rng.randrange(3))
            rows.append((i, at, rng.choice("abc"), rng.random() < 0.3))
    keyed = [(i, t, k if by else "", f) for i, t, k, f in rows]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp, key string, flag boolean")
    got = Wn.trailing_window(df, "ts", F.col("flag"), 60, by, hot_rows=hot_rows).collect()
    assert {
        r.event_id: (r.rolling_event_count, r.rolling_breach_count, r.rolling_breach_rate_pct) for r in got
    } == brute_force(keyed, 60)


def test_velocity_counts_a_missing_window_as_zero(spark):
    offsets = [0, 10, 70, 75, 79, 200]
    df = spark.createDataFrame([(BASE + timedelta(minutes=o),) for o in offsets], "ts timestamp")
    got = Wn.failure_velocity(df, "ts").orderBy("window_start").collect()
    assert [(r.incidents, r.previous_incidents, r.velocity) for r in got] == [(2, 0, 2), (3, 2, 1), (1, 0, 1)]


def test_latest_by_key(spark):
    rows = [("EXC-1", 50.0, 1), ("EXC-2", 70.0, 2), ("EXC-1", 99.0, 3), ("EXC-2", 10.0, 4)]
    df = spark.createDataFrame(rows, "exception_id string, priority_score double, version long")
    got = Wn.latest_by_key(df, "exception_id", "version")
    assert got.columns == df.columns
    assert sorted(tuple(r) for r in got.collect()) == [("EXC-1", 99.0, 3), ("EXC-2", 10.0, 4)]
