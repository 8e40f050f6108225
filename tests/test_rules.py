"""SLA, priority and rounding rules, each table as one DataFrame."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from opsloom.functions import rules as R
from opsloom.functions.rounding import mean2, percent, round_binary

START = datetime(2026, 1, 15, 12, tzinfo=timezone.utc)

# SLA minutes per tier and severity.
TARGETS = [
    ("Enterprise", "Critical", 180, 60),
    ("Enterprise", "High", 180, 120),
    ("Enterprise", "Medium", 180, 180),
    ("Enterprise", "Low", 180, 180),
    ("Commercial", "Critical", 240, 180),
    ("Commercial", "High", 240, 240),
    ("Commercial", "Medium", 240, 240),
    ("Commercial", "Low", 240, 240),
    ("Retail", "Critical", 360, 360),
    ("Retail", "High", 360, 360),
    ("Retail", "Medium", 360, 360),
    ("Retail", "Low", 360, 360),
    ("Enterprise", "Critical", 30, 30),
    ("Enterprise", "High", 90, 90),
    ("Commercial", "Critical", 100, 100),
    ("enterprise", "Critical", 180, 180),
]


def test_sla_target(spark):
    df = spark.createDataFrame(TARGETS, "tier string, severity string, minutes int, expected int")
    got = df.withColumn("got", R.sla_target(F.col("tier"), F.col("severity"), F.col("minutes")))
    assert got.where("got <> expected").collect() == []


# SLA status at the boundaries.
STATES = [
    *[(m, 100, "ON_TRACK") for m in (0, 10, 50, 75, 79.0, 79.9)],
    *[(m, 100, "AT_RISK") for m in (80.0, 80.1, 85.0, 90.0, 95.0, 99.0, 99.9)],
    *[(m, 100, "BREACHED") for m in (100.0, 100.1, 105.0, 150.0, 500.0)],
    (24.0, 30, "AT_RISK"),
    (30.0, 30, "BREACHED"),
]


def states(spark, rows, **thresholds):
    df = spark.createDataFrame(rows, "start_time timestamp, clock timestamp, target_minutes int")
    return R.with_sla_state(df, **thresholds).collect()


def test_sla_boundaries(spark):
    rows = [(START, START + timedelta(minutes=m), t) for m, t, _ in STATES]
    for got, (minutes, target, status) in zip(states(spark, rows), STATES):
        assert got.sla_status == status
        assert got.elapsed_minutes == pytest.approx(minutes)
        assert got.remaining_minutes == pytest.approx(target - minutes)


def test_sla_edges(spark):
    day30 = START + timedelta(days=30)
    rows = [
        (START + timedelta(minutes=10), START, 60),
        (START, START + timedelta(minutes=60), 60),
        (START, START + timedelta(seconds=90), 10),
        (START, day30, 60),
        (START, START + timedelta(minutes=5), 0),
    ]
    skew, equal, part, long, zero = states(spark, rows)
    assert (skew.sla_status, skew.elapsed_minutes, skew.remaining_minutes, skew.consumption_ratio) == (
        "ON_TRACK", 0.0, 60.0, 0.0,
    )
    assert (equal.sla_status, equal.elapsed_minutes, equal.remaining_minutes) == ("BREACHED", 60.0, 0.0)
    assert (part.elapsed_minutes, part.remaining_minutes, part.consumption_ratio) == (1.5, 8.5, 0.15)
    assert (long.sla_status, long.elapsed_minutes) == ("BREACHED", 43200.0) and long.remaining_minutes < 0
    assert zero.consumption_ratio == 5.0
    (custom,) = states(spark, [(START, START + timedelta(minutes=72), 100)], warn=0.7, breach=0.9)
    assert custom.sla_status == "AT_RISK"
    (never,) = states(spark, [(START, START, 100)], warn=0.0, breach=2.0)
    assert never.sla_status == "AT_RISK"


# Band per case.
BANDS = [
    ("BREACHED", 1.5, -30.0, "Enterprise", 200000.0, 10.0, "Critical", "P1"),
    ("AT_RISK", 0.95, 5.0, "Enterprise", 150000.0, 6.0, "Critical", "P1"),
    ("AT_RISK", 0.88, 12.0, "Enterprise", 80000.0, 4.0, "High", "P2"),
    ("BREACHED", 1.1, -10.0, "Commercial", 50000.0, 8.0, "High", "P2"),
    ("AT_RISK", 0.82, 18.0, "Commercial", 40000.0, 3.0, "High", "P2"),
    ("ON_TRACK", 0.70, 30.0, "Enterprise", 60000.0, 2.0, "High", "P2"),
    ("BREACHED", 1.05, -5.0, "Retail", 15000.0, 5.0, "Critical", "P2"),
    ("AT_RISK", 0.85, 15.0, "Commercial", 20000.0, 2.0, "Medium", "P3"),
    ("ON_TRACK", 0.60, 40.0, "Commercial", 25000.0, 2.0, "Medium", "P3"),
    ("ON_TRACK", 0.40, 60.0, "Enterprise", 10000.0, 1.0, "Medium", "P3"),
    ("ON_TRACK", 0.50, 50.0, "Retail", 5000.0, 3.0, "High", "P4"),
    ("AT_RISK", 0.80, 20.0, "Retail", 1000.0, 1.0, "Low", "P3"),
    ("ON_TRACK", 0.30, 70.0, "Commercial", 3000.0, 1.0, "Low", "P4"),
    ("ON_TRACK", 0.20, 80.0, "Retail", 500.0, 0.5, "Low", "P4"),
    ("ON_TRACK", 0.10, 90.0, "Retail", 100.0, 0.2, "Low", "P4"),
    ("ON_TRACK", 0.05, 95.0, "Retail", 50.0, 0.1, "Low", "P4"),
    ("ON_TRACK", 0.0, 100.0, "Retail", 10.0, 0.0, "Low", "P4"),
    ("ON_TRACK", 0.15, 85.0, "Commercial", 100.0, 0.2, "Low", "P4"),
    ("ON_TRACK", 0.25, 75.0, "Retail", 200.0, 0.5, "Low", "P4"),
    ("BREACHED", 1.02, -2.0, "Retail", 50.0, 0.1, "Low", "P3"),
]
CASE = (
    "sla_status string, consumption_ratio double, remaining_minutes double, tier string, "
    "financial_exposure double, unassigned_hours double, severity string"
)


def test_priority_bands(spark):
    df = spark.createDataFrame([b[:-1] for b in BANDS], CASE)
    got = R.with_priority(df).collect()
    assert [g.priority_band for g in got] == [b[-1] for b in BANDS]
    assert all(0 <= g.priority_score <= 100 for g in got)


# Reason texts per case.
DRIVERS = [
    (("BREACHED", 1.2, -15.5, "Retail", 100.0, 0.0, "Low"), ["SLA breached (overdue by 15.5 min)"]),
    (("AT_RISK", 0.85, 12.4, "Retail", 100.0, 0.0, "Low"), ["SLA breach imminent in 12.4 minutes"]),
    (("ON_TRACK", 0.1, 100.0, "Enterprise", 100.0, 0.0, "Low"), ["Tier 1 Enterprise customer account"]),
    (("ON_TRACK", 0.1, 100.0, "Retail", 75000.0, 0.0, "Low"), ["High financial exposure ($75,000.00)"]),
    (
        ("ON_TRACK", 0.1, 100.0, "Retail", 100.0, 8.5, "Low"),
        ["Unassigned waiting time (8.5 hrs) exceeds SLA triage standard"],
    ),
    (("ON_TRACK", 0.1, 100.0, "Retail", 100.0, 0.0, "Critical"), ["Mission-critical service failure"]),
    (("ON_TRACK", 0.1, 100.0, "Retail", 100.0, 0.0, "Low"), ["Standard operational queue ranking"]),
    (
        ("BREACHED", 9.0, -1234.25, "enterprise plus", 25000.0, 4.0, "critical"),
        [
            "SLA breached (overdue by 1234.2 min)",
            "Tier 1 Enterprise customer account",
            "High financial exposure ($25,000.00)",
            "Unassigned waiting time (4.0 hrs) exceeds SLA triage standard",
            "Mission-critical service failure",
        ],
    ),
]


def test_priority_drivers(spark):
    got = R.with_priority(spark.createDataFrame([d[0] for d in DRIVERS], CASE)).collect()
    assert [g.reason_drivers for g in got] == [d[1] for d in DRIVERS]


def test_priority_weights_and_clamps(spark):
    df = spark.createDataFrame(
        [
            ("BREACHED", 5.0, -1000.0, "Enterprise", 1e7, 100.0, "Critical"),
            ("ON_TRACK", 0.0, 100.0, "Retail", 0.0, 0.0, "Low"),
        ],
        CASE,
    )
    with pytest.raises(ValueError):
        R.with_priority(df, {"sla": 0.5, "customer": 0.5, "financial": 0.5, "age": 0.1, "criticality": 0.1})
    with pytest.raises(ValueError):
        R.with_priority(df, {"speed": 0.0})
    top, low = R.with_priority(df).collect()
    assert (top.priority_score, top.priority_band) == (100.0, "P1")
    assert low.priority_score >= 0 and low.priority_band == "P4"
    equal = {name: 0.2 for name in R.WEIGHTS}
    assert R.with_priority(df, equal).collect()[1].priority_score == round(0.2 * 30 + 0.2 * 10, 2)


def test_round_binary_is_python_round(spark):
    rng = random.Random(3)
    xs = [rng.randrange(0, 10**6) / 1000 for _ in range(3000)]
    xs += [rng.random() * 100 for _ in range(3000)] + [k / 200 for k in range(-2000, 4000)]
    xs += [k / 8 for k in range(2000)] + [0.0, 44.714999999999996, 2.675, 1.005, 1234567.125]
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    for digits in (1, 2, 4):
        got = df.select("x", round_binary(F.col("x"), digits).alias("y")).collect()
        assert [(r.x, r.y) for r in got if r.y != round(r.x, digits)] == []


def test_integer_ratios(spark):
    df = spark.createDataFrame([(3, 7), (0, 5), (1, 0), (1, 8), (10**12, 3 * 10**12)], "a long, b long")
    got = [r[0] for r in df.select(percent(F.col("a"), F.col("b"))).collect()]
    assert got == [42.86, 0.0, None, 12.5, 33.33]
    sums = spark.createDataFrame([(-25, 10), (25, 10), (1, 800), (9 * 10**16, 10**12)], "a long, b long")
    got = [r[0] for r in sums.select(mean2(F.col("a"), F.col("b"))).collect()]
    assert got == [-2.5, 2.5, 0.0, 90000.0]


def test_keys_team_and_exposure(spark):
    df = spark.createDataFrame(
        [("EVT-00000007", "Enterprise", "Payment Gateway"), ("X-1", "Commercial", "payment"), ("X-2", "Retail", None)],
        "event_id string, tier string, service_name string",
    )
    rows = df.select(
        R.sla_id(F.col("event_id")).alias("sla"),
        R.exception_id(F.col("event_id")).alias("exc"),
        R.case_id(F.col("event_id")).alias("case"),
        R.assigned_team(F.col("service_name")).alias("team"),
        R.exposure_fallback(F.col("tier"), F.col("event_id")).alias("usd"),
    ).collect()
    assert (rows[0].sla, rows[0].exc, rows[0].case) == ("SLA-00000007", "EXC-00000007", "CASE-EVT-00000007")
    assert [r.team for r in rows] == ["Payment Operations", "Core Infrastructure", "Core Infrastructure"]
    assert 50000 <= rows[0].usd <= 250000 and 5000 <= rows[1].usd <= 45000 and 200 <= rows[2].usd <= 4000
