"""Queue order, pages and filters."""

import pytest
from pyspark.sql import functions as F

from opsloom.operators import triage as Tr

# Pushed scores and their order.
ORDERS = [
    ([10, 20, 30, 40, 50], [50, 40, 30, 20, 10]),
    ([50, 40, 30, 20, 10], [50, 40, 30, 20, 10]),
    ([15, 95, 45, 85, 25], [95, 85, 45, 25, 15]),
    ([88.8, 12.3, 99.9, 0.1], [99.9, 88.8, 12.3, 0.1]),
    ([100.0, 100.0, 50.0], [100.0, 100.0, 50.0]),
]
ITEM = "exception_id string, priority_score double, version long"


def items(spark, scores):
    return spark.createDataFrame([(f"EXC-{i}", None if s is None else float(s), i) for i, s in enumerate(scores)], ITEM)


@pytest.mark.parametrize("scores,expected", ORDERS)
def test_queue_order(spark, scores, expected):
    got = [r.priority_score for r in Tr.triage_queue(items(spark, scores)).collect()]
    assert got == expected


def test_queue_edges(spark):
    empty = items(spark, [])
    assert Tr.peek(empty).collect() == [] and Tr.take(empty, 1)[0].collect() == []
    one = items(spark, [85])
    assert Tr.peek(one).first().exception_id == "EXC-0"
    ties = [r.exception_id for r in Tr.triage_queue(items(spark, [7, 7, 7])).collect()]
    assert ties == ["EXC-0", "EXC-1", "EXC-2"]


def test_last_push_wins_also_downwards(spark):
    rows = [("A", 50.0, 1), ("B", 70.0, 2), ("A", 99.0, 3)]
    df = spark.createDataFrame(rows, ITEM)
    assert Tr.peek(df, "version").first().priority_score == 99.0
    lower = df.union(spark.createDataFrame([("A", 1.0, 4)], ITEM))
    assert [r.exception_id for r in Tr.triage_queue(lower, "version").collect()] == ["B", "A"]


@pytest.mark.parametrize("n", [0, 1, 3, 5, 9, 1_000_000])
def test_take_leaves_the_rest(spark, n):
    queue = items(spark, [5, 1, 9, 7, 9, None, 7.04, 7.06, float("nan"), -3, 250])
    first, rest = ([r.exception_id for r in part.collect()] for part in Tr.take(queue, n))
    assert first + rest == [r.exception_id for r in Tr.triage_queue(queue).collect()]
    assert len(first) == min(n, 11)
    assert [r.exception_id for r in Tr.take(queue.limit(0), n)[0].collect()] == []


def exceptions(spark, n=60):
    bands, states = ["P1", "P2", "P3"], ["DETECTED", "CLOSED"]
    rows = [
        (f"EXC-{i:03d}", f"CASE-{i}", f"E{i}", "C1", f"S{i % 2}", f"L{i % 5}", 1.0, float(i % 7), bands[i % 3], states[i % 2], ["x"], None, "T")
        for i in range(n)
    ]
    return spark.createDataFrame(
        rows,
        "exception_id string, case_id string, event_id string, customer_id string, service_id string, "
        "location_id string, financial_exposure double, priority_score double, priority_band string, "
        "lifecycle_state string, reason_drivers array<string>, created_at timestamp, assigned_team string",
    )


@pytest.mark.parametrize("limit,offset", [(10, 0), (10, 7), (5, 58), (5, 500), (500, 0)])
def test_pages(spark, limit, offset):
    total, page = Tr.exception_page(exceptions(spark), limit, offset)
    order = sorted(range(60), key=lambda i: (-(i % 7), i))
    assert total.first().total == 60
    assert [r.id for r in page.collect()] == [f"EXC-{i:03d}" for i in order[offset : offset + limit]]


def test_page_filters(spark):
    def ids(**f):
        total, page = Tr.exception_page(exceptions(spark), 500, 0, **f)
        rows = page.collect()
        assert total.first().total == len(rows)
        return {int(r.id[4:]) for r in rows}

    assert ids(priority="p1") == {i for i in range(60) if i % 3 == 0}
    assert ids(status="closed", service="S1") == {i for i in range(60) if i % 2 == 1}
    assert ids(location="L2", priority="P2") == {i for i in range(60) if i % 5 == 2 and i % 3 == 1}
    assert ids(location="l2") == set() and ids(status="NOPE") == set()


@pytest.mark.parametrize("limit,offset", [(0, 0), (501, 0), (10, -1)])
def test_page_bounds(spark, limit, offset):
    with pytest.raises(ValueError):
        Tr.exception_page(exceptions(spark), limit, offset)


def test_other_filters(spark):
    exc = exceptions(spark)
    assert Tr.active_backlog(exc).count() == 30
    assert [r.priority_score for r in Tr.top_p1(exc, 3).collect()] == [6.0, 6.0, 6.0]
    table = exc.withColumn("service_category", F.lit("Payments"))
    assert Tr.slice_triage(table, bands=["P1", "P2"], states=["CLOSED"], categories=["Payments"]).count() == 20
    assert Tr.slice_triage(table, teams=["other"]).count() == 0
    with pytest.raises(ValueError):
        Tr.sla_risk(exc, 201)


def test_sla_risk(spark):
    spec = (
        "sla_id string, case_id string, customer_id string, service_id string, target_minutes int, "
        "elapsed_minutes double, remaining_minutes double, sla_status string, due_time timestamp"
    )
    rows = [
        ("S1", "C1", "c", "s", 60, 1.0, 59.0, "ON_TRACK", None),
        ("S2", "C2", "c", "s", 60, 55.0, 5.0, "AT_RISK", None),
        ("S3", "C3", "c", "s", 60, 90.0, -30.0, "BREACHED", None),
    ]
    got = Tr.sla_risk(spark.createDataFrame(rows, spec), 10).collect()
    assert [r.sla_id for r in got] == ["S3", "S2"]
