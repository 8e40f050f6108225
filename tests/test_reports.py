"""Reports on small tables and invariants between them."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from opsloom import schemas as S
from opsloom.operators import reports as A
from opsloom.operators import star as J
from opsloom.operators import triage as Tr
from opsloom.plans import registry
from opsloom.sources import binding as B

T0 = datetime(2026, 1, 15, 12, tzinfo=timezone.utc)


@pytest.fixture(scope="module")
def bound(spark, sf):
    return B.bind_star(spark, sf)


@pytest.fixture(scope="module")
def backlog(spark, sf):
    return registry.exceptions(spark, sf).persist(), registry.sla(spark, sf).persist()


def test_regression_counts(spark):
    """Known outcome on the 10,000-event tables."""
    sf = "/root/testdata/sf0.01"
    cases = registry.cases(spark, sf).persist()
    states = {r.sla_status: r["count"] for r in cases.groupBy("sla_status").count().collect()}
    bands = {r.priority_band: r["count"] for r in cases.groupBy("priority_band").count().collect()}
    tiers = {r.tier: r["count"] for r in cases.groupBy("tier").count().collect()}
    assert states == {"ON_TRACK": 1714, "BREACHED": 224, "AT_RISK": 76}
    assert bands == {"P1": 72, "P2": 241, "P3": 792, "P4": 909}
    assert tiers == {"Enterprise": 360, "Commercial": 805, "Retail": 849}
    errors = {r.error_code: r.error_count for r in registry.queries()["dq_errors"](spark, sf).collect()}
    assert errors == {
        "ERR_FK_LOCATION_ORPHAN": 740, "ERR_NULL_MANDATORY": 212, "ERR_FK_CUSTOMER_ORPHAN": 162,
        "ERR_INVALID_TIMESTAMP": 150, "ERR_FK_SERVICE_ORPHAN": 141, "ERR_INVALID_STATUS_CODE": 137,
        "ERR_NEGATIVE_DURATION": 127, "ERR_FUTURE_TIMESTAMP": 119, "ERR_DUPLICATE_ID": 102,
    }
    summary = registry.queries()["dq_summary"](spark, sf).first()
    assert (summary.rows_processed, summary.rows_valid) == (10000, 8237)


def test_views_of_the_same_events_agree(bound):
    total = A.scan_profile(bound.events).first().total_events
    hours = A.hourly_trend(bound.events).collect()
    assert sum(r.total_events for r in hours) == total and all(0 <= r.hour <= 23 for r in hours)
    by_service = A.service_reliability(bound.events, bound.services)
    assert by_service.agg(F.sum("total_events")).first()[0] == total
    rates = [r.error_rate_pct for r in by_service.collect()]
    known = [r for r in rates if r is not None]
    assert known == sorted(known, reverse=True) and rates[len(known) :] == [None] * (len(rates) - len(known))
    ranks = [r.failure_rank for r in A.location_bottlenecks(bound.events, bound.locations).collect()]
    assert ranks == sorted(ranks) and ranks[0] == 1 and set(ranks) == set(range(1, max(ranks) + 1))
    one = A.measures(events=bound.events).first()
    assert one.total_events == total and one.total_incidents == sum(r.error_events for r in hours)


def test_kpis_agree_with_lists(backlog):
    exceptions, sla = backlog
    k = A.summary_kpis(exceptions, sla).first()
    total, _ = Tr.exception_page(exceptions, 1)
    assert k.total_exceptions == total.first().total == sla.count()
    assert k.active_backlog == k.priority_queue_size == Tr.active_backlog(exceptions).count()
    assert k.sla_at_risk_count + k.sla_breached_count == Tr.at_risk_or_breached(sla).count()
    top = Tr.peek(Tr.active_backlog(exceptions)).first()
    assert k.highest_priority_exception.id == top.exception_id
    assert sum(r.exception_count for r in A.band_distribution(exceptions).collect()) == k.total_exceptions


def test_empty_backlog(spark):
    exceptions = spark.createDataFrame([], S.EXCEPTION_RECORD)
    sla = spark.createDataFrame([], S.SLA_RECORD)
    k = A.summary_kpis(exceptions, sla).first()
    assert (k.total_exceptions, k.sla_breach_rate_pct, k.highest_priority_exception) == (0, 0.0, None)
    m = A.measures(exceptions=exceptions, sla=sla).first()
    assert (m.active_backlog, m.total_financial_exposure, m.sla_compliance_rate_pct, m.error_rate_pct) == (0, 0.0, 100.0, 0.0)
    assert m.average_latency_ms is None
    assert [tuple(r) for r in A.band_distribution(exceptions).collect()] == [(b, 0) for b in S.PRIORITY_BANDS]


def test_measures_under_column_sets(bound):
    joined = J.star(bound.events, services=bound.services.select("service_id", "service_category", "tier_level"))
    by = ["service_category", "tier_level"]
    sets = A.measures(events=joined, by=by, sets=[["service_category"], []]).collect()
    plain = A.measures(events=joined, by=["service_category"]).collect()
    grand = [r for r in sets if r.grouping_id == 3]
    assert len(grand) == 1 and grand[0].total_events == 1000
    assert {r.service_category: r.total_events for r in sets if r.grouping_id == 1} == {
        r.service_category: r.total_events for r in plain
    }
    with pytest.raises(ValueError):
        A.measures()


def test_detail_of_one_exception(backlog, bound):
    exceptions, sla = backlog
    some = exceptions.first().exception_id
    (row,) = J.exception_detail(exceptions, bound.customers, bound.services, sla, some).collect()
    assert row.id == some and row.customer.name.startswith("Customer") and row.priority_drivers
    assert all(isinstance(d, str) and len(d) > 5 for d in row.priority_drivers)
    assert J.exception_detail(exceptions, bound.customers, bound.services, sla, "EXC-none").collect() == []
    (bare,) = J.exception_detail(
        exceptions, bound.customers.where("false"), bound.services.where("false"), sla.where("false"), some
    ).collect()
    assert (bare.customer.name, bare.customer.tier, bare.service.category) == ("Unknown", "Standard", "Operations")
    assert (bare.sla_status, bare.sla_remaining_minutes) == ("UNKNOWN", 0.0)


def test_defaults_for_unknown_dimension_rows(spark):
    events = spark.createDataFrame([("e", "c", "s", T0)], "event_id string, customer_id string, service_id string, timestamp timestamp")
    terms = J.with_case_terms(events, spark.createDataFrame([], S.CUSTOMER), spark.createDataFrame([], S.SERVICE)).first()
    assert (terms.tier, terms.default_sla_minutes, terms.service_name) == ("Retail", 120, None)


def test_dense_rank_on_ties(spark):
    df = spark.createDataFrame([("a", 5), ("b", 9), ("c", 5), ("d", 0)], "k string, n long")
    got = {r.k: r.rank for r in A.dense_rank_desc(df, "n", "rank").collect()}
    assert got == {"b": 1, "a": 2, "c": 2, "d": 3}


def test_recent(spark):
    df = spark.createDataFrame([(T0,), (datetime(2026, 1, 14, 11, tzinfo=timezone.utc),)], "ts timestamp")
    assert Tr.recent(df, "ts", "2026-01-15 12:00:00", 24).count() == 1
    assert Tr.recent(df, "ts", "2026-01-15 12:00:00", 7 * 24).count() == 2


def test_reports_do_not_shuffle_the_fact(bound):
    """Before the first exchange of the fact there is a partial aggregate."""
    plan = A.service_reliability(bound.events, bound.services)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "Exchange hashpartitioning(service_id" in plan
