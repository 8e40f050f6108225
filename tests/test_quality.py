"""Data-quality rules on one-row cases and small tables."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from opsloom import schemas as S
from opsloom.functions.calendar import parse_iso
from opsloom.operators import quality as Q

AS_OF = "2026-02-01 00:00:00"
RAW = (
    "event_id string, timestamp string, customer_id string, service_id string, location_id string, "
    "event_type string, duration_ms long, payload_bytes long, status_code long, error_message string, seq long"
)
GOOD = {
    "event_id": "EVT-1",
    "timestamp": "2026-01-15T12:00:00+00:00",
    "customer_id": "CUST-001",
    "service_id": "SRV-001",
    "location_id": "LOC-001",
    "event_type": "TEST",
    "duration_ms": 100,
    "payload_bytes": 500,
    "status_code": 200,
    "error_message": None,
}


def raw(spark, changes):
    rows = [{**GOOD, "event_id": f"EVT-{i}", **c, "seq": i} for i, c in enumerate(changes)]
    return spark.createDataFrame([tuple(r[n] for n in [*GOOD, "seq"]) for r in rows], RAW)


def dims(spark, empty=()):
    def ids(prefix, name):
        rows = [] if name in empty else [(f"{prefix}-001",), (f"{prefix}-002",)]
        return spark.createDataFrame(rows, f"{name} string")

    return ids("CUST", "customer_id"), ids("SRV", "service_id"), ids("LOC", "location_id")


def reasons(spark, changes, empty=(), **hot):
    flagged = Q.validate_events(raw(spark, changes), AS_OF, *dims(spark, empty), **hot)
    return [r.rejection_reasons for r in flagged.orderBy("seq").collect()]


NULL, DUP = S.ERR_NULL_MANDATORY, S.ERR_DUPLICATE_ID
# A changed field and the codes it must raise.
ROW_CASES = [
    *[({"status_code": c}, []) for c in (100, 200, 201, 400, 404, 500, 503, 599)],
    *[({"status_code": c}, [S.ERR_INVALID_STATUS_CODE]) for c in (99, 600, 999, -1, None)],
    *[({"duration_ms": d}, []) for d in (0, 1, 500, 15000, None)],
    *[({"duration_ms": d}, [S.ERR_NEGATIVE_DURATION]) for d in (-1, -500, -99999)],
    *[({k: None}, [NULL]) for k in ("customer_id", "service_id", "location_id", "timestamp")],
    *[({k: ""}, [NULL]) for k in ("customer_id", "service_id", "location_id", "timestamp")],
    ({"event_id": None}, [NULL]),
    ({"event_id": ""}, [NULL]),
    ({"event_id": None, "customer_id": None}, [NULL, NULL]),
    ({"customer_id": "CUST-999"}, [S.ERR_FK_CUSTOMER_ORPHAN]),
    ({"service_id": "SRV-999"}, [S.ERR_FK_SERVICE_ORPHAN]),
    ({"location_id": "LOC-999"}, [S.ERR_FK_LOCATION_ORPHAN]),
    ({"timestamp": "not-a-valid-timestamp"}, [S.ERR_INVALID_TIMESTAMP]),
    ({"timestamp": "2026-02-03T00:00:00+00:00"}, [S.ERR_FUTURE_TIMESTAMP]),
    ({"timestamp": "2026-02-01T00:00:00"}, []),
    (
        {"customer_id": "CUST-999", "status_code": 999, "duration_ms": -50},
        [S.ERR_NEGATIVE_DURATION, S.ERR_INVALID_STATUS_CODE, S.ERR_FK_CUSTOMER_ORPHAN],
    ),
]


def test_row_rules(spark):
    got = reasons(spark, [c for c, _ in ROW_CASES])
    assert list(zip([c for c, _ in ROW_CASES], got)) == ROW_CASES


def test_empty_or_absent_dimension_switches_its_check_off(spark):
    change = [{"customer_id": "CUST-999", "service_id": "SRV-999"}]
    assert reasons(spark, change, empty=("customer_id",)) == [[S.ERR_FK_SERVICE_ORPHAN]]
    flagged = Q.validate_events(raw(spark, change), AS_OF)
    assert flagged.first().rejection_reasons == []


@pytest.mark.parametrize("hot_rows", [1, 3, 10**6])
def test_first_occurrence_claims_the_id(spark, hot_rows):
    """Also when the id is hot, and also when the claiming row is itself rejected."""
    changes = [{"event_id": "A", "status_code": 999}, {"event_id": "A"}, {"event_id": "B"}]
    changes += [{"event_id": "A"}] * 4 + [{"event_id": None}] * 3 + [{"event_id": "B"}, {"event_id": "C"}]
    got = reasons(spark, changes, hot_rows=hot_rows)
    assert got[0] == [S.ERR_INVALID_STATUS_CODE]
    assert got[1] == [DUP] and got[2] == [] and got[3:7] == [[DUP]] * 4
    assert got[7:10] == [[NULL]] * 3 and got[10] == [DUP] and got[11] == []


def test_duplicates_over_all_state_columns(spark):
    df = spark.createDataFrame(
        [("a", "x", 1), ("a", "y", 2), ("a", "x", 3)], "event_id string, state string, seq long"
    )
    got = Q.mark_duplicates(df, ["event_id", "state"], "seq", flag="dup").orderBy("seq").collect()
    assert [r.dup for r in got] == [False, False, True]


ISO = [
    "2026-01-15T12:00:00+00:00", "2026-01-15T12:00:00", "2026-01-15 12:00", "2026-01-15", "2026-01-15T12",
    "2026-01-15T12:00:00Z", "2026-01-15T12:00:00.5", "2026-01-15T12:00:00.123456+05:30", "2026-01-15T12:00:00,25",
    "2026-01-15T12:00:00.1234567", "2026-01-15T12:00:00+0530", "2026-01-15x12:00:00", "2026-01-15T12-03:00",
    "2026", "2026-01", "12:00:00", " 2026-01-15", "2026-13-01", "2026-02-30", "2026-01-15T25:00:00",
    "2026-01-15T12:60:00", "not-a-ts", "2026-01-15T12:00:00 ", "2026-01-15T", "2026-1-5",
]


def test_iso_parsing_agrees_with_python(spark):
    def python(text):
        try:
            t = datetime.fromisoformat(text)
        except ValueError:
            return None
        t = t if t.tzinfo else t.replace(tzinfo=timezone.utc)
        return (t - datetime(1970, 1, 1, tzinfo=timezone.utc)).total_seconds()

    df = spark.createDataFrame([(t,) for t in ISO], "t string")
    got = df.select("t", (F.unix_micros(parse_iso(F.col("t"))) / 1e6).alias("s")).collect()
    assert {r.t: r.s for r in got} == {t: python(t) for t in ISO}


def test_routing_summary_and_distribution(spark):
    flagged = Q.validate_events(raw(spark, [c for c, _ in ROW_CASES]), AS_OF, *dims(spark))
    valid, rejected = Q.route(flagged)
    assert valid.columns == [*GOOD, "seq"]
    s = Q.dq_summary(flagged).first()
    assert (s.rows_processed, s.rows_valid + s.rows_rejected) == (len(ROW_CASES), len(ROW_CASES))
    assert (s.rows_valid, s.rows_rejected) == (valid.count(), rejected.count())
    assert s.acceptance_rate_pct == round(s.rows_valid / s.rows_processed * 100.0, 2)
    counts = {r.error_code: r.error_count for r in Q.error_distribution(flagged).collect()}
    want = {code: sum(r.count(code) for _, r in ROW_CASES) for code in S.REJECTION_CODES}
    assert counts == want and list(counts) == list(S.REJECTION_CODES)
    envelope = Q.quarantine_envelope(rejected, AS_OF)
    assert envelope.columns == ["raw_record", "rejection_reasons", "quarantined_at"]
    document = Q.dq_metrics(flagged).first()
    assert document.error_distribution.asDict() == want


def test_empty_batch(spark):
    flagged = Q.validate_events(raw(spark, []), AS_OF, *dims(spark))
    s = Q.dq_summary(flagged).first()
    assert tuple(s) == (0, 0, 0, 0.0)
    assert {r.error_count for r in Q.error_distribution(flagged).collect()} == {0}


def violations(spark, kind, spec, rows):
    df = spark.createDataFrame(rows, spec)
    return [r.violations for r in Q.with_violations(df, Q.contracts()[kind]).collect()]


def test_record_contracts(spark):
    services = [(1, 30), (2, 180), (3, 1440), (0, 60), (4, 60), (1, 0), (1, -10)]
    got = violations(spark, "service", "tier_level int, default_sla_minutes int", services)
    assert got == [[], [], [], ["tier_level"], ["tier_level"], ["default_sla_minutes"], ["default_sla_minutes"]]
    got = violations(spark, "agent", "skill_level int", [(1,), (3,), (5,), (0,), (6,), (None,)])
    assert got == [[], [], [], ["skill_level"], ["skill_level"], ["skill_level"]]
    tiers = [("Enterprise", "Gold"), ("Commercial", "Silver"), ("Retail", "Bronze"), ("Other", "Tin")]
    got = violations(spark, "customer", "tier string, contract_sla_tier string", tiers)
    assert got == [[], [], [], ["tier", "contract_sla_tier"]]
    spec = "financial_exposure double, priority_score double, priority_band string, lifecycle_state string"
    rows = [(50000.0, 88.5, "P1", "DETECTED"), (1.0, 150.0, "P1", "DETECTED"), (-1.0, 0.0, "P9", "GONE")]
    got = violations(spark, "exception", spec, rows)
    assert got == [[], ["priority_score"], ["financial_exposure", "priority_band", "lifecycle_state"]]
    report = Q.check_constraints(spark.createDataFrame(rows, spec), Q.contracts()["exception"])
    assert {r.rule: r.violations for r in report.collect()} == {
        "financial_exposure": 1, "priority_score": 1, "priority_band": 1, "lifecycle_state": 1,
    }


def test_assertions(spark):
    ev = spark.createDataFrame([("a", 1), ("a", -1), ("b", None)], "event_id string, duration_ms long")
    assert [tuple(r) for r in Q.assert_no_duplicate_ids(ev).collect()] == [("a", 2)]
    assert Q.assert_no_negative_duration(ev).first()[0] == 1
    exc = spark.createDataFrame([("a", 100.0), ("z", 100.01), ("b", -0.5)], "event_id string, priority_score double")
    assert Q.assert_no_orphan_exceptions(exc, ev).first()[0] == 1
    assert Q.assert_score_bounds(exc).first()[0] == 2


def test_transitions(spark):
    paths = {
        "ok": "DETECTED TRIAGED ASSIGNED TRIAGED ASSIGNED IN_PROGRESS ASSIGNED IN_PROGRESS RESOLVED IN_PROGRESS RESOLVED CLOSED",
        "false-positive": "DETECTED CLOSED",
        "jump": "DETECTED RESOLVED CLOSED",
        "after-close": "DETECTED CLOSED TRIAGED",
    }
    rows = []
    for case, path in paths.items():
        # Some changes share an instant, some are days apart.
        for i, state in enumerate(path.split()):
            at = datetime(2026, 1, 1 + i // 2 * 2, 0, 0, (i // 3), tzinfo=timezone.utc)
            rows.append((case, at, i, state))
    log = spark.createDataFrame(rows[::-1], "case_id string, changed_at timestamp, seq int, state string")
    got = {(r.case_id, r.from_state, r.to_state) for r in Q.illegal_transitions(log).collect()}
    assert got == {("jump", "DETECTED", "RESOLVED"), ("after-close", "CLOSED", "TRIAGED")}


def test_reconcile(spark):
    a = spark.createDataFrame([(1, 5), (2, 6), (None, 7), (4, None)], "k int, n int")
    b = spark.createDataFrame([(1, 5), (2, 9), (None, 7), (5, 1), (4, None)], "k int, n int")
    got = {r.k: (r.left_values, r.right_values) for r in Q.reconcile(a, b, ["k"]).collect()}
    assert set(got) == {2, 5}
    assert (got[2][0].n, got[2][1].n) == (6, 9) and got[5][0] is None


def test_injected_defects_are_repeatable_and_found(spark):
    clean = raw(spark, [{} for _ in range(3000)])
    def planted(seed):
        return Q.inject_defects(clean, 0.2, seed, AS_OF).orderBy("seq").collect()

    once, again, other = planted(7), planted(7), planted(8)
    assert once == again and once != other and len(once) == 3000
    flagged = Q.validate_events(Q.inject_defects(clean, 0.2, 7, AS_OF), AS_OF, *dims(spark))
    counts = {r.error_code: r.error_count for r in Q.error_distribution(flagged).collect()}
    used = {c for c, n in counts.items() if n}
    assert used == {
        DUP, NULL, S.ERR_FUTURE_TIMESTAMP, S.ERR_NEGATIVE_DURATION, S.ERR_INVALID_STATUS_CODE,
        S.ERR_FK_SERVICE_ORPHAN,
    }
    assert 400 < sum(counts.values()) < 800
