"""Sources, sinks and catalog in scratch folders."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from opsloom import schemas as S
from opsloom.operators import quality as Q
from opsloom.operators import reports as A
from opsloom.operators import triage as Tr
from opsloom.operators import windows as W
from opsloom.plans import ingest as G
from opsloom.plans.cases import detect_exceptions
from opsloom.sources import catalog as C
from opsloom.sources import lake as L
from opsloom.sources.raw import read_dimension, read_raw_events

ROWS = [
    {"event_id": "EVT-1", "timestamp": "2026-01-15T12:00:00+00:00", "customer_id": "C1", "service_id": "S1", "location_id": "L1", "event_type": "TEST", "duration_ms": 100, "payload_bytes": 5, "status_code": 200},
    {"event_id": "EVT-2", "timestamp": "2026-01-16T23:30:00-02:00", "customer_id": "C1", "service_id": "S1", "location_id": "L1", "event_type": "FAIL", "duration_ms": 2500, "payload_bytes": 5, "status_code": 500, "error_message": "Err"},
]


def write_lines(folder, rows, name="a.json"):
    Path(folder).mkdir(parents=True, exist_ok=True)
    Path(folder, name).write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows) + "\n")
    return folder


def raw(spark, scratch, rows=ROWS):
    return read_raw_events(spark, write_lines(f"{scratch}/raw", rows))


def partitions_read(df) -> str:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("PartitionFilters: [")[1].split("]")[0]


def test_lake_round_trip_and_pruning(spark, scratch):
    L.write_event_lake(raw(spark, scratch), f"{scratch}/lake")
    lake = L.read_event_lake(spark, f"{scratch}/lake")
    assert lake.schema == S.LAKE_EVENT
    assert tuple(A.scan_profile(lake).first()) == (2, 1300.0)
    assert Path(f"{scratch}/lake/year=2026/month=01/day=17").is_dir()  # 23:30-02:00 is the next day in UTC
    day = Tr.partition_range(lake, "2026", "01", "17", "17")
    row = day.first()
    assert (row.event_id, row.hour, row.day_of_week, row.is_weekend) == ("EVT-2", 1, "Saturday", True)
    assert "day#" in partitions_read(day)
    narrow = A.hourly_trend(lake)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<status_code:bigint,hour:int>" in narrow
    recent = Tr.recent(lake, "timestamp", "2026-01-17 02:00:00", 24)
    assert "year#" in partitions_read(recent) and [r.event_id for r in recent.collect()] == ["EVT-2"]
    window = W.window_metrics(lake, "timestamp", F.col("status_code") >= 500, "2026-01-17 02:00:00")
    assert tuple(window.first()) == (60, 1, 1, 100.0)
    dates = A.daily_summary(lake)
    assert "timestamp" not in dates._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]
    assert sorted(str(r.event_date) for r in dates.collect()) == ["2026-01-15", "2026-01-17"]


def test_whole_day_rerun_replaces_and_partial_batch_appends(spark, scratch):
    path = f"{scratch}/lake"
    batch = raw(spark, scratch)
    for _ in range(2):
        L.write_event_lake(batch, path, whole_days=True)
        assert L.read_event_lake(spark, path).count() == 2
    late = [{**ROWS[0], "event_id": "EVT-3"}, ROWS[0], {**ROWS[0], "event_id": "EVT-3"}]
    for _ in range(2):
        L.write_event_lake(read_raw_events(spark, write_lines(f"{scratch}/late", late)), path)
        ids = sorted(r.event_id for r in L.read_event_lake(spark, path).collect())
        assert ids == ["EVT-1", "EVT-2", "EVT-3"]
    fresh = f"{scratch}/fresh"
    L.write_event_lake(batch, fresh)
    assert L.read_event_lake(spark, fresh).count() == 2


def test_parts_and_moved_ids_lose_and_double_nothing(spark, scratch):
    path = f"{scratch}/lake"
    L.write_event_lake(raw(spark, scratch), path)
    moved = [{**ROWS[0], "timestamp": "2026-01-18T10:00:00Z"}, {**ROWS[0], "event_id": "EVT-9"}]
    L.write_event_lake(read_raw_events(spark, write_lines(f"{scratch}/moved", moved)), path)
    assert sorted(r.event_id for r in L.read_event_lake(spark, path).collect()) == ["EVT-1", "EVT-2", "EVT-9"]


def test_of_a_repeated_id_the_first_row_is_kept(spark, scratch):
    twice = [{**ROWS[0], "service_id": "Z"}, {**ROWS[0], "service_id": "A"}]
    L.write_event_lake(read_raw_events(spark, write_lines(f"{scratch}/twice", twice)), f"{scratch}/lake")
    assert [r.service_id for r in L.read_event_lake(spark, f"{scratch}/lake").collect()] == ["Z"]


def test_batch_jobs_may_run_again(spark, sf, scratch):
    from opsloom.plans import ingest as G
    from opsloom.sources import binding as B

    zones, s = G.Zones.below(scratch), B.bind_star(spark, sf)

    def run(events):
        G.ingest(B.bind_dirty_events(events), zones, B.DIRTY_AS_OF, s.customers, s.services, s.locations)
        return L.read_event_lake(spark, zones.lake).count(), spark.read.parquet(zones.quarantine).count()

    first = run(s.events)
    assert run(s.events) == first

    def cases():
        G.build_cases(spark, L.read_event_lake(spark, zones.lake), zones, s.customers, s.services, "2030-01-01")
        return L.read_sla(spark, zones.cases).count(), L.read_exceptions(spark, zones.cases).count()

    built = cases()
    assert built[0] == built[1] > 0 and cases() == built
    # A run that ended between the two writes: the exceptions are missing.
    whole = L.read_exceptions(spark, zones.cases).collect()
    spark.createDataFrame(whole[:5], S.EXCEPTION_RECORD).write.mode("overwrite").option(
        "partitionOverwriteMode", "static"
    ).parquet(f"{zones.cases}/fact_exception")
    assert cases() == built


def test_empty_batch_leaves_the_lake_alone(spark, scratch):
    path = f"{scratch}/lake"
    batch = raw(spark, scratch)
    L.write_event_lake(batch, path)
    L.write_event_lake(batch.where("false"), path)
    assert L.read_event_lake(spark, path).count() == 2


def test_raw_formats(spark, scratch):
    lines = [*ROWS, "{broken", {**ROWS[0], "event_id": None}]
    got = raw(spark, scratch, lines).orderBy("seq").collect()
    assert [r.event_id for r in got] == ["EVT-1", "EVT-2", None, None]
    assert [r._corrupt_record for r in got] == [None, None, "{broken", None]
    array = f"{scratch}/array"
    write_lines(array, [json.dumps(ROWS, indent=1)])
    assert read_raw_events(spark, array, multi_line=True).count() == 2
    dated = write_lines(f"{scratch}/dated/year=2026/month=01/day=15", ROWS)
    assert read_raw_events(spark, str(Path(dated).parents[2])).columns == [*S.RAW_EVENT.names, "_corrupt_record", "seq"]
    write_lines(f"{scratch}/dated/year=2026/month=01/day=16", ROWS[:1])
    def dated_rows(*days):
        return read_raw_events(spark, f"{scratch}/dated", days=days)

    assert [dated_rows("2026-01-15", d).count() for d in ("2026-01-15", "2026-01-16", "2026-01-14")] == [2, 3, 0]
    assert dated_rows("2026-01-16", "2026-01-16").columns == [*S.RAW_EVENT.names, "_corrupt_record", "seq"]
    columns = S.RAW_EVENT.names
    text = [",".join(columns)] + [",".join(str(r.get(c, "")) for c in columns) for r in ROWS]
    csv = read_raw_events(spark, write_lines(f"{scratch}/csv", text, "a.csv"), "csv").orderBy("seq").collect()
    assert [(r.event_id, r.status_code, r.error_message) for r in csv] == [("EVT-1", 200, None), ("EVT-2", 500, "Err")]
    with pytest.raises(ValueError):
        read_raw_events(spark, array, "xml")


def test_file_order_decides_the_first_occurrence(spark, scratch):
    folder = f"{scratch}/raw"
    write_lines(folder, [{**ROWS[0], "service_id": "first"}, ROWS[1]], "a.json")
    write_lines(folder, [{**ROWS[0], "service_id": f"later{i}"} for i in range(50)], "b.json")
    flagged = Q.validate_events(read_raw_events(spark, folder), "2027-01-01")
    valid, rejected = Q.route(flagged)
    assert sorted(r.service_id for r in valid.collect()) == ["S1", "first"]
    assert rejected.count() == 50


def test_dimensions(spark, scratch):
    missing = read_dimension(spark, f"{scratch}/none", S.CUSTOMER)
    assert missing.count() == 0 and missing.schema == S.CUSTOMER
    write_lines(f"{scratch}/c", [json.dumps([{"customer_id": "C1", "tier": "Retail"}])])
    customers = read_dimension(spark, f"{scratch}/c", S.CUSTOMER)
    assert customers.first().customer_id == "C1"
    L.write_dimensions({"dim_customers": customers}, f"{scratch}/out")
    assert read_dimension(spark, f"{scratch}/out/dim_customers", S.CUSTOMER, "parquet").count() == 1


def test_ingest_job(spark, scratch):
    bad = [{**ROWS[0], "event_id": "EVT-9", "status_code": 999, "duration_ms": -1}, {**ROWS[1]}]
    zones = G.Zones.below(f"{scratch}/zones")
    assert L.read_dq_metrics(spark, zones.metrics).first().status == "NO_METRICS_LOGGED"
    G.ingest(raw(spark, scratch, [*ROWS, *bad]), zones, "2027-01-01 10:00:00")
    assert L.read_event_lake(spark, zones.lake).count() == 2
    held = spark.read.parquet(zones.quarantine).orderBy("raw_record.event_id").collect()
    assert [(r.raw_record.event_id, r.rejection_reasons) for r in held] == [
        ("EVT-2", [S.ERR_DUPLICATE_ID]),
        ("EVT-9", [S.ERR_NEGATIVE_DURATION, S.ERR_INVALID_STATUS_CODE]),
    ]
    assert {(r.year, r.month, r.day) for r in held} == {(2027, 1, 1)}
    m = L.read_dq_metrics(spark, zones.metrics).first()
    assert (m.rows_processed, m.rows_valid, m.rows_rejected, m.acceptance_rate_pct) == (4, 2, 2, 50.0)
    assert m.error_distribution.ERR_DUPLICATE_ID == 1


def test_case_job_is_incremental(spark, scratch):
    events = L.conform_events(raw(spark, scratch))
    customers = spark.createDataFrame([("C1", "n", "Enterprise", "Gold", "i")], S.CUSTOMER)
    services = spark.createDataFrame([], S.SERVICE)
    zones = G.Zones.below(scratch)
    G.build_cases(spark, events, zones, customers, services, "2026-01-17 02:30:00")
    exc = L.read_exceptions(spark, zones.cases)
    (row,) = exc.collect()
    assert (row.exception_id, row.case_id, row.lifecycle_state) == ("EXC-2", "CASE-EVT-2", "DETECTED")
    (sla,) = L.read_sla(spark, zones.cases).collect()
    assert (sla.target_minutes, sla.elapsed_minutes, sla.sla_status) == (120, 60.0, "ON_TRACK")
    assert Path(f"{zones.cases}/fact_sla_record/year=2026/month=01").is_dir()
    again = G.build_cases(spark, events, zones, customers, services, "2026-01-18", known=exc)
    assert again.count() == 0 and L.read_exceptions(spark, zones.cases).count() == 1
    limited = G.score_cases(events, customers, services, "2026-01-18", limit=1, existing=exc.where("false"))
    assert limited.count() == 1


def test_detected_records_have_the_declared_types(spark, scratch):
    events = L.conform_events(raw(spark, scratch))
    none = spark.createDataFrame([], S.CUSTOMER), spark.createDataFrame([], S.SERVICE)
    sla, exceptions = detect_exceptions(events, *none, "2026-01-18 00:00:00")
    for df, declared in ((sla, S.SLA_RECORD), (exceptions, S.EXCEPTION_RECORD)):
        assert df.dtypes == [(f.name, f.dataType.simpleString()) for f in declared]
    (row,) = exceptions.collect()
    assert 200 <= row.financial_exposure <= 4000 and row.created_at == row.updated_at
    assert sla.first().target_minutes == 120


def test_incremental_loads(spark):
    target = spark.createDataFrame([("a", "old")], "customer_id string, industry string")
    incoming = spark.createDataFrame(
        [("a", "new", 1), ("b", "second", 3), ("b", "first", 2)], "customer_id string, industry string, seq long"
    )
    got = L.insert_if_absent(target, incoming, "customer_id", "seq")
    assert [tuple(r) for r in got.collect()] == [("b", "first")]
    events = spark.createDataFrame(
        [("e1", "2026-01-01T00:00:00", 1), ("e2", "2026-01-01T01:00:00+01:00", 2)],
        "event_id string, timestamp string, seq long",
    )
    new = L.append_new_events(spark.createDataFrame([("e1",)], "event_id string"), events)
    assert new.schema.names == S.EVENT.names
    row = new.first()
    assert row.event_id == "e2" and row.duration_ms is None and str(row.timestamp).startswith("2026-01-01 00:00")


def test_views_and_catalog(spark, scratch):
    batch = raw(spark, scratch)
    L.write_event_lake(batch, f"{scratch}/{C.FACT}")
    dims = {
        "dim_customers": spark.createDataFrame([("C1", "n", "Retail", "Bronze", "i")], S.CUSTOMER),
        "dim_services": spark.createDataFrame([("S1", "s", "c", 1, 60), ("S2", "t", "c", 1, 60)], S.SERVICE),
        "dim_locations": spark.createDataFrame([("L1", "EU", "z", "DE")], S.LOCATION),
    }
    L.write_dimensions(dims, scratch)
    C.register_views(spark, scratch)
    rates = spark.sql("SELECT service_id, error_rate_pct FROM vw_service_reliability_summary").collect()
    assert [tuple(r) for r in rates] == [("S1", 50.0), ("S2", None)]
    assert spark.sql("SELECT failure_rank FROM vw_location_bottlenecks").first()[0] == 1
    db = "ops_test_" + Path(scratch).name.replace("-", "_").lower()
    for _ in range(2):
        C.create_catalog(spark, db, scratch)
    table = f"{db}.{C.FACT}"
    assert spark.table(table).count() == 0
    C.repair_partitions(spark, table)
    assert spark.table(table).count() == 2
    assert "day#" in partitions_read(spark.table(table).where("day = '15'"))
    for _ in range(2):
        C.build_aggregate_tables(spark, db, scratch)
    assert spark.table(f"{db}.agg_daily_operational_summary").count() == 2
    assert spark.table(f"{db}.agg_customer_incident_profile").first().critical_failures == 1
    more = [{**ROWS[0], "event_id": "EVT-7", "timestamp": "2026-03-01T00:00:00"}]
    L.write_event_lake(read_raw_events(spark, write_lines(f"{scratch}/more", more)), f"{scratch}/{C.FACT}")
    C.repair_partitions(spark, table)
    assert spark.table(table).where(F.col("month") == "03").count() == 1


def test_a_batch_at_two_clocks_replaces_its_quarantine(spark, scratch):
    zones = G.Zones.below(f"{scratch}/zones")
    soon = {**ROWS[0], "event_id": "EVT-7", "timestamp": "2026-02-01T00:00:00+00:00"}
    bad = {**ROWS[0], "event_id": "EVT-8", "duration_ms": -1}
    batch = raw(spark, scratch, [*ROWS, soon, bad])
    counts = []
    for clock in ("2026-01-20 00:00:00", "2026-03-01 00:00:00"):
        G.ingest(batch, zones, clock)
        held = spark.read.parquet(zones.quarantine)
        counts.append((L.read_event_lake(spark, zones.lake).count(), sorted(r.raw_record.event_id for r in held.collect())))
    assert counts == [(2, ["EVT-7", "EVT-8"]), (3, ["EVT-8"])]


def test_ingest_deals_a_single_split_over_the_tasks(spark, sf, scratch, monkeypatch):
    """One file of one row group is read by one task; the rules must not run in that one alone."""
    from opsloom.plans import ingest as G
    from opsloom.sources import binding as B

    dirty = B.bind_dirty_events(B.bind_events(B.table(spark, sf, "events"))).coalesce(1)
    files, real, name = {}, G.staged, "spark.sql.adaptive.coalescePartitions.enabled"

    def noted(df, kind, *rest):
        table = real(df, kind, *rest)
        files[kind] = len(table.inputFiles())
        return table

    monkeypatch.setattr(G, "staged", noted)
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "false")
        metrics = G.ingest(dirty, G.Zones.below(f"{scratch}/zones"), B.DIRTY_AS_OF).first()
    finally:
        spark.conf.set(name, before)
    assert files["raw"] > 1 and metrics.rows_processed == dirty.count() == 1000
