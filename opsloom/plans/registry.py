"""The registered queries: every operator, bound to the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsloom import schemas as S
from opsloom.functions import calendar as cal
from opsloom.functions import rules as R
from opsloom.operators import impact as I
from opsloom.operators import quality as Q
from opsloom.operators import reports as A
from opsloom.operators import scale as Sc
from opsloom.operators import sketches as Sk
from opsloom.operators import star as J
from opsloom.operators import triage as Tr
from opsloom.operators import windows as Wn
from opsloom.plans import ingest as G
from opsloom.plans.cases import exception_records, open_cases, score_cases, sla_records
from opsloom.session import prepare, scratch_path
from opsloom.sources import binding as B
from opsloom.sources import catalog as C
from opsloom.sources import lake as L
from opsloom.sources.raw import read_dimension, read_raw_events
from opsloom.streaming import jobs as St

Query = Callable[[SparkSession, str], DataFrame]
TEAM_PATTERN = "widget"
AS_OF = "2024-01-15 12:00:00"


def shown(df: DataFrame) -> DataFrame:
    """Timestamps, dates and text lists as text, so both engines print them alike."""

    def cell(field: T.StructField):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.TimestampType):
            return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return F.date_format(c, "yyyy-MM-dd").alias(field.name)
        if isinstance(field.dataType, T.ArrayType):
            return F.array_join(c, " | ").alias(field.name)
        return c

    return df.select(*[cell(f) for f in df.schema.fields])


def is_failure():
    return F.col("status_code") >= 500


# --- bound inputs -------------------------------------------------------------------------------


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.bind_dirty_events(B.bind_events(B.table(spark, sf_dir, "events")))


def flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = B.bind_star(spark, sf_dir)
    return Q.validate_events(
        B.bind_dirty_events(s.events), B.DIRTY_AS_OF, s.customers, s.services, s.locations
    )


def cases(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    s = B.bind_star(spark, sf_dir)
    exposures = B.bind_exposures(B.table(spark, sf_dir, "orders"))
    return score_cases(
        s.events, s.customers, s.services, F.col("clock"), exposures=exposures, team_pattern=TEAM_PATTERN, **options
    )


def exceptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exceptions as the backlog holds them later: states spread over the lifecycle by event number."""
    number = F.substring("event_id", 5, 20).cast("long")
    states = F.array(*[F.lit(s) for s in S.LIFECYCLE_STATES])
    state = F.element_at(states, (number % len(S.LIFECYCLE_STATES) + 1).cast("int"))
    return exception_records(cases(spark, sf_dir)).withColumn("lifecycle_state", state)


def sla(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = B.bind_star(spark, sf_dir)
    return sla_records(open_cases(s.events, s.customers, s.services, F.col("clock")))


def transition_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.bind_transitions(B.table(spark, sf_dir, "orders"))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table, a file or a folder of part files, as a stream."""
    # A pattern names a single file as well as a folder of part files.
    return _file_stream(spark, f"{sf_dir}/[e]vents.parquet", maxFilesPerTrigger="1")


def _file_stream(spark: SparkSession, path: str, **options: str) -> DataFrame:
    prepare(spark)
    raw = spark.readStream.schema(B.TABLES["events"]).options(**options).parquet(path)
    return B.bind_events(raw)


DELIVERIES = 3


def _delivery_width(spark: SparkSession, sf_dir: str) -> tuple[int, int]:
    """(first instant, width of a delivery) in microseconds."""
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    first, last = B.table(spark, sf_dir, "events").agg(F.min(at), F.max(at)).first()
    return (0, 1) if first is None else (first, (last - first) // DELIVERIES + 1)


def deliver_events(spark: SparkSession, sf_dir: str, run: Callable[[DataFrame], object]) -> None:
    """Give all events to `run` as a stream of three deliveries, out of order.

    Each holds a third of the time range, but a fifth of the rows, and every row that repeats an id
    once it is made dirty, come one delivery late. `run` starts the stream's query, always with the
    same checkpoint, and ends when all that is there is done. A delivery is one batch, of however
    many files it is: a batch has a fixed cost, which would otherwise grow with the number of files.
    """
    path = scratch_path(spark, "deliveries")
    events, n = B.table(spark, sf_dir, "events"), F.col("event_id")
    first, width = _delivery_width(spark, sf_dir)
    block = F.floor((F.unix_micros(F.col("ts").cast("timestamp")) - first) / width).cast("int")
    moved = (n % 97 != 0) & ((n % 97 == 1) | (n % 5 == 2))
    part = F.least(block + moved.cast("int"), F.lit(DELIVERIES - 1))
    for i in range(DELIVERIES):
        events.where(part == i).write.mode("append").parquet(path)
        run(_file_stream(spark, path))


def _patience(spark: SparkSession, sf_dir: str) -> int:
    """Minutes a row of these deliveries is late at most: two deliveries, should one be several batches."""
    return 2 * _delivery_width(spark, sf_dir)[1] // 60_000_000 + 1


def days(lake: DataFrame) -> DataFrame:
    return lake.groupBy(*S.LAKE_PARTITIONS).agg(
        F.count(F.lit(1)).alias("total_events"), F.sum("duration_ms").alias("total_duration_ms")
    )


# --- event reports ------------------------------------------------------------------------------


def report(build: Callable[[B.Star], DataFrame]) -> Query:
    return lambda spark, sf_dir: shown(build(B.bind_star(spark, sf_dir)))


def error_rate_measures(spark, sf_dir):
    one = A.measures(events=B.bind_star(spark, sf_dir).events)
    return one.select("total_events", "total_incidents", "error_rate_pct", "average_latency_ms")


def _measures(spark, sf_dir, by, sets):
    s = B.bind_star(spark, sf_dir)
    customers = s.customers.select("customer_id", "tier")
    services = s.services.select("service_id", "service_category")
    return A.measures(
        J.star(s.events, customers, services),
        J.star(exceptions(spark, sf_dir), customers, services),
        J.star(sla(spark, sf_dir).withColumn("event_id", F.col("sla_id")), customers, services),
        by=by,
        sets=sets,
    )


EVENT_REPORTS: dict[str, Query] = {
    "service_reliability": report(lambda s: A.service_reliability(s.events, s.services)),
    "service_matrix": report(lambda s: A.service_matrix(s.events, s.services)),
    "location_bottlenecks": report(lambda s: A.location_bottlenecks(s.events, s.locations)),
    "tier_exposure": report(lambda s: A.tier_exposure(s.events, s.customers)),
    "hourly_trend": report(lambda s: A.hourly_trend(s.events)),
    "daily_summary": report(lambda s: A.daily_summary(s.events)),
    "customer_incident_profile": report(lambda s: A.customer_incident_profile(s.events, s.customers)),
    "incident_rate_by_day_service": report(
        lambda s: A.incident_rate_by_day_service(L.conform_events(s.events), "2024", "01", "15", "21")
    ),
    "latency_exact": report(lambda s: A.latency_distribution(s.events, s.customers, s.services, exact=True)),
    "latency_approx": report(lambda s: A.latency_distribution(s.events, s.customers, s.services)),
    "region_heatmap": report(lambda s: A.region_heatmap(s.events, s.locations)),
    "scan_profile": report(lambda s: A.scan_profile(s.events)),
    "error_rate_measures": error_rate_measures,
    "measures_rollup": partial(_measures, by=["tier", "service_category"], sets="rollup"),
    "measures_cube": partial(_measures, by=["tier", "service_category"], sets="cube"),
    "measures_by_tier": partial(_measures, by=["tier"], sets="plain"),
}


def ordered(name: str) -> Query:
    """A report with the place of each row in the order the report comes in."""
    return lambda spark, sf_dir: Sc.numbered(EVENT_REPORTS[name](spark, sf_dir))


ORDERED_REPORTS = (
    "service_reliability",
    "location_bottlenecks",
    "hourly_trend",
    "incident_rate_by_day_service",
    "latency_exact",
)
SKETCHED = {"p50_latency_ms": 0.5, **A.LATENCY_LEVELS}
RANK_TOLERANCE = 0.02


def latency_sketches(spark, sf_dir):
    """Stored sketches, one day of them written again, merged for a range of days.

    Estimates differ from run to run within the sketch's error, so the rows say whether their true
    ranks are within the tolerance.
    """
    s = B.bind_star(spark, sf_dir)
    keys = ["customer_tier"]
    tiers = s.customers.select("customer_id", F.col("tier").alias("customer_tier"), F.lit(True).alias("_c"))
    facts = J.star(
        s.events.select("event_id", "customer_id", "timestamp", "duration_ms"), tiers, spread_by=("event_id",)
    ).where("_c")
    path = scratch_path(spark, "latency-sketches")
    daily = Sk.daily_sketches(facts, keys)
    Sk.write_daily_sketches(daily, path)
    Sk.write_daily_sketches(daily.where(F.col(Sk.DAY) == "2024-01-16"), path)
    first, last = "2024-01-15", "2024-01-21"
    merged = Sk.merged_latency(Sk.read_daily_sketches(spark, path, first, last), keys, SKETCHED)
    inside = facts.where(F.to_date("timestamp").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    errors = Sk.rank_errors(inside, merged, keys, SKETCHED).withColumnsRenamed({n: f"_{n}" for n in SKETCHED})
    return merged.join(errors, keys).select(
        *keys,
        "total_events",
        "avg_latency_ms",
        *[(F.col(f"_{n}") <= RANK_TOLERANCE).alias(n.replace("_latency_ms", "_within")) for n in SKETCHED],
    )


EVENT_REPORTS["latency_sketches"] = latency_sketches
EVENT_REPORTS |= {f"order_{name}": ordered(name) for name in ORDERED_REPORTS}


# --- data quality -------------------------------------------------------------------------------


def dq_reasons(spark, sf_dir):
    return shown(flagged(spark, sf_dir).select("seq", "event_id", "rejection_reasons"))


def dq_valid(spark, sf_dir):
    valid, _ = Q.route(flagged(spark, sf_dir))
    return valid.select(
        "seq", "event_id", "timestamp", "customer_id", "service_id", "location_id", "duration_ms", "status_code"
    )


def dq_quarantine(spark, sf_dir):
    _, rejected = Q.route(flagged(spark, sf_dir))
    envelope = Q.quarantine_envelope(rejected, B.DIRTY_AS_OF)
    return shown(
        envelope.select(
            "raw_record.seq", "raw_record.event_id", "raw_record.status_code", "rejection_reasons", "quarantined_at"
        )
    )


def dq_metrics_document(spark, sf_dir):
    path = scratch_path(spark, "metrics")
    L.write_dq_metrics(Q.dq_metrics(flagged(spark, sf_dir)), path)
    return L.read_dq_metrics(spark, path).select("*", "error_distribution.*").drop("error_distribution")


def raw_errors(spark, sf_dir, fmt):
    """Write the raw batch as files, read it back as raw input and count the rejection codes."""
    s = B.bind_star(spark, sf_dir)
    path = scratch_path(spark, f"raw-{fmt}")
    writer = B.bind_dirty_events(s.events).drop("seq").write
    if fmt == "csv":
        writer = writer.option("header", "true")
    writer.format(fmt).save(path)
    raw = read_raw_events(spark, path, fmt)
    return Q.error_distribution(
        Q.validate_events(raw, B.DIRTY_AS_OF, s.customers, s.services, s.locations)
    )


def raw_json_array_errors(spark, sf_dir):
    """The raw batch as files that hold one JSON array of a thousand events each."""
    s = B.bind_star(spark, sf_dir)
    path = scratch_path(spark, "raw-arrays")
    rows = B.bind_dirty_events(s.events)
    chunk = F.floor(F.col("seq") / 1000).alias("_chunk")
    record = F.struct("seq", *[c for c in rows.columns if c != "seq"])
    arrays = rows.groupBy(chunk).agg(F.to_json(F.sort_array(F.collect_list(record))).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    raw = read_raw_events(spark, path, "json", multi_line=True)
    return Q.error_distribution(
        Q.validate_events(raw, B.DIRTY_AS_OF, s.customers, s.services, s.locations)
    )


def raw_pruned_day(spark, sf_dir):
    """One day out of a raw zone with a folder per day."""
    path = scratch_path(spark, "raw-dated")
    # Dirty rows keep their place in the input; the folder is the day they arrived.
    arrived = B.bind_star(spark, sf_dir).events.select("seq", F.col("timestamp").alias("arrived"))
    rows = B.bind_dirty_events(B.bind_star(spark, sf_dir).events).join(arrived, "seq")
    dated = cal.with_calendar(rows, "arrived").select(*[c for c in rows.columns if c not in ("seq", "arrived")], *S.LAKE_PARTITIONS)
    dated.hint("rebalance", *S.LAKE_PARTITIONS).write.partitionBy(*S.LAKE_PARTITIONS).json(path)
    day = read_raw_events(spark, path, days=("2024-01-16", "2024-01-16"))
    return day.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(Q.missing("event_id")).alias("rows_without_id")
    )


def ingest_batch(spark, sf_dir):
    s = B.bind_star(spark, sf_dir)
    zones = G.Zones.below(scratch_path(spark, "zones"))
    G.ingest(B.bind_dirty_events(s.events), zones, B.DIRTY_AS_OF, s.customers, s.services, s.locations)
    return days(L.read_event_lake(spark, zones.lake))


LATER = "2999-06-01 00:00:00"


def ingest_two_clocks(spark, sf_dir):
    """One batch run twice, the second time when its rows of the future have become past."""
    s = B.bind_star(spark, sf_dir)
    zones = G.Zones.below(scratch_path(spark, "zones"))
    for clock in (B.DIRTY_AS_OF, LATER):
        G.ingest(B.bind_dirty_events(s.events), zones, clock, s.customers, s.services, s.locations)
    held = spark.read.parquet(zones.quarantine).groupBy("rejection_reasons").agg(F.count(F.lit(1)).alias("n_rows"))
    lake = L.read_event_lake(spark, zones.lake).agg(F.lit("lake").alias("found"), F.count(F.lit(1)).alias("n_rows"))
    return lake.unionByName(held.select(F.array_join("rejection_reasons", " | ").alias("found"), "n_rows"))


def quarantine_table(spark, sf_dir):
    """Rejected rows written with their envelope as dated JSON, read back per date of quarantine."""
    _, rejected = Q.route(flagged(spark, sf_dir))
    path = scratch_path(spark, "quarantine")
    L.write_quarantine(Q.quarantine_envelope(rejected, B.DIRTY_AS_OF), path, "json")
    held = spark.read.schema(
        "raw_record struct<event_type: string>, rejection_reasons array<string>, "
        "quarantined_at timestamp, year string, month string, day string"
    ).json(path)
    return held.groupBy("year", "month", "day", F.col("raw_record.event_type").alias("event_type")).agg(
        F.count(F.lit(1)).alias("rows_rejected"),
        F.sum(F.size("rejection_reasons").cast("long")).alias("reasons"),
    )


def dq_constraints(spark, sf_dir):
    return Q.check_constraints(dirty(spark, sf_dir), Q.contracts()["event"])


def dq_constraints_cases(spark, sf_dir):
    return Q.check_constraints(sla(spark, sf_dir), Q.contracts()["sla"])


def dq_constraints_records(spark, sf_dir):
    """The contracts of the other record kinds, on tables with some planted violations."""
    s = B.bind_star(spark, sf_dir)

    def planted(df, key, n, column, value):
        return df.withColumn(column, F.when(F.col(key).cast("long") % n == 0, value).otherwise(F.col(column)))

    level = (F.col("s_nationkey") % 7).cast("int").alias("skill_level")
    tables = {
        "customer": planted(s.customers, "customer_id", 7, "tier", F.col("industry")),
        "service": planted(s.services, "service_id", 11, "tier_level", F.lit(5)),
        "location": planted(s.locations, "location_id", 5, "region", F.lit(None)),
        "agent": B.table(spark, sf_dir, "supplier").select(level),
        "exception": exceptions(spark, sf_dir),
    }
    checked = [
        Q.check_constraints(df, Q.contracts()[kind]).select(F.lit(kind).alias("record"), "rule", "violations")
        for kind, df in tables.items()
    ]
    return reduce(DataFrame.union, checked)


def state_updates(spark, sf_dir):
    """A case's repeated report of one state is a duplicate; every third case reports each state twice."""
    log = transition_log(spark, sf_dir).select("case_id", "state", "seq")
    number = F.substring("case_id", 6, 20).cast("long")
    again = log.where(number % 3 == 0).withColumn("seq", F.col("seq") + 100)
    return Q.mark_duplicates(log.unionByName(again), ["case_id", "state"], "seq", flag="is_duplicate")


def assert_orphans(spark, sf_dir):
    kept = B.bind_star(spark, sf_dir).events.where(F.col("seq") % 7 != 0)
    return Q.assert_no_orphan_exceptions(exceptions(spark, sf_dir), kept)


def reconcile_layers(spark, sf_dir):
    """Hourly counts of the clean source against those of the validated layer."""
    valid, _ = Q.route(flagged(spark, sf_dir))
    source = A.hourly_trend(B.bind_star(spark, sf_dir).events)
    layer = A.hourly_trend(L.conform_events(valid))
    return Q.reconcile(source, layer, ["hour"]).select(
        "hour",
        F.col("left_values.total_events").alias("left_events"),
        F.col("left_values.error_events").alias("left_errors"),
        F.col("right_values.total_events").alias("right_events"),
        F.col("right_values.error_events").alias("right_errors"),
    )


def defects(spark, sf_dir):
    """Planted defects over the clean events, counted by the validator."""
    s = B.bind_star(spark, sf_dir)
    text = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    raw = s.events.withColumn("timestamp", text).drop("clock")
    planted = Q.inject_defects(raw, 0.02, 42, B.DIRTY_AS_OF)
    return Q.error_distribution(
        Q.validate_events(planted, B.DIRTY_AS_OF, s.customers, s.services, s.locations)
    )


QUALITY: dict[str, Query] = {
    "dq_reasons": dq_reasons,
    "dq_valid": dq_valid,
    "dq_quarantine": dq_quarantine,
    "dq_summary": lambda spark, sf_dir: Q.dq_summary(flagged(spark, sf_dir)),
    "dq_errors": lambda spark, sf_dir: Q.error_distribution(flagged(spark, sf_dir)),
    "dq_metrics_document": dq_metrics_document,
    "raw_json_errors": partial(raw_errors, fmt="json"),
    "raw_csv_errors": partial(raw_errors, fmt="csv"),
    "raw_json_array_errors": raw_json_array_errors,
    "raw_pruned_day": raw_pruned_day,
    "quarantine_table": quarantine_table,
    "ingest_batch": ingest_batch,
    "ingest_two_clocks": ingest_two_clocks,
    "dq_constraints": dq_constraints,
    "dq_constraints_cases": dq_constraints_cases,
    "dq_constraints_records": dq_constraints_records,
    "state_updates": state_updates,
    "assert_duplicates": lambda spark, sf_dir: Q.assert_no_duplicate_ids(dirty(spark, sf_dir)),
    "assert_negative_duration": lambda spark, sf_dir: Q.assert_no_negative_duration(dirty(spark, sf_dir)),
    "assert_orphans": assert_orphans,
    "assert_score_bounds": lambda spark, sf_dir: Q.assert_score_bounds(exceptions(spark, sf_dir)),
    "reconcile_layers": reconcile_layers,
    "transitions_check": lambda spark, sf_dir: shown(Q.illegal_transitions(transition_log(spark, sf_dir))),
    "clock_skew": report(lambda s: s.events.where(Q.clock_skew(AS_OF, "timestamp")).select("event_id")),
    "defects": defects,
}


# --- projections, rules and cases ---------------------------------------------------------------


def dim_date(spark, sf_dir):
    events = B.bind_star(spark, sf_dir).events
    bounds = events.agg(
        F.to_date(F.min("timestamp")).alias("first_day"), F.to_date(F.max("timestamp")).alias("last_day")
    )
    return shown(cal.build_dim_date(bounds))


def priority_scores(spark, sf_dir):
    micro = F.floor(R.s_financial(F.col("financial_exposure")) * 1e6 + F.lit(0.5)).cast("long")
    return cases(spark, sf_dir).select(
        "exception_id",
        R.s_sla(F.col("sla_status"), F.col("consumption_ratio")).alias("f_sla"),
        R.s_customer(F.col("tier")).alias("f_customer"),
        micro.alias("f_financial_micro"),
        R.s_age(F.col("unassigned_hours")).alias("f_age"),
        R.s_criticality(F.col("severity")).alias("f_criticality"),
        "priority_score",
        "priority_band",
    )


def due_breach(spark, sf_dir):
    return shown(
        R.with_breach_measures(cases(spark, sf_dir)).select(
            "sla_id", "due_time", "breach_magnitude_minutes", "is_breached", "is_at_risk"
        )
    )


def cases_new_only(spark, sf_dir):
    """A second run: every third event already has its exception."""
    number = F.substring("event_id", 5, 20).cast("long")
    known = cases(spark, sf_dir).where(number % 3 == 0).select("event_id")
    return shown(cases(spark, sf_dir, existing=known))


def case_tables(spark, sf_dir):
    """Write both case tables, read them back and join them."""
    s = B.bind_star(spark, sf_dir)
    zones = G.Zones.below(scratch_path(spark, "cases"))
    G.build_cases(
        spark,
        s.events,
        zones,
        s.customers,
        s.services,
        F.col("clock"),
        exposures=B.bind_exposures(B.table(spark, sf_dir, "orders")),
        team_pattern=TEAM_PATTERN,
    )
    states = L.read_sla(spark, zones.cases).select("case_id", "sla_status", "remaining_minutes")
    return shown(L.read_exceptions(spark, zones.cases).drop("assigned_agent").join(states, "case_id"))


RULES: dict[str, Query] = {
    "calendar": report(
        lambda s: cal.with_calendar(s.events).select(
            "event_id", "year", "month", "day", "hour", "day_of_week", "is_weekend"
        )
    ),
    "dim_date": dim_date,
    "error_flags": report(
        lambda s: R.with_error_flags(s.events).select("event_id", "is_error", "error_message")
    ),
    "case_keys": lambda spark, sf_dir: cases(spark, sf_dir).select(
        "event_id", "sla_id", "exception_id", "case_id"
    ),
    "sla_state": lambda spark, sf_dir: cases(spark, sf_dir).select(
        "case_id",
        "tier",
        "target_minutes",
        "elapsed_minutes",
        "remaining_minutes",
        "consumption_ratio",
        "sla_status",
        "unassigned_hours",
    ),
    "due_breach": due_breach,
    "priority_scores": priority_scores,
    "priority_drivers": lambda spark, sf_dir: shown(
        cases(spark, sf_dir).select("exception_id", "reason_drivers")
    ),
    "cases": lambda spark, sf_dir: shown(cases(spark, sf_dir)),
    "cases_new_only": cases_new_only,
    "case_tables": case_tables,
    "exposure_fallback": report(
        lambda s: score_cases(s.events, s.customers, s.services, F.col("clock")).select(
            "exception_id", "tier", "financial_exposure", "priority_score"
        )
    ),
}


# --- backlog ------------------------------------------------------------------------------------


def triage_queue(spark, sf_dir):
    live = Tr.active_backlog(exceptions(spark, sf_dir))
    return Tr.triage_queue(live).select("exception_id", "priority_score")


def triage_positions(spark, sf_dir):
    """Queue places of the active backlog, from the distributed sort."""
    live = Tr.active_backlog(exceptions(spark, sf_dir)).select("exception_id", "priority_score")
    return Sc.positions(live, Tr.queue_order())


def exception_page_deep(spark, sf_dir):
    """A page in the middle of the backlog, found by position rather than by skipping rows."""
    backlog = exceptions(spark, sf_dir)
    return shown(Tr.exception_page(backlog, limit=50, offset=60)[1])


def _take(spark, sf_dir, part):
    return Tr.take(exceptions(spark, sf_dir), 25)[part].select("exception_id", "priority_score")


def _page(spark, sf_dir, part):
    parts = Tr.exception_page(exceptions(spark, sf_dir), limit=20, offset=10, priority="p3", status="detected")
    return shown(parts[part])


def exception_page_customer(spark, sf_dir):
    """The cases of the customer that has the most of them, least id first."""
    backlog = exceptions(spark, sf_dir)
    counts = backlog.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
    most = counts.orderBy(F.col("n").desc(), "customer_id").first()
    return shown(Tr.exception_page(backlog, limit=20, customer=most.customer_id)[1])


def exception_detail(spark, sf_dir):
    """Some customers, services and SLA rows are held back, so the defaults show."""
    s = B.bind_star(spark, sf_dir)
    detail = J.exception_detail(
        exceptions(spark, sf_dir),
        s.customers.where("industry <> 'MACHINERY'"),
        s.services.where("tier_level <> 2"),
        sla(spark, sf_dir).where(~F.col("sla_id").endswith("3")),
    )
    return shown(
        detail.select(
            "id",
            "case_id",
            "event_id",
            F.col("customer.id").alias("customer_id"),
            F.col("customer.name").alias("customer_name"),
            F.col("customer.tier").alias("customer_tier"),
            F.col("service.id").alias("service_id"),
            F.col("service.name").alias("service_name"),
            F.col("service.category").alias("service_category"),
            "financial_exposure",
            "priority_score",
            "priority_band",
            "priority_drivers",
            "sla_status",
            "sla_remaining_minutes",
            "lifecycle_state",
            "created_at",
            "assigned_team",
        )
    )


def triage_table(spark, sf_dir):
    s = B.bind_star(spark, sf_dir)
    table = J.triage_table(exceptions(spark, sf_dir), s.customers, s.services, sla(spark, sf_dir))
    return shown(Tr.slice_triage(table, bands=["P1", "P2"], teams=["Core Infrastructure"]))


def summary_kpis(spark, sf_dir):
    kpis = A.summary_kpis(exceptions(spark, sf_dir), sla(spark, sf_dir))
    top = F.col("highest_priority_exception")
    shown_top = {
        "top_id": top.id,
        "top_score": top.priority_score,
        "top_status": top.sla_status,
        "top_remaining": top.remaining_minutes,
    }
    return kpis.withColumns(shown_top).drop("highest_priority_exception")


def _measure(names):
    def run(spark, sf_dir):
        return A.measures(exceptions=exceptions(spark, sf_dir), sla=sla(spark, sf_dir)).select(*names)

    return run


BACKLOG: dict[str, Query] = {
    "triage_queue": triage_queue,
    "triage_positions": triage_positions,
    "exception_page_deep": exception_page_deep,
    "triage_top": lambda spark, sf_dir: Tr.peek(exceptions(spark, sf_dir)).select("exception_id", "priority_score"),
    "triage_take": partial(_take, part=0),
    "triage_rest": partial(_take, part=1),
    "exception_page": partial(_page, part=1),
    "exception_page_total": partial(_page, part=0),
    "exception_page_customer": exception_page_customer,
    "sla_risk": lambda spark, sf_dir: shown(Tr.sla_risk(sla(spark, sf_dir))),
    "p1_top": lambda spark, sf_dir: shown(
        Tr.top_p1(exceptions(spark, sf_dir)).select("exception_id", "priority_score", "reason_drivers")
    ),
    "exception_detail": exception_detail,
    "triage_table": triage_table,
    "summary_kpis": summary_kpis,
    "band_distribution": lambda spark, sf_dir: A.band_distribution(exceptions(spark, sf_dir)),
    "exposure": _measure(["total_financial_exposure"]),
    "p1_count": _measure(["p1_critical_exceptions", "active_backlog"]),
    "sla_compliance": _measure(["sla_compliance_rate_pct"]),
    "breach_rate": lambda spark, sf_dir: shown(
        A.sla_breach_rate(sla(spark, sf_dir), B.bind_star(spark, sf_dir).services)
    ),
    "team_breaches": lambda spark, sf_dir: A.team_breaches(exceptions(spark, sf_dir), sla(spark, sf_dir)),
    "median_resolution": lambda spark, sf_dir: A.median_resolution(transition_log(spark, sf_dir)),
}


# --- windows, queue versions, loads, impact -----------------------------------------------------

TRAILING_COLUMNS = (
    "event_id",
    "customer_id",
    "rolling_event_count",
    "rolling_breach_count",
    "rolling_breach_rate_pct",
)


def _trailing(by):
    return report(
        lambda s: Wn.trailing_window(
            s.events.select("event_id", "customer_id", "timestamp", "status_code"), "timestamp", is_failure(), 60, by
        ).select(*TRAILING_COLUMNS)
    )


def queue_latest(spark, sf_dir):
    """Every event pushes its customer's item with a new score; the last push counts."""
    pushes = B.bind_star(spark, sf_dir).events.select(
        F.concat(F.lit("EXC-"), F.col("customer_id")).alias("exception_id"),
        (F.col("duration_ms") / F.lit(10.0)).alias("priority_score"),
        F.col("seq").alias("version"),
    )
    return Wn.latest_by_key(pushes, "exception_id", "version")


def insert_if_absent(spark, sf_dir):
    customers = B.bind_star(spark, sf_dir).customers
    target = customers.where(F.col("customer_id").cast("long") % 3 != 0)
    incoming = B.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderpriority").alias("industry"),
        F.col("o_orderkey").alias("seq"),
    )
    return L.insert_if_absent(target, incoming, "customer_id", "seq")


def append_new_events(spark, sf_dir):
    events = B.bind_star(spark, sf_dir).events
    incoming = B.bind_dirty_events(events).where(
        F.col("event_id").isNotNull() & cal.parse_iso(F.col("timestamp")).isNotNull()
    )
    fresh = L.append_new_events(events.where(F.col("seq") % 2 == 0), incoming)
    return shown(fresh.select("event_id", "timestamp", "customer_id", "status_code"))


def impact_sensitivity(spark, sf_dir):
    volumes = I.segment_volumes(cases(spark, sf_dir), ["tier", "service_id"])
    return I.impact_sensitivity(volumes).drop("breached_cases", "current_breach_rate_pct")


WINDOWS: dict[str, Query] = {
    "trailing_60m": _trailing(()),
    "trailing_by_customer": _trailing(("customer_id",)),
    "window_as_of": report(lambda s: Wn.window_metrics(s.events, "timestamp", is_failure(), AS_OF)),
    "recent_events": report(
        lambda s: Tr.recent(s.events, "timestamp", AS_OF, 24).select("event_id", "timestamp", "status_code")
    ),
    "velocity": report(
        lambda s: Wn.failure_velocity(Tr.failed_events(s.events), "timestamp", 60, ["location_id"])
    ),
    "queue_latest": queue_latest,
    "insert_if_absent": insert_if_absent,
    "append_new_events": append_new_events,
    "impact_by_segment": lambda spark, sf_dir: I.impact_by_segment(
        cases(spark, sf_dir), ["tier", "service_id"]
    ),
    "impact_sensitivity": impact_sensitivity,
}


# --- lake and catalog ---------------------------------------------------------------------------


def _written_lake(spark, sf_dir) -> tuple[str, B.Star]:
    root = scratch_path(spark, "lake")
    s = B.bind_star(spark, sf_dir)
    L.write_event_lake(s.events, f"{root}/{C.FACT}")
    return root, s


def _written_star(spark, sf_dir) -> str:
    root, s = _written_lake(spark, sf_dir)
    dims = {"dim_customers": s.customers, "dim_services": s.services, "dim_locations": s.locations}
    L.write_dimensions(dims, root)
    return root


def dimension_tables(spark, sf_dir):
    """The stored dimensions read back with their declared schemas: rows and distinct keys of each."""
    root = _written_star(spark, sf_dir)
    sizes = []
    for folder, schema in C.DIMENSIONS.values():
        dim = read_dimension(spark, f"{root}/{folder}", schema, "parquet")
        sizes.append(
            dim.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(schema.names[0]).alias("n_keys")).select(
                F.lit(folder).alias("dimension"), "n_rows", "n_keys"
            )
        )
    return reduce(DataFrame.union, sizes)


def lake_two_loads(spark, sf_dir):
    """Two loads that overlap, kept apart by the index of ids."""
    s = B.bind_star(spark, sf_dir)
    root, n = scratch_path(spark, "loads"), F.col("seq")
    for load in (n % 3 != 0, n >= 0):
        L.write_event_lake(s.events.where(load), f"{root}/lake", index=f"{root}/ids")
    return days(L.read_event_lake(spark, f"{root}/lake"))


def lake_roundtrip(spark, sf_dir):
    root, _ = _written_lake(spark, sf_dir)
    return days(L.read_event_lake(spark, f"{root}/{C.FACT}"))


def lake_pruned_day(spark, sf_dir):
    root, _ = _written_lake(spark, sf_dir)
    day = Tr.partition_range(L.read_event_lake(spark, f"{root}/{C.FACT}"), "2024", "01", "16", "16")
    return shown(
        day.select("event_id", "timestamp", "year", "month", "day", "hour", "day_of_week", "is_weekend")
    )


def scan_profile_day(spark, sf_dir):
    """Count and mean duration of one day of the stored lake."""
    root, _ = _written_lake(spark, sf_dir)
    lake = L.read_event_lake(spark, f"{root}/{C.FACT}")
    return A.scan_profile(Tr.partition_range(lake, "2024", "01", "16", "16"))


def lake_daily_summary(spark, sf_dir):
    root, _ = _written_lake(spark, sf_dir)
    return shown(A.daily_summary(L.read_event_lake(spark, f"{root}/{C.FACT}")))


def catalog_table(spark, sf_dir, table):
    root = _written_star(spark, sf_dir)
    db = "ops_" + root.rsplit("-", 1)[1]
    C.create_catalog(spark, db, root)
    C.repair_partitions(spark, f"{db}.{C.FACT}")
    C.build_aggregate_tables(spark, db, root)
    rows = spark.read.schema(spark.table(f"{db}.{table}").schema).parquet(f"{root}/{table}")
    # The tables are external: their files stay when the database goes.
    spark.sql(f"DROP DATABASE `{db}` CASCADE")
    return shown(rows)


def report_view(spark, sf_dir, view):
    C.register_views(spark, _written_star(spark, sf_dir))
    return spark.table(view)


LAKE: dict[str, Query] = {
    "dimension_tables": dimension_tables,
    "lake_roundtrip": lake_roundtrip,
    "lake_two_loads": lake_two_loads,
    "lake_pruned_day": lake_pruned_day,
    "lake_daily_summary": lake_daily_summary,
    "scan_profile_day": scan_profile_day,
    "catalog_tables": partial(catalog_table, table="agg_daily_operational_summary"),
    "catalog_profile": partial(catalog_table, table="agg_customer_incident_profile"),
    "report_views": partial(report_view, view="vw_customer_tier_exposure"),
    "report_view_services": partial(report_view, view="vw_service_reliability_summary"),
    "report_view_locations": partial(report_view, view="vw_location_bottlenecks"),
}


# --- streams ------------------------------------------------------------------------------------


def _deliver_to_files(
    spark: SparkSession, sf_dir: str, build: Callable[[DataFrame], DataFrame], schema: str
) -> DataFrame:
    """Run an append-mode stream over the deliveries into Parquet files and read them back."""
    out, checkpoint = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-checkpoint")

    def run(stream: DataFrame) -> None:
        query = (
            build(stream).writeStream.format("parquet")
            .option("path", out)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    deliver_events(spark, sf_dir, run)
    return spark.read.schema(schema).parquet(out)


def _deliver(spark, sf_dir, build, handler, mode="append") -> None:
    """Run a batch handler over the deliveries, from one checkpoint on to the next."""
    checkpoint = scratch_path(spark, "checkpoint")
    deliver_events(spark, sf_dir, lambda stream: St.run_available(build(stream), handler, checkpoint, mode))


def stream_validate(spark, sf_dir):
    s = B.bind_star(spark, sf_dir)

    def build(stream):
        raw = B.bind_dirty_events(stream)
        checked = St.stream_validate(raw, s.customers, s.services, s.locations, B.DIRTY_AS_OF)
        return checked.select("seq", "event_id", "rejection_reasons")

    return shown(_deliver_to_files(spark, sf_dir, build, "seq long, event_id string, rejection_reasons array<string>"))


def stream_dedup(spark, sf_dir):
    out = scratch_path(spark, "dedup")

    def build(stream):
        return St.with_first_ids(B.bind_dirty_events(stream).select("seq", "event_id"))

    _deliver(spark, sf_dir, build, St.dedup_handler(out))
    return spark.read.schema("seq long, event_id string, is_duplicate boolean").parquet(out).drop(St.BATCH)


def stream_sliding(spark, sf_dir):
    out = scratch_path(spark, "sliding")
    late = f"{_patience(spark, sf_dir)} minutes"

    def build(stream):
        return St.stream_sliding(stream, "timestamp", is_failure(), late=late)

    _deliver(spark, sf_dir, build, St.sliding_handler(out), "update")
    return shown(St.current_windows(spark, out))


def _run_trailing(spark, sf_dir, late_minutes):
    out = scratch_path(spark, "trailing")

    def build(stream):
        return stream.select("event_id", "customer_id", "timestamp", is_failure().alias("is_breach"))

    handler = St.trailing_handler(
        out, "timestamp", "is_breach", 60, ("customer_id",), late_minutes=late_minutes
    )
    _deliver(spark, sf_dir, build, handler)
    return out


def stream_trailing(spark, sf_dir):
    """What the watermark closed, and the rest as it stands at the end of the input."""
    out = _run_trailing(spark, sf_dir, _patience(spark, sf_dir))
    closed = spark.read.parquet(f"{out}/metrics").select(*TRAILING_COLUMNS)
    rest = St.held_metrics(spark, out, "timestamp", "is_breach", 60, ("customer_id",))
    return closed.unionByName(rest.select(*TRAILING_COLUMNS))


def late_rows(spark, sf_dir):
    """With one day of patience, what a delivery late costs."""
    return St.late_rows(spark, _run_trailing(spark, sf_dir, 24 * 60))


def stream_exceptions(spark, sf_dir):
    s = B.bind_star(spark, sf_dir)
    out = scratch_path(spark, "stream-cases")
    handler = St.cases_handler(
        out,
        s.customers,
        s.services,
        F.col("clock"),
        exposures=B.bind_exposures(B.table(spark, sf_dir, "orders")),
        team_pattern=TEAM_PATTERN,
    )
    _deliver(spark, sf_dir, St.with_first_ids, handler)
    return shown(spark.read.parquet(out).drop(St.BATCH))


def stream_lake(spark, sf_dir):
    s = B.bind_star(spark, sf_dir)
    root = scratch_path(spark, "stream-lake")
    handler = St.lake_handler(
        f"{root}/lake", f"{root}/quarantine", f"{root}/metrics", s.customers, s.services, s.locations, B.DIRTY_AS_OF
    )
    _deliver(spark, sf_dir, lambda stream: St.with_first_ids(B.bind_dirty_events(stream)), handler)
    return days(L.read_event_lake(spark, f"{root}/lake"))


STREAMS: dict[str, Query] = {
    "stream_validate": stream_validate,
    "stream_dedup": stream_dedup,
    "stream_sliding": stream_sliding,
    "stream_trailing": stream_trailing,
    "late_rows": late_rows,
    "stream_exceptions": stream_exceptions,
    "stream_lake": stream_lake,
}


def queries() -> dict[str, Query]:
    return {**EVENT_REPORTS, **QUALITY, **RULES, **BACKLOG, **WINDOWS, **LAKE, **STREAMS}
