"""Aggregated reports and measures.

Facts are aggregated by their own key first, with partial sums before the shuffle, and dimensions
are joined to the aggregates. Only the sketched latency distribution joins row-level facts first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from opsloom import schemas as S
from opsloom.functions.rounding import mean2, percent, round_binary
from opsloom.operators.scale import exact_percentiles
from opsloom.operators.star import star
from opsloom.operators.triage import is_active, partition_range


def server_errors() -> Column:
    return F.count_if(F.col("status_code") >= 500)


def _event_stats(events: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    return events.groupBy(*keys).agg(
        F.count("event_id").alias("_events"),
        server_errors().alias("_errors"),
        F.sum("duration_ms").alias("_duration"),
        F.count("duration_ms").alias("_timed"),
        F.max("duration_ms").alias("_slowest"),
    )


def _or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0).cast("long"))


# --- event reports ------------------------------------------------------------------------------


def service_reliability(events: DataFrame, services: DataFrame) -> DataFrame:
    """Per service, also those without events: volume, errors, rate and latency."""
    stats = _event_stats(events, ["service_id"])
    return (
        services.join(stats, "service_id", "left")
        .select(
            "service_id",
            "service_name",
            "service_category",
            "tier_level",
            _or_zero("_events").alias("total_events"),
            _or_zero("_errors").alias("error_event_count"),
            percent(F.col("_errors"), F.col("_events")).alias("error_rate_pct"),
            mean2(F.col("_duration"), F.col("_timed")).alias("avg_duration_ms"),
            F.col("_slowest").alias("max_duration_ms"),
        )
        .orderBy(F.col("error_rate_pct").desc_nulls_last(), F.col("service_id"))
    )


def dense_rank_desc(df: DataFrame, measure: str, rank: str) -> DataFrame:
    """Dense rank of a non-negative count, highest first.

    Only the distinct counts are ranked in one place. k distinct counts need at least k*(k-1)/2
    counted rows, so 10^12 rows give at most 1.5 million of them.
    """
    distinct = df.select(measure).distinct()
    ranked = distinct.withColumn(rank, F.dense_rank().over(W.orderBy(F.col(measure).desc())))
    return df.join(ranked, measure).select(*df.columns, rank)


def location_bottlenecks(events: DataFrame, locations: DataFrame) -> DataFrame:
    stats = _event_stats(events, ["location_id"])
    measured = locations.join(stats, "location_id").select(
        "location_id",
        "region",
        "country",
        F.col("_events").alias("event_volume"),
        F.col("_errors").alias("server_errors"),
        percent(F.col("_errors"), F.col("_events")).alias("error_rate_pct"),
        mean2(F.col("_duration"), F.col("_timed")).alias("avg_latency_ms"),
    )
    return dense_rank_desc(measured, "server_errors", "failure_rank").orderBy("failure_rank", "location_id")


def tier_exposure(events: DataFrame, customers: DataFrame) -> DataFrame:
    """Per tier and contract: customers, all their events (not only failures), and failures."""
    stats = _event_stats(events, ["customer_id"])
    return (
        customers.join(stats, "customer_id", "left")
        .groupBy(F.col("tier").alias("customer_tier"), "contract_sla_tier")
        .agg(
            F.count_distinct("customer_id").alias("customer_count"),
            F.sum(_or_zero("_events")).alias("total_incident_events"),
            F.sum(_or_zero("_errors")).alias("critical_failures"),
        )
    )


def hourly_trend(events: DataFrame) -> DataFrame:
    """Per hour of the day; the lake's stored hour is read instead of the wider timestamp."""
    hour = F.col("hour") if "hour" in events.columns else F.hour("timestamp")
    return (
        events.groupBy(hour.alias("hour"))
        .agg(F.count(F.lit(1)).alias("total_events"), server_errors().alias("error_events"))
        .orderBy("hour")
    )


def daily_summary(events: DataFrame) -> DataFrame:
    """Per UTC date, service and location; over the lake the date comes from the partition keys."""
    if set(S.LAKE_PARTITIONS) <= set(events.columns):
        keys: list[str | Column] = list(S.LAKE_PARTITIONS)
        date = F.make_date(*[F.col(c).cast("int") for c in S.LAKE_PARTITIONS])
    else:
        keys = [F.to_date("timestamp").alias("_date")]
        date = F.col("_date")
    return _event_stats(events, [*keys, "service_id", "location_id"]).select(
        date.alias("event_date"),
        "service_id",
        "location_id",
        F.col("_events").alias("total_events"),
        F.col("_errors").alias("error_count"),
        mean2(F.col("_duration"), F.col("_timed")).alias("avg_duration_ms"),
        percent(F.col("_errors"), F.col("_events")).alias("error_rate_pct"),
    )


def customer_incident_profile(events: DataFrame, customers: DataFrame) -> DataFrame:
    stats = (
        events.where(F.col("status_code") >= 400)
        .groupBy("customer_id")
        .agg(
            F.count("event_id").alias("total_incident_events"),
            server_errors().alias("critical_failures"),
            F.max("timestamp").alias("last_incident_time"),
        )
    )
    return customers.join(stats, "customer_id").select(
        "customer_id",
        "customer_name",
        F.col("tier").alias("customer_tier"),
        "contract_sla_tier",
        "total_incident_events",
        "critical_failures",
        "last_incident_time",
    )


def incident_rate_by_day_service(
    lake: DataFrame, year: str, month: str, first_day: str, last_day: str
) -> DataFrame:
    days = partition_range(lake, year, month, first_day, last_day)
    return (
        days.groupBy("year", "month", "day", "service_id")
        .agg(F.count(F.lit(1)).alias("total_events"), server_errors().alias("error_events"))
        .withColumn("incident_rate_pct", percent(F.col("error_events"), F.col("total_events")))
        .orderBy("year", "month", "day", F.col("incident_rate_pct").desc_nulls_last(), "service_id")
    )


# The latency levels the reports show.
LATENCY_LEVELS = {"p95_latency_ms": 0.95, "p99_latency_ms": 0.99}


def latency_distribution(
    events: DataFrame, customers: DataFrame, services: DataFrame, exact: bool = False
) -> DataFrame:
    """Per tier and service name: count, mean, p95 and p99; sketched unless `exact`.

    The exact form counts the events per customer, service and duration first and joins the counts;
    a sketch takes single values, so that form joins the events.
    """
    keys = ["customer_tier", "service_name"]
    facts = events.select("event_id", "customer_id", "service_id", "duration_ms")
    if exact:
        facts = facts.groupBy("customer_id", "service_id", "duration_ms").agg(
            F.count("event_id").alias("_events"), F.count(F.lit(1)).alias("_rows")
        )
    else:
        facts = facts.withColumns({"_events": F.col("event_id").isNotNull().cast("long"), "_rows": F.lit(1)})
    joined = star(
        facts,
        customers.select("customer_id", F.col("tier").alias("customer_tier"), F.lit(True).alias("_c")),
        services.select("service_id", "service_name", F.lit(True).alias("_s")),
        spread_by=("customer_id", "service_id", "duration_ms") if exact else ("event_id",),
    ).where(F.col("_c") & F.col("_s"))
    if exact:
        joined = joined.groupBy(*keys, "duration_ms").agg(
            F.sum("_events").alias("_events"), F.sum("_rows").alias("_rows")
        )
    sums = [
        F.sum("_events").alias("total_events"),
        F.sum(F.col("duration_ms") * F.col("_rows")).alias("_duration"),
        F.sum(F.when(F.col("duration_ms").isNotNull(), F.col("_rows"))).alias("_timed"),
    ]
    sketches = [] if exact else [
        F.percentile_approx("duration_ms", p).alias(name) for name, p in LATENCY_LEVELS.items()
    ]
    stats = joined.groupBy(*keys).agg(*sums, *sketches)
    if exact:
        levels = exact_percentiles(joined, keys, "duration_ms", LATENCY_LEVELS, rows=F.col("_rows"))
        other = levels.withColumnsRenamed({k: f"_r_{k}" for k in keys})
        same = F.col("customer_tier").eqNullSafe(F.col("_r_customer_tier")) & F.col("service_name").eqNullSafe(
            F.col("_r_service_name")
        )
        stats = stats.join(other, same, "left")
    return stats.select(
        *keys,
        "total_events",
        mean2(F.col("_duration"), F.col("_timed")).alias("avg_latency_ms"),
        *LATENCY_LEVELS,
    ).orderBy(F.col("p99_latency_ms").desc_nulls_last(), *keys)


def region_heatmap(events: DataFrame, locations: DataFrame) -> DataFrame:
    stats = _event_stats(events, ["location_id"])
    return (
        locations.join(stats, "location_id")
        .groupBy("region")
        .agg(F.sum("_events").alias("total_events"), F.sum("_errors").alias("error_events"))
        .withColumn("error_rate_pct", percent(F.col("error_events"), F.col("total_events")))
    )


def service_matrix(events: DataFrame, services: DataFrame) -> DataFrame:
    return service_reliability(events, services).select(
        "service_name",
        F.col("tier_level").alias("tier"),
        "total_events",
        F.col("error_event_count").alias("incident_count"),
        "error_rate_pct",
        F.col("avg_duration_ms").alias("avg_latency_ms"),
    )


def scan_profile(lake: DataFrame) -> DataFrame:
    """Count and mean duration; put a partition filter in front for one day."""
    return lake.agg(
        F.count(F.lit(1)).alias("total_events"),
        mean2(F.sum("duration_ms"), F.count("duration_ms")).alias("avg_duration_ms"),
    )


# --- backlog reports ----------------------------------------------------------------------------


def summary_kpis(exceptions: DataFrame, sla: DataFrame) -> DataFrame:
    """One row of KPI cards. Queue size and top item come from the whole active backlog."""
    item = F.struct(
        F.col("exception_id").alias("id"),
        "case_id",
        "customer_id",
        "service_id",
        "priority_score",
        "priority_band",
        "financial_exposure",
        "reason_drivers",
    )
    score = F.col("priority_score")
    rank = F.struct(score.isNull().alias("n"), (-score).alias("s"), F.col("exception_id").alias("i"))
    totals = exceptions.agg(
        F.count(F.lit(1)).alias("total_exceptions"),
        F.count_if(is_active()).alias("active_backlog"),
        F.min_by(F.when(is_active(), item), F.when(is_active(), rank)).alias("_top"),
    )
    cases = sla.agg(
        F.struct(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("sla_status") == "AT_RISK").alias("at_risk"),
            F.count_if(F.col("sla_status") == "BREACHED").alias("breached"),
        )
    ).scalar()
    # One row, so the SLA table is filtered where it lies.
    top_case = totals.select(F.col("_top.case_id").alias("case_id"))
    state = sla.join(F.broadcast(top_case), "case_id", "left_semi").agg(
        F.first(F.struct("sla_status", "remaining_minutes"))
    )
    row = totals.withColumns({"_c": cases, "_state": state.scalar()})
    top = F.struct("_top.*", "_state.sla_status", "_state.remaining_minutes")
    share = F.col("_c.breached").cast("double") / F.greatest(F.lit(1), F.col("_c.n")).cast("double") * F.lit(100.0)
    return row.select(
        "total_exceptions",
        "active_backlog",
        F.col("_c.at_risk").alias("sla_at_risk_count"),
        F.col("_c.breached").alias("sla_breached_count"),
        round_binary(share, 2).alias("sla_breach_rate_pct"),
        F.col("active_backlog").alias("priority_queue_size"),
        F.when(F.col("_top").isNotNull(), top).alias("highest_priority_exception"),
    )


def band_distribution(exceptions: DataFrame) -> DataFrame:
    """Exceptions per band, all four present."""
    counts = exceptions.agg(*[F.count_if(F.col("priority_band") == b).alias(b) for b in S.PRIORITY_BANDS])
    pairs = F.array(
        *[
            F.struct(F.lit(b).alias("priority_band"), F.col(b).alias("exception_count"))
            for b in S.PRIORITY_BANDS
        ]
    )
    return counts.select(F.inline(pairs))


def sla_breach_rate(sla: DataFrame, services: DataFrame) -> DataFrame:
    """Breached cases of all cases per service and start date."""
    stats = sla.groupBy("service_id", F.to_date("start_time").alias("start_date")).agg(
        F.count(F.lit(1)).alias("total_cases"),
        F.count_if(F.col("sla_status") == "BREACHED").alias("breached_cases"),
    )
    return stats.join(services.select("service_id", "service_name"), "service_id").select(
        "service_id",
        "service_name",
        "start_date",
        "total_cases",
        "breached_cases",
        percent(F.col("breached_cases"), F.col("total_cases")).alias("breach_rate_pct"),
    )


def team_breaches(exceptions: DataFrame, sla: DataFrame) -> DataFrame:
    states = sla.select("case_id", "sla_status")
    return (
        exceptions.select("case_id", "assigned_team")
        .join(states, "case_id")
        .groupBy("assigned_team")
        .agg(
            F.count(F.lit(1)).alias("total_cases"),
            F.count_if(F.col("sla_status") == "BREACHED").alias("breached_cases"),
        )
        .withColumn("breach_rate_pct", percent(F.col("breached_cases"), F.col("total_cases")))
    )


def resolution_minutes(log: DataFrame) -> DataFrame:
    """Whole minutes from first detection to last resolution per resolved case."""

    def at(state: str) -> Column:
        return F.when(F.col("state") == state, F.unix_micros("changed_at"))

    ends = log.groupBy("case_id").agg(F.min(at("DETECTED")).alias("_from"), F.max(at("RESOLVED")).alias("_to"))
    return ends.where("_from IS NOT NULL AND _to IS NOT NULL").select(
        "case_id", F.call_function("div", F.col("_to") - F.col("_from"), F.lit(60_000_000)).alias("resolution_minutes")
    )


def median_resolution(log: DataFrame) -> DataFrame:
    return exact_percentiles(resolution_minutes(log), [], "resolution_minutes", {"median_minutes": 0.5})


# --- measures under any slicers -----------------------------------------------------------------


def _cents(name: str) -> Column:
    return F.floor(F.col(name) * 100 + F.lit(0.5)).cast("long")


def _event_sums() -> dict[str, Column]:
    return {
        "total_events": F.count(F.lit(1)),
        "total_incidents": server_errors(),
        "_duration": F.sum("duration_ms"),
        "_timed": F.count("duration_ms"),
    }


def _exception_sums() -> dict[str, Column]:
    return {
        "active_backlog": F.count_if(is_active()),
        "_exposure_cents": F.sum(_cents("financial_exposure")),
        "p1_critical_exceptions": F.count_if(F.col("priority_band") == "P1"),
    }


def _sla_sums() -> dict[str, Column]:
    return {
        "_cases": F.count(F.lit(1)),
        "_breached": F.count_if(F.col("sla_status") == "BREACHED"),
    }


def _measure_columns() -> dict[str, Column]:
    def zero(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0).cast("long"))

    good = zero("_cases") - zero("_breached")
    return {
        "total_events": zero("total_events"),
        "total_incidents": zero("total_incidents"),
        "error_rate_pct": F.coalesce(
            F.try_divide(zero("total_incidents"), zero("total_events")), F.lit(0.0)
        ) * F.lit(100.0),
        "active_backlog": zero("active_backlog"),
        "total_financial_exposure": zero("_exposure_cents") / F.lit(100.0),
        "p1_critical_exceptions": zero("p1_critical_exceptions"),
        "average_latency_ms": F.try_divide(F.col("_duration"), F.col("_timed")),
        "sla_compliance_rate_pct": F.coalesce(F.try_divide(good, zero("_cases")), F.lit(1.0)) * F.lit(100.0),
    }


def measures(
    events: DataFrame | None = None,
    exceptions: DataFrame | None = None,
    sla: DataFrame | None = None,
    by: Sequence[str] = (),
    sets: str | Sequence[Sequence[str]] = "plain",
) -> DataFrame:
    """The eight dashboard measures under any slicers, in one pass over each table.

    `by` names columns that the given tables carry. `sets` is "plain", "rollup", "cube" or a list
    of column subsets. Each table is summed at the finest grain first, so the expansion for the
    subsets works on the small partial sums.
    """
    parts = []
    for df, sums in ((events, _event_sums()), (exceptions, _exception_sums()), (sla, _sla_sums())):
        if df is not None:
            parts.append(df.groupBy(*by).agg(*[c.alias(n) for n, c in sums.items()]))
    if not parts:
        raise ValueError("give at least one table")
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part, allowMissingColumns=True)
    names = [*_event_sums(), *_exception_sums(), *_sla_sums()]
    merged = merged.withColumns(
        {n: F.lit(None).cast("long") for n in names if n not in merged.columns}
    )
    if sets == "plain":
        grouped = merged.groupBy(*by)
    elif sets == "rollup":
        grouped = merged.rollup(*by)
    elif sets == "cube":
        grouped = merged.cube(*by)
    else:
        grouped = merged.groupingSets([[F.col(c) for c in one] for one in sets], *by)
    level = [] if sets == "plain" else [F.grouping_id().alias("grouping_id")]
    summed = grouped.agg(*level, *[F.sum(n).alias(n) for n in names])
    shown = [*by, *(["grouping_id"] if level else [])]
    return summed.select(*shown, *[c.alias(n) for n, c in _measure_columns().items()])
