"""Case build: failed events to SLA records and scored exceptions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsloom import schemas as S
from opsloom.functions import rules as R
from opsloom.functions.rounding import round_binary
from opsloom.operators.quality import Clock, clock_column
from opsloom.operators.scale import lookup
from opsloom.operators.star import with_case_terms, without_known


def open_cases(
    events: DataFrame,
    customers: DataFrame,
    services: DataFrame,
    as_of: Clock,
    existing: DataFrame | None = None,
    limit: int | None = None,
    target_severity: Column | str = "High",
    warn: float = R.WARN_RATIO,
    breach: float = R.BREACH_RATIO,
) -> DataFrame:
    """One row per failed event that has no exception yet, with its SLA state.

    `as_of` is a literal or a column of `events`. A `limit` takes the oldest after leaving out the
    known ones.
    """
    failed = events.where(F.col("status_code") >= 500).select(
        "event_id",
        "customer_id",
        "service_id",
        "location_id",
        F.col("timestamp").alias("start_time"),
        clock_column(as_of).alias("clock"),
    )
    if existing is not None:
        failed = without_known(failed, existing)
    if limit is not None:
        failed = failed.orderBy("start_time", "event_id").limit(limit)
    cases = with_case_terms(failed, customers, services)
    severity = F.lit(target_severity) if isinstance(target_severity, str) else target_severity
    target = R.sla_target(F.col("tier"), severity, F.col("default_sla_minutes"))
    cases = R.with_sla_state(cases.withColumn("target_minutes", target), warn=warn, breach=breach)
    event_id = F.col("event_id")
    return cases.withColumns(
        {
            "sla_id": R.sla_id(event_id),
            "case_id": R.case_id(event_id),
            "due_time": R.due_time(F.col("start_time"), F.col("target_minutes")),
        }
    )


def score_cases(
    events: DataFrame,
    customers: DataFrame,
    services: DataFrame,
    as_of: Clock,
    exposures: DataFrame | None = None,
    score_severity: Column | None = None,
    team_pattern: str = "Payment",
    weights: Mapping[str, float] | None = None,
    **sla_options,
) -> DataFrame:
    """Open cases with score, band, reasons and team: one wide row per case.

    `exposures` gives the measured exposure per customer; customers without one get the repeatable
    stand-in of their tier.
    """
    cases = open_cases(events, customers, services, as_of, **sla_options)
    if exposures is None:
        cases = cases.withColumn("_measured", F.lit(None).cast("double"))
    else:
        measured = exposures.select("customer_id", F.col("financial_exposure").cast("double").alias("_measured"))
        failed = events.where(F.col("status_code") >= 500)
        cases = lookup(cases, measured, "customer_id", ["event_id"], counted_on=failed)
    tier, event_id = F.col("tier"), F.col("event_id")
    cases = cases.withColumns(
        {
            # The stored exposure has two decimals, the score uses the value as given.
            "_exposure": F.coalesce("_measured", R.exposure_fallback(tier, event_id)),
            "severity": R.scoring_severity(tier) if score_severity is None else score_severity,
        }
    )
    cases = R.with_priority(cases, weights, exposure="_exposure")
    return cases.select(
        "sla_id",
        R.exception_id(event_id).alias("exception_id"),
        "case_id",
        "event_id",
        "customer_id",
        "service_id",
        "location_id",
        "tier",
        "severity",
        "start_time",
        "clock",
        "due_time",
        "target_minutes",
        "elapsed_minutes",
        "remaining_minutes",
        "consumption_ratio",
        "sla_status",
        "unassigned_hours",
        round_binary(F.col("_exposure"), 2).alias("financial_exposure"),
        "priority_score",
        "priority_band",
        "reason_drivers",
        R.assigned_team(F.col("service_name"), team_pattern).alias("assigned_team"),
    )


def sla_records(cases: DataFrame) -> DataFrame:
    return cases.select(*S.SLA_RECORD.names)


def exception_records(cases: DataFrame) -> DataFrame:
    """Exceptions in their first state; no agent is assigned at detection."""
    return cases.withColumns(
        {
            "lifecycle_state": F.lit("DETECTED"),
            "created_at": F.col("clock"),
            "updated_at": F.col("clock"),
            "assigned_agent": F.lit(None).cast("string"),
        }
    ).select(*S.EXCEPTION_RECORD.names)


def detect_exceptions(
    events: DataFrame, customers: DataFrame, services: DataFrame, as_of: Clock, **options
) -> tuple[DataFrame, DataFrame]:
    """(SLA records, exception records). To write both, stage `score_cases` once and project twice."""
    cases = score_cases(events, customers, services, as_of, **options)
    return sla_records(cases), exception_records(cases)
