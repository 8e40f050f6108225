"""Joins of facts with the dimensions and with each other."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsloom.functions.rules import DEFAULT_SLA_MINUTES, DEFAULT_TIER
from opsloom.operators.scale import lookup


def star(
    events: DataFrame,
    customers: DataFrame | None = None,
    services: DataFrame | None = None,
    locations: DataFrame | None = None,
    spread_by: Sequence[str] = ("event_id",),
) -> DataFrame:
    """Fact rows with the attributes of the given dimensions; rows without a match keep NULLs.

    `spread_by` are columns that tell the rows of a hot key apart.
    """
    joined = events
    for dim, key in ((customers, "customer_id"), (services, "service_id"), (locations, "location_id")):
        if dim is not None:
            joined = lookup(joined, dim, key, spread_by, counted_on=events)
    return joined


def with_case_terms(events: DataFrame, customers: DataFrame, services: DataFrame) -> DataFrame:
    """Tier, service name and default SLA per event, with the defaults for unknown ids."""
    terms = star(
        events,
        customers.select("customer_id", "tier"),
        services.select("service_id", "service_name", "default_sla_minutes"),
    )
    return terms.withColumns(
        {
            "tier": F.coalesce("tier", F.lit(DEFAULT_TIER)),
            "default_sla_minutes": F.coalesce("default_sla_minutes", F.lit(DEFAULT_SLA_MINUTES)),
        }
    )


def without_known(events: DataFrame, existing: DataFrame, key: str = "event_id") -> DataFrame:
    """Rows whose key has no record yet."""
    return events.join(existing.select(key), key, "left_anti")


def exception_detail(
    exceptions: DataFrame,
    customers: DataFrame,
    services: DataFrame,
    sla: DataFrame,
    exception_id: str | None = None,
) -> DataFrame:
    """Exceptions with nested customer and service and their SLA state; an unknown id gives no row."""
    picked = exceptions if exception_id is None else exceptions.where(F.col("exception_id") == exception_id)
    spread = ["exception_id"]
    customer = customers.select("customer_id", "customer_name", "tier")
    service = services.select("service_id", "service_name", "service_category")
    rows = lookup(picked, customer, "customer_id", spread)
    rows = lookup(rows, service, "service_id", spread, counted_on=picked)
    rows = rows.join(sla.select("case_id", "sla_status", "remaining_minutes"), "case_id", "left")

    def known(name: str, default: object):
        return F.coalesce(F.col(name), F.lit(default))

    return rows.select(
        F.col("exception_id").alias("id"),
        "case_id",
        "event_id",
        F.struct(
            F.col("customer_id").alias("id"),
            known("customer_name", "Unknown").alias("name"),
            known("tier", "Standard").alias("tier"),
        ).alias("customer"),
        F.struct(
            F.col("service_id").alias("id"),
            known("service_name", "Unknown").alias("name"),
            known("service_category", "Operations").alias("category"),
        ).alias("service"),
        "financial_exposure",
        "priority_score",
        "priority_band",
        F.coalesce("reason_drivers", F.array().cast("array<string>")).alias("priority_drivers"),
        known("sla_status", "UNKNOWN").alias("sla_status"),
        known("remaining_minutes", 0.0).alias("sla_remaining_minutes"),
        "lifecycle_state",
        "created_at",
        "assigned_team",
    )


def triage_table(
    exceptions: DataFrame, customers: DataFrame, services: DataFrame, sla: DataFrame
) -> DataFrame:
    """The dense triage list: who, which service, how much time is left and why."""
    spread = ["exception_id"]
    rows = lookup(exceptions, customers.select("customer_id", "customer_name"), "customer_id", spread)
    service = services.select("service_id", "service_name", "service_category")
    rows = lookup(rows, service, "service_id", spread, counted_on=exceptions)
    rows = rows.join(sla.select("case_id", "sla_status", "remaining_minutes"), "case_id", "left")
    return rows.select(
        "exception_id",
        "case_id",
        "priority_band",
        "priority_score",
        "customer_name",
        F.col("service_name").alias("service"),
        "service_category",
        "sla_status",
        F.col("remaining_minutes").alias("time_remaining"),
        F.col("reason_drivers").alias("drivers"),
        "lifecycle_state",
        "assigned_team",
        (F.col("priority_score") >= 85.0).alias("is_highlighted"),
    )
