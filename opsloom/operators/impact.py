"""Modelled benefit of faster triage and fewer breaches, on measured volumes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsloom.functions.rounding import round_binary

# Default parameters of the benefit model.
DEFAULTS = {
    "volume": 15000,
    "current_pct": 11.8,
    "target_pct": 7.2,
    "manual_minutes": 14.0,
    "assisted_minutes": 3.5,
    "penalty_usd": 1250.0,
    "hourly_usd": 65.0,
}
BREACH_DELTAS = (0.02, 0.03, 0.046, 0.06, 0.08)


def _parameter(name: str, given: dict[str, Column | float | str]) -> Column:
    value = given.get(name, DEFAULTS[name])
    if isinstance(value, str):
        value = F.col(value)
    return value.cast("double") if isinstance(value, Column) else F.lit(float(value))


def with_impact(df: DataFrame, **parameters: Column | float | str) -> DataFrame:
    """Hours, breaches and dollars saved; every parameter is a number, a column or a column name.

    Volume is per month. The steps of the arithmetic are in the contract's order, because the
    avoided count is cut, not rounded.
    """
    unknown = set(parameters) - set(DEFAULTS)
    if unknown:
        raise ValueError(f"unknown parameters: {sorted(unknown)}")
    p = {name: _parameter(name, parameters) for name in DEFAULTS}
    hours = p["volume"] * p["manual_minutes"] / 60.0 - p["volume"] * p["assisted_minutes"] / 60.0
    avoided = F.greatest(
        F.lit(0.0), p["volume"] * (p["current_pct"] / 100.0) - p["volume"] * (p["target_pct"] / 100.0)
    )
    c = F.col
    return (
        df.withColumns({"_hours": hours, "_avoided": avoided * 12.0})
        .withColumns(
            {"_labor": c("_hours") * 12.0 * p["hourly_usd"], "_penalty": c("_avoided") * p["penalty_usd"]}
        )
        .withColumns(
            {
                "monthly_triage_hours_saved": round_binary(c("_hours"), 1),
                "annual_triage_hours_saved": round_binary(c("_hours") * 12.0, 1),
                "annual_labor_value_usd": round_binary(c("_labor"), 2),
                "annual_sla_breaches_prevented": c("_avoided").cast("long"),
                "annual_sla_penalty_avoidance_usd": round_binary(c("_penalty"), 2),
                "total_annual_economic_benefit_usd": round_binary(c("_labor") + c("_penalty"), 2),
            }
        )
        .drop("_hours", "_avoided", "_labor", "_penalty")
    )


def segment_volumes(cases: DataFrame, by: Sequence[str], start: str = "start_time") -> DataFrame:
    """Measured cases and breach rate per calendar month and segment."""
    return (
        cases.groupBy(F.date_format(start, "yyyy-MM").alias("month"), *by)
        .agg(
            F.count(F.lit(1)).alias("monthly_incident_volume"),
            F.count_if(F.col("sla_status") == "BREACHED").alias("breached_cases"),
        )
        .withColumn(
            "current_breach_rate_pct",
            F.col("breached_cases").cast("double") / F.col("monthly_incident_volume").cast("double") * F.lit(100.0),
        )
    )


def impact_by_segment(cases: DataFrame, by: Sequence[str], **parameters: Column | float | str) -> DataFrame:
    measured = {"volume": "monthly_incident_volume", "current_pct": "current_breach_rate_pct"}
    return with_impact(segment_volumes(cases, by), **{**parameters, **measured})


def impact_sensitivity(
    volumes: DataFrame, volume: str = "monthly_incident_volume", deltas: Sequence[float] = BREACH_DELTAS
) -> DataFrame:
    """Net benefit of every segment under every breach reduction."""
    minutes = DEFAULTS["manual_minutes"] - DEFAULTS["assisted_minutes"]
    grid = volumes.withColumn("breach_delta", F.explode(F.array(*[F.lit(float(d)) for d in deltas])))
    v = F.col(volume).cast("double")
    labor = v * F.lit(minutes / 60.0) * 12.0 * DEFAULTS["hourly_usd"]
    penalty = v * F.col("breach_delta") * 12.0 * DEFAULTS["penalty_usd"]
    return grid.withColumn("net_benefit_usd", labor + penalty)
