"""Case keys, SLA and priority rules as Column expressions."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsloom.functions.barrier import computed_once, present
from opsloom.functions.rounding import round_binary, stable_hash

# Default weights of the five factors and thresholds of the SLA states.
WEIGHTS = {"sla": 0.35, "customer": 0.25, "financial": 0.20, "age": 0.10, "criticality": 0.10}
WARN_RATIO = 0.80
BREACH_RATIO = 1.00
DEFAULT_TIER = "Retail"
DEFAULT_SLA_MINUTES = 120
DEFAULT_TEAM = "Core Infrastructure"
PAYMENT_TEAM = "Payment Operations"

# Exposure range in dollars per tier, used only when no measured exposure is given.
EXPOSURE_RANGES = {"Enterprise": (50000, 250000), "Commercial": (5000, 45000)}
EXPOSURE_DEFAULT_RANGE = (200, 4000)


# --- keys ---------------------------------------------------------------------------------------


def case_number(event_id: Column) -> Column:
    return F.replace(event_id, F.lit("EVT-"), F.lit(""))


def sla_id(event_id: Column) -> Column:
    return F.concat(F.lit("SLA-"), case_number(event_id))


def exception_id(event_id: Column) -> Column:
    return F.concat(F.lit("EXC-"), case_number(event_id))


def case_id(event_id: Column) -> Column:
    return F.concat(F.lit("CASE-"), event_id)


# --- SLA ----------------------------------------------------------------------------------------


def sla_target(tier: Column, severity: Column, default_minutes: Column) -> Column:
    """Minutes allowed. Tier and severity match exactly, case included."""
    # The tightest target per tier and severity.
    caps = {
        ("Enterprise", "Critical"): 60,
        ("Enterprise", "High"): 120,
        ("Commercial", "Critical"): 180,
    }
    target = default_minutes
    for (t, s), cap in caps.items():
        target = F.when((tier == t) & (severity == s), F.least(F.lit(cap), default_minutes)).otherwise(
            target
        )
    return target


def with_sla_state(
    df: DataFrame,
    start: str = "start_time",
    clock: str = "clock",
    target: str = "target_minutes",
    warn: float = WARN_RATIO,
    breach: float = BREACH_RATIO,
) -> DataFrame:
    """Elapsed and remaining minutes, consumption ratio, waiting hours and SLA status at the clock.

    The order of rounding is part of the contract: the ratio comes from the rounded minutes and
    the status from the rounded ratio.
    """
    micros = F.greatest(F.unix_micros(clock) - F.unix_micros(start), F.lit(0))
    minutes = micros.cast("double") / F.lit(1e6) / F.lit(60.0)
    allowed = F.greatest(F.lit(1), F.col(target)).cast("double")
    timed = df.withColumn("elapsed_minutes", round_binary(minutes, 2)).withColumns(
        {
            "remaining_minutes": round_binary(F.col(target) - F.col("elapsed_minutes"), 2),
            "consumption_ratio": round_binary(F.col("elapsed_minutes") / allowed, 4),
            "unassigned_hours": unassigned_hours(F.col("elapsed_minutes")),
        }
    )
    fixed = computed_once(
        timed, ["elapsed_minutes", "remaining_minutes", "consumption_ratio", "unassigned_hours"]
    )
    ratio = F.col("consumption_ratio")
    return fixed.withColumn(
        "sla_status",
        F.when(ratio >= F.lit(breach), "BREACHED")
        .when(ratio >= F.lit(warn), "AT_RISK")
        .otherwise("ON_TRACK"),
    )


def due_time(start: Column, target: Column) -> Column:
    return F.timestamp_add("MINUTE", target, start)


def with_breach_measures(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "breach_magnitude_minutes": F.greatest(F.lit(0.0), F.lit(0.0) - F.col("remaining_minutes")),
            "is_breached": (F.col("sla_status") == "BREACHED").cast("int"),
            "is_at_risk": (F.col("sla_status") == "AT_RISK").cast("int"),
        }
    )


def unassigned_hours(elapsed_minutes: Column) -> Column:
    return round_binary(elapsed_minutes / F.lit(60.0), 1)


# --- case attributes ----------------------------------------------------------------------------


def scoring_severity(tier: Column) -> Column:
    return F.when(tier == "Enterprise", "Critical").otherwise("High")


def exposure_fallback(tier: Column, event_id: Column) -> Column:
    """A repeatable stand-in in the tier's range: the hash of the event id picks the cent."""

    def pick(low: int, high: int) -> Column:
        cents = stable_hash(event_id) % ((high - low) * 100 + 1)
        return F.lit(float(low)) + cents / F.lit(100.0)

    value = pick(*EXPOSURE_DEFAULT_RANGE)
    for name, bounds in EXPOSURE_RANGES.items():
        value = F.when(tier == name, pick(*bounds)).otherwise(value)
    return round_binary(value, 2)


def assigned_team(service_name: Column, pattern: str = "Payment") -> Column:
    return F.when(F.coalesce(service_name, F.lit("")).contains(pattern), PAYMENT_TEAM).otherwise(
        DEFAULT_TEAM
    )


# --- priority -----------------------------------------------------------------------------------


def s_sla(status: Column, ratio: Column) -> Column:
    return (
        F.when(status == "BREACHED", F.lit(100.0))
        .when(
            status == "AT_RISK",
            F.least(F.lit(100.0), F.lit(80.0) + (ratio - F.lit(0.80)) * F.lit(100.0)),
        )
        .otherwise(F.least(F.lit(75.0), ratio * F.lit(75.0)))
    )


def s_customer(tier: Column) -> Column:
    up = F.upper(tier)
    return (
        F.when(up.contains("ENTERPRISE"), 100.0).when(up.contains("COMMERCIAL"), 60.0).otherwise(30.0)
    )


def s_financial(exposure: Column) -> Column:
    # 100,000 dollars reach the full 100 on the log scale.
    orders = F.log10(F.greatest(F.lit(1.0), exposure))
    return F.least(F.lit(100.0), orders / F.lit(5.0) * F.lit(100.0))


def s_age(hours: Column) -> Column:
    return F.least(F.lit(100.0), hours / F.lit(24.0) * F.lit(100.0))


def s_criticality(severity: Column) -> Column:
    up = F.upper(severity)
    return (
        F.when(up.contains("CRITICAL"), 100.0)
        .when(up.contains("HIGH"), 75.0)
        .when(up.contains("MEDIUM"), 40.0)
        .otherwise(10.0)
    )


def checked_weights(weights: Mapping[str, float] | None = None) -> dict[str, float]:
    """The five weights with defaults filled in; they must sum to 1."""
    full = {**WEIGHTS, **(weights or {})}
    unknown = set(full) - set(WEIGHTS)
    if unknown:
        raise ValueError(f"unknown weights: {sorted(unknown)}")
    total = sum(full.values())
    if not math.isclose(total, 1.0, rel_tol=1e-3):
        raise ValueError(f"priority weights must sum to 1, got {total}")
    return full


def priority_band(score: Column) -> Column:
    return (
        F.when(score >= 85.0, "P1").when(score >= 70.0, "P2").when(score >= 45.0, "P3").otherwise("P4")
    )


def _fixed(x: Column, digits: int) -> Column:
    return F.translate(F.format_number(x, digits), ",", "")


def priority_drivers(
    status: Column, remaining: Column, tier: Column, exposure: Column, hours: Column, severity: Column
) -> Column:
    """Reasons in rule order; a plain case gets the one fallback text."""
    # The wording of the reasons.
    overdue = F.concat(F.lit("SLA breached (overdue by "), _fixed(F.abs(remaining), 1), F.lit(" min)"))
    imminent = F.concat(
        F.lit("SLA breach imminent in "), _fixed(F.greatest(F.lit(0.0), remaining), 1), F.lit(" minutes")
    )
    money = F.concat(F.lit("High financial exposure ($"), F.format_number(exposure, 2), F.lit(")"))
    waiting = F.concat(
        F.lit("Unassigned waiting time ("), _fixed(hours, 1), F.lit(" hrs) exceeds SLA triage standard")
    )
    found = [
        F.when(status == "BREACHED", overdue).when(status == "AT_RISK", imminent),
        F.when(F.upper(tier).contains("ENTERPRISE"), F.lit("Tier 1 Enterprise customer account")),
        F.when(exposure >= 25000, money),
        F.when(hours >= 4.0, waiting),
        F.when(F.upper(severity).contains("CRITICAL"), F.lit("Mission-critical service failure")),
    ]
    plain = (
        ~status.isin("BREACHED", "AT_RISK")
        & ~F.upper(tier).contains("ENTERPRISE")
        & ~(exposure >= 25000)
        & ~(hours >= 4.0)
        & ~F.upper(severity).contains("CRITICAL")
    )
    fallback = F.when(plain, F.lit("Standard operational queue ranking"))
    return present(*found, fallback)


def with_priority(
    df: DataFrame,
    weights: Mapping[str, float] | None = None,
    status: str = "sla_status",
    ratio: str = "consumption_ratio",
    remaining: str = "remaining_minutes",
    tier: str = "tier",
    exposure: str = "financial_exposure",
    hours: str = "unassigned_hours",
    severity: str = "severity",
) -> DataFrame:
    """Score 0-100, band and reasons. Wrong weights fail here, when the plan is built."""
    w = checked_weights(weights)
    c = F.col
    raw = (
        F.lit(w["sla"]) * s_sla(c(status), c(ratio))
        + F.lit(w["customer"]) * s_customer(c(tier))
        + F.lit(w["financial"]) * s_financial(c(exposure))
        + F.lit(w["age"]) * s_age(c(hours))
        + F.lit(w["criticality"]) * s_criticality(c(severity))
    )
    scored = df.withColumn("_raw_score", raw).withColumn(
        "priority_score",
        F.least(F.lit(100.0), F.greatest(F.lit(0.0), round_binary(c("_raw_score"), 2))),
    )
    return computed_once(scored.drop("_raw_score"), ["priority_score"]).withColumns(
        {
            "priority_band": priority_band(c("priority_score")),
            "reason_drivers": priority_drivers(
                c(status), c(remaining), c(tier), c(exposure), c(hours), c(severity)
            ),
        }
    )


def with_error_flags(df: DataFrame) -> DataFrame:
    """`is_error` for server errors; a message text for every status of 400 and above."""
    status = F.col("status_code")
    return df.withColumns(
        {
            "is_error": status >= 500,
            "error_message": F.when(
                status >= 400, F.concat(F.lit("Service exception HTTP "), status.cast("string"))
            ),
        }
    )
