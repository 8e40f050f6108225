"""Declared schemas and fixed vocabularies."""

from __future__ import annotations

from pyspark.sql import types as T


TYPES = {
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "long": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "array<string>": T.ArrayType(T.StringType()),
}


def struct(spec: str) -> T.StructType:
    """A schema from "name type, ..." text, usable before a session exists."""
    pairs = [field.split() for field in spec.split(",")]
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


# Raw input stays untyped where validation must see bad values: the timestamp is text.
RAW_EVENT = struct(
    "event_id string, timestamp string, customer_id string, service_id string, location_id string, "
    "event_type string, duration_ms long, payload_bytes long, status_code long, error_message string"
)

EVENT = struct(
    "event_id string, timestamp timestamp, customer_id string, service_id string, location_id string, "
    "event_type string, duration_ms long, payload_bytes long, status_code long, error_message string"
)

LAKE_EVENT = struct(
    "event_id string, timestamp timestamp, customer_id string, service_id string, location_id string, "
    "event_type string, duration_ms long, payload_bytes long, status_code long, error_message string, "
    "hour int, day_of_week string, is_weekend boolean, year string, month string, day string"
)
LAKE_PARTITIONS = ("year", "month", "day")

CUSTOMER = struct(
    "customer_id string, customer_name string, tier string, contract_sla_tier string, industry string"
)
SERVICE = struct(
    "service_id string, service_name string, service_category string, tier_level int, "
    "default_sla_minutes int"
)
LOCATION = struct("location_id string, region string, datacenter_zone string, country string")
AGENT = struct("agent_id string, agent_name string, team_name string, skill_level int, shift string")

SLA_RECORD = struct(
    "sla_id string, case_id string, customer_id string, service_id string, start_time timestamp, "
    "due_time timestamp, target_minutes int, elapsed_minutes double, remaining_minutes double, "
    "sla_status string"
)
EXCEPTION_RECORD = struct(
    "exception_id string, case_id string, event_id string, customer_id string, service_id string, "
    "location_id string, financial_exposure double, priority_score double, priority_band string, "
    "lifecycle_state string, reason_drivers array<string>, created_at timestamp, updated_at timestamp, "
    "assigned_team string, assigned_agent string"
)

# Vocabularies of the record contracts, in their natural order.
CUSTOMER_TIERS = ("Enterprise", "Commercial", "Retail")
CONTRACT_TIERS = ("Gold", "Silver", "Bronze")
SLA_STATES = ("ON_TRACK", "AT_RISK", "BREACHED")
PRIORITY_BANDS = ("P1", "P2", "P3", "P4")
LIFECYCLE_STATES = ("DETECTED", "TRIAGED", "ASSIGNED", "IN_PROGRESS", "RESOLVED", "CLOSED")
CLOSED_STATES = ("RESOLVED", "CLOSED")
SEVERITIES = ("Critical", "High", "Medium", "Low")

# Rejection codes of the data-quality pass, in rule order.
ERR_DUPLICATE_ID = "ERR_DUPLICATE_ID"
ERR_NULL_MANDATORY = "ERR_NULL_MANDATORY"
ERR_INVALID_TIMESTAMP = "ERR_INVALID_TIMESTAMP"
ERR_FUTURE_TIMESTAMP = "ERR_FUTURE_TIMESTAMP"
ERR_NEGATIVE_DURATION = "ERR_NEGATIVE_DURATION"
ERR_INVALID_STATUS_CODE = "ERR_INVALID_STATUS_CODE"
ERR_FK_CUSTOMER_ORPHAN = "ERR_FK_CUSTOMER_ORPHAN"
ERR_FK_SERVICE_ORPHAN = "ERR_FK_SERVICE_ORPHAN"
ERR_FK_LOCATION_ORPHAN = "ERR_FK_LOCATION_ORPHAN"
REJECTION_CODES = (
    ERR_DUPLICATE_ID,
    ERR_NULL_MANDATORY,
    ERR_INVALID_TIMESTAMP,
    ERR_FUTURE_TIMESTAMP,
    ERR_NEGATIVE_DURATION,
    ERR_INVALID_STATUS_CODE,
    ERR_FK_CUSTOMER_ORPHAN,
    ERR_FK_SERVICE_ORPHAN,
    ERR_FK_LOCATION_ORPHAN,
)

# Legal lifecycle moves.
LEGAL_TRANSITIONS = {
    "DETECTED": ("TRIAGED", "CLOSED"),
    "TRIAGED": ("ASSIGNED",),
    "ASSIGNED": ("IN_PROGRESS", "TRIAGED"),
    "IN_PROGRESS": ("RESOLVED", "ASSIGNED"),
    "RESOLVED": ("CLOSED", "IN_PROGRESS"),
    "CLOSED": (),
}
