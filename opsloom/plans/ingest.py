"""Batch jobs: raw events to lake, quarantine and metrics; lake to cases."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsloom.operators import quality as Q
from opsloom.plans.cases import exception_records, score_cases, sla_records
from opsloom.session import staged
from opsloom.sources import lake as L


@dataclass(frozen=True)
class Zones:
    """Where the jobs write."""

    lake: str
    quarantine: str
    metrics: str
    cases: str
    index: str

    @classmethod
    def below(cls, root: str) -> Zones:
        root = root.rstrip("/")
        return cls(
            f"{root}/processed/fact_operational_event",
            f"{root}/rejected/events",
            f"{root}/rejected/dq_metrics_summary",
            f"{root}/processed",
            f"{root}/processed/event_ids",
        )


def ingest(
    raw: DataFrame,
    zones: Zones,
    as_of: Q.Clock,
    customers: DataFrame | None = None,
    services: DataFrame | None = None,
    locations: DataFrame | None = None,
    whole_days: bool = False,
    run: str | None = None,
) -> DataFrame:
    """Validate a raw batch, write its three outputs and return the metrics row.

    The flagged rows are staged once, split by outcome, so lake and quarantine each read only their
    half and the rules run a single time. A batch may be run again: the lake takes only ids its index
    lacks, and
    the quarantine keeps one copy per `run`, which is by default a hash of the raw rows: a later run of
    the same batch, at another clock, replaces what was rejected.

    The raw rows are staged as well, dealt over all tasks by their ordinal: a file of one row group is
    read by one task, which would otherwise judge all of it, at each of the rules' passes.
    """
    raw = staged(raw.repartition("seq"), "raw")
    flagged = Q.validate_events(raw, as_of, customers, services, locations)
    table = staged(flagged.withColumn("_rejected", Q.is_rejected()), "flagged", ("_rejected",))
    valid = table.where(~F.col("_rejected")).drop("_rejected", "rejection_reasons")
    rejected = table.where("_rejected").drop("_rejected")
    L.write_event_lake(valid, zones.lake, whole_days, zones.index)
    L.write_quarantine(Q.quarantine_envelope(rejected, as_of), zones.quarantine, run=run or _batch_id(table, raw.columns))
    metrics = Q.dq_metrics(table)
    L.write_dq_metrics(metrics, zones.metrics)
    return metrics


def _batch_id(batch: DataFrame, raw: list[str]) -> str:
    """Equal for equal raw rows, in any order, whatever clock or dimensions judged them."""
    row = F.xxhash64(*[c for c in raw if c != "seq"])
    total, size = batch.agg(F.sum(row.cast("decimal(38,0)")), F.count(F.lit(1))).first()
    return f"{size}-{int(total or 0) % (1 << 64):x}" if size else "0"


def build_cases(
    spark: SparkSession,
    events: DataFrame,
    zones: Zones,
    customers: DataFrame,
    services: DataFrame,
    as_of: Q.Clock,
    known: DataFrame | None = None,
    **options,
) -> DataFrame:
    """Score new failures, append SLA and exception records and return the staged cases.

    `known` are the exceptions that exist; by default those the target holds.
    """
    if known is None:
        known = L.stored_or_none(lambda: L.read_exceptions(spark, zones.cases))
    cases = staged(
        score_cases(events, customers, services, as_of, existing=known, **options), "cases"
    )
    L.write_cases(sla_records(cases), exception_records(cases), zones.cases)
    return cases
