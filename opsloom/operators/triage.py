"""Backlog filters, the ranked queue and its pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from opsloom.functions.calendar import on_days
from opsloom.operators.quality import Clock, clock_column
from opsloom.operators.scale import positions
from opsloom.operators.windows import latest_by_key
from opsloom.schemas import CLOSED_STATES

PAGE_LIMIT = 500
RISK_LIMIT = 200
# Scores lie in 0-100; a histogram of tenths has so many steps, and one below for missing scores.
TENTHS = 1_000


def queue_order() -> list[Column]:
    return [F.col("priority_score").desc_nulls_last(), F.col("exception_id").asc_nulls_last()]


# --- filters ------------------------------------------------------------------------------------


def filter_exceptions(
    exceptions: DataFrame,
    priority: str | None = None,
    status: str | None = None,
    location: str | None = None,
    service: str | None = None,
    customer: str | None = None,
) -> DataFrame:
    """Any subset of the five filters; band and state are upper-cased first."""
    wanted = {
        "priority_band": priority.upper() if priority else None,
        "lifecycle_state": status.upper() if status else None,
        "location_id": location,
        "service_id": service,
        "customer_id": customer,
    }
    for name, value in wanted.items():
        if value:
            exceptions = exceptions.where(F.col(name) == value)
    return exceptions


def failed_events(events: DataFrame) -> DataFrame:
    return events.where(F.col("status_code") >= 500)


def incident_events(events: DataFrame) -> DataFrame:
    return events.where(F.col("status_code") >= 400)


def is_active() -> Column:
    return ~F.col("lifecycle_state").isin(*CLOSED_STATES)


def active_backlog(exceptions: DataFrame) -> DataFrame:
    return exceptions.where(is_active())


def at_risk_or_breached(sla: DataFrame) -> DataFrame:
    return sla.where(F.col("sla_status").isin("AT_RISK", "BREACHED"))


def partition_range(lake: DataFrame, year: str, month: str, first_day: str, last_day: str) -> DataFrame:
    """Days of one month, on the partition columns, so other days' files are never opened."""
    return lake.where(
        (F.col("year") == year) & (F.col("month") == month) & F.col("day").between(first_day, last_day)
    )


def recent(df: DataFrame, ts: str, as_of: Clock, hours: int) -> DataFrame:
    """Rows of the last hours; on the lake only their days are read."""
    clock = clock_column(as_of)
    start = clock - F.make_dt_interval(hours=F.lit(hours))
    return on_days(df, start, clock).where(F.col(ts).between(start, clock))


def slice_triage(
    table: DataFrame,
    bands: Sequence[str] = (),
    states: Sequence[str] = (),
    categories: Sequence[str] = (),
    teams: Sequence[str] = (),
) -> DataFrame:
    """Slicers over the triage table; an empty choice selects everything."""
    chosen = {
        "priority_band": bands,
        "lifecycle_state": states,
        "service_category": categories,
        "assigned_team": teams,
    }
    for name, values in chosen.items():
        if values:
            table = table.where(F.col(name).isin(*values))
    return table


# --- queue --------------------------------------------------------------------------------------


def triage_queue(items: DataFrame, version: str | None = None) -> DataFrame:
    """Live items by score, then id. With `version`, the last push of an id replaces earlier ones."""
    live = items if version is None else latest_by_key(items, "exception_id", version)
    return live.orderBy(*queue_order())


def peek(items: DataFrame, version: str | None = None) -> DataFrame:
    return triage_queue(items, version).limit(1)


def _tenth() -> Column:
    """The histogram step of a row: ordered like the scores, missing ones last."""
    score = F.col("priority_score").cast("double")
    inside = F.least(F.greatest(score, F.lit(0.0)), F.lit(100.0))
    step = F.when(F.isnan(score), TENTHS).otherwise(F.floor(inside * (TENTHS / 100))).cast("int")
    return F.when(score.isNull(), F.lit(-1)).otherwise(step)


def _places(items: DataFrame, last: int) -> tuple[DataFrame, DataFrame]:
    """(rows that may be among the first `last`, with their queue position; all others).

    A histogram of the scores, counted map-side, tells below which step no row can be; only the rows
    from there up are sorted, over as many tasks as they need.
    """
    steps = items.groupBy(_tenth().alias("_step")).agg(F.count(F.lit(1)).alias("_n"))
    above = F.coalesce(F.sum("_n").over(W.orderBy(F.desc("_step")).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    cut = steps.withColumn("_above", above).where(F.col("_above") < last).agg(F.min("_step")).first()[0]
    if cut is None:
        return positions(items.limit(0), queue_order()), items
    return positions(items.where(_tenth() >= cut), queue_order()), items.where(_tenth() < cut)


def take(items: DataFrame, n: int, version: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(the first n items, the remaining queue), both in queue order, for any n."""
    live = items if version is None else latest_by_key(items, "exception_id", version)
    placed, others = _places(live, n)
    first = placed.where(F.col("position") < n).orderBy("position").drop("position")
    rest = placed.where(F.col("position") >= n).drop("position").unionByName(others)
    return first, rest.orderBy(*queue_order())


def exception_page(
    exceptions: DataFrame,
    limit: int = 50,
    offset: int = 0,
    **filters: str | None,
) -> tuple[DataFrame, DataFrame]:
    """(one row with `total` before paging, the page by score and id).

    The page is found by queue position on score and id alone and then fetched; a deep page is as
    good as the first.
    """
    if not 1 <= limit <= PAGE_LIMIT or offset < 0:
        raise ValueError(f"limit must be 1-{PAGE_LIMIT} and offset >= 0, got {limit} and {offset}")
    kept = filter_exceptions(exceptions, **filters)
    total = kept.agg(F.count(F.lit(1)).alias("total"))
    ids = kept.select("priority_score", "exception_id")
    ids = _places(ids, offset + limit)[0].where(F.col("position").between(offset, offset + limit - 1))
    # At most PAGE_LIMIT ids: a bounded broadcast.
    page = kept.join(F.broadcast(ids.select("exception_id")), "exception_id", "left_semi").select(
        F.col("exception_id").alias("id"),
        "case_id",
        "event_id",
        "customer_id",
        "service_id",
        "location_id",
        "financial_exposure",
        "priority_score",
        "priority_band",
        "lifecycle_state",
        "reason_drivers",
        "created_at",
        "assigned_team",
    )
    return total, page.orderBy(F.col("priority_score").desc_nulls_last(), F.col("id").asc_nulls_last())


def sla_risk(sla: DataFrame, limit: int = 50) -> DataFrame:
    """Cases at risk or breached, least time left first."""
    if not 1 <= limit <= RISK_LIMIT:
        raise ValueError(f"limit must be 1-{RISK_LIMIT}, got {limit}")
    return (
        at_risk_or_breached(sla)
        .select(
            "sla_id",
            "case_id",
            "customer_id",
            "service_id",
            "target_minutes",
            "elapsed_minutes",
            "remaining_minutes",
            "sla_status",
            "due_time",
        )
        .orderBy(F.col("remaining_minutes").asc_nulls_last(), F.col("sla_id").asc_nulls_last())
        .limit(limit)
    )


def top_p1(exceptions: DataFrame, n: int = 10) -> DataFrame:
    return filter_exceptions(exceptions, priority="P1").orderBy(*queue_order()).limit(n)
