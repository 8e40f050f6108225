"""Data-quality rules, routing, reports and assertions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsloom import schemas as S
from opsloom.functions.barrier import computed_once, present
from opsloom.functions.calendar import parse_iso
from opsloom.functions.rounding import round_binary, stable_hash
from opsloom.operators.scale import all_of, any_of, join_back, lookup, lookup_uncounted, running

Clock = str | datetime | Column

DIMENSION_KEYS = ("customer_id", "service_id", "location_id")


def clock_column(as_of: Clock) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")


def missing(name: str) -> Column:
    """NULL or the empty text; blanks count as present."""
    return F.col(name).isNull() | (F.col(name) == "")


# --- row rules: a code, or NULL when the row passes -----------------------------------------------


def null_id(key: str = "event_id") -> Column:
    return F.when(missing(key), F.lit(S.ERR_NULL_MANDATORY))


def null_mandatory(columns: Sequence[str] = (*DIMENSION_KEYS, "timestamp")) -> Column:
    return F.when(any_of([missing(c) for c in columns]), F.lit(S.ERR_NULL_MANDATORY))


def invalid_timestamp(column: str = "timestamp", parsed: str | None = None) -> Column:
    time = parse_iso(F.col(column)) if parsed is None else F.col(parsed)
    return F.when(~missing(column) & time.isNull(), F.lit(S.ERR_INVALID_TIMESTAMP))


def future_timestamp(as_of: Clock, column: str = "timestamp", parsed: str | None = None) -> Column:
    time = parse_iso(F.col(column)) if parsed is None else F.col(parsed)
    return F.when(time > clock_column(as_of), F.lit(S.ERR_FUTURE_TIMESTAMP))


def negative_duration(column: str = "duration_ms") -> Column:
    return F.when(F.col(column) < 0, F.lit(S.ERR_NEGATIVE_DURATION))


def status_range(column: str = "status_code") -> Column:
    c = F.col(column)
    return F.when(c.isNull() | ~c.between(100, 599), F.lit(S.ERR_INVALID_STATUS_CODE))


def clock_skew(as_of: Clock, start: str = "start_time") -> Column:
    return F.col(start) > clock_column(as_of)


# --- rules that need other rows ---------------------------------------------------------------


def mark_duplicates(
    df: DataFrame, keys: Sequence[str], seq: str, flag: str = "_duplicate", **hot: int
) -> DataFrame:
    """Flag every row whose key occurred at a smaller ordinal; rows without a key are never flagged.

    Only ids that occur more than once go back to the rows. A window over the id would sort a hot
    id's rows in one task; a minimum per id is combined before the shuffle. The repeated ids are
    ready before the rows move, so where they are measured small the rows are not shuffled at all.
    """
    lacks_key = any_of([missing(k) for k in keys])
    repeated = (
        df.where(~lacks_key)
        .groupBy(*keys)
        .agg(F.min(seq).alias("_first"), F.count(F.lit(1)).alias("_copies"))
        .where(F.col("_copies") > 1)
    )
    joined = join_back(df, repeated, keys, "_copies", [seq], unmatched=lacks_key, **hot)
    later = F.coalesce(F.col(seq) > F.col("_first"), F.lit(False))
    return joined.withColumn(flag, later).drop("_first", "_copies")


def mark_orphans(
    df: DataFrame,
    dim: DataFrame | None,
    key: str,
    flag: str,
    spread_by: Sequence[str] | None,
    counted_on: DataFrame | None = None,
) -> DataFrame:
    """Flag rows whose present key is not in the dimension; no dimension, or an empty one, flags none.

    `spread_by` None keeps to one join without counting the rows, the form a stream-static join needs.
    """
    if dim is None:
        return df.withColumn(flag, F.lit(False))
    known = dim.select(key).where(~missing(key)).distinct()
    filled = known.limit(1).agg((F.count(F.lit(1)) > 0).alias("filled")).scalar()
    marked = known.withColumn("_known", F.lit(True))
    if spread_by is None:
        joined = lookup_uncounted(df, marked, key)
    else:
        joined = lookup(df, marked, key, spread_by, counted_on)
    return joined.withColumn(flag, filled & ~missing(key) & F.col("_known").isNull()).drop("_known")


def _coded(flag: str, code: str) -> Column:
    return F.when(F.col(flag), F.lit(code))


def reasons(as_of: Clock) -> Column:
    """All codes of a row in rule order, repeats kept. Reads the parsed time and the marked flags."""
    return present(
        F.coalesce(null_id(), _coded("_duplicate", S.ERR_DUPLICATE_ID)),
        null_mandatory(),
        F.coalesce(invalid_timestamp(parsed="_time"), future_timestamp(as_of, parsed="_time")),
        negative_duration(),
        status_range(),
        _coded("_no_customer", S.ERR_FK_CUSTOMER_ORPHAN),
        _coded("_no_service", S.ERR_FK_SERVICE_ORPHAN),
        _coded("_no_location", S.ERR_FK_LOCATION_ORPHAN),
    )


def with_reasons(
    df: DataFrame,
    as_of: Clock,
    customers: DataFrame | None = None,
    services: DataFrame | None = None,
    locations: DataFrame | None = None,
    spread_by: Sequence[str] | None = None,
    counted_on: DataFrame | None = None,
) -> DataFrame:
    """Row-level rules on rows that already carry `_duplicate`."""
    counted_on = df if counted_on is None else counted_on
    for dim, key, flag in (
        (customers, "customer_id", "_no_customer"),
        (services, "service_id", "_no_service"),
        (locations, "location_id", "_no_location"),
    ):
        df = mark_orphans(df, dim, key, flag, spread_by, counted_on)
    timed = df.withColumn("_time", parse_iso(F.col("timestamp")))
    judged = timed.withColumn("rejection_reasons", reasons(as_of)).drop(
        "_time", "_duplicate", "_no_customer", "_no_service", "_no_location"
    )
    return computed_once(judged, ["rejection_reasons"])


def validate_events(
    df: DataFrame,
    as_of: Clock,
    customers: DataFrame | None = None,
    services: DataFrame | None = None,
    locations: DataFrame | None = None,
    seq: str = "seq",
    **hot: int,
) -> DataFrame:
    """Raw events plus `rejection_reasons`; an empty array means the row is valid."""
    flagged = mark_duplicates(df, ["event_id"], seq, **hot)
    return with_reasons(flagged, as_of, customers, services, locations, [seq], counted_on=df)


# --- routing and reports ------------------------------------------------------------------------


def is_rejected() -> Column:
    return F.size("rejection_reasons") > 0


def route(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows unchanged, rejected rows with their reasons). Stage `flagged` first to run it once."""
    valid = flagged.where(~is_rejected()).drop("rejection_reasons")
    return valid, flagged.where(is_rejected())


def quarantine_envelope(rejected: DataFrame, as_of: Clock) -> DataFrame:
    record = [c for c in rejected.columns if c != "rejection_reasons"]
    return rejected.select(
        F.struct(*record).alias("raw_record"),
        "rejection_reasons",
        clock_column(as_of).alias("quarantined_at"),
    )


def _summary(rejected_rows: Column, all_rows: Column) -> list[Column]:
    accepted = all_rows - rejected_rows
    share = accepted.cast("double") / F.greatest(F.lit(1), all_rows).cast("double") * F.lit(100.0)
    return [
        all_rows.alias("rows_processed"),
        accepted.alias("rows_valid"),
        rejected_rows.alias("rows_rejected"),
        round_binary(share, 2).alias("acceptance_rate_pct"),
    ]


def dq_summary(flagged: DataFrame) -> DataFrame:
    totals = flagged.agg(
        F.count_if(is_rejected()).alias("_rejected"), F.count(F.lit(1)).alias("_all")
    )
    return totals.select(*_summary(F.col("_rejected"), F.col("_all")))


def _reason_lists(flagged: DataFrame) -> DataFrame:
    """Rows per reason list, the empty one included: the few groups all reports are made of."""
    return flagged.groupBy("rejection_reasons").agg(F.count(F.lit(1)).alias("_n"))


def _total(weight: Column) -> Column:
    return F.coalesce(F.sum(weight * F.col("_n")), F.lit(0)).cast("long")


def _code_counts() -> list[Column]:
    def hits(code: str) -> Column:
        return _total(F.size(F.filter("rejection_reasons", lambda r: r == F.lit(code)))).alias(code)

    return [hits(code) for code in S.REJECTION_CODES]


def error_distribution(flagged: DataFrame) -> DataFrame:
    """Count per code, all nine codes present. Repeats within a row count again."""
    pairs = F.array(
        *[
            F.struct(F.lit(code).alias("error_code"), F.col(code).alias("error_count"))
            for code in S.REJECTION_CODES
        ]
    )
    return _reason_lists(flagged).agg(*_code_counts()).select(F.inline(pairs))


def dq_metrics(flagged: DataFrame) -> DataFrame:
    """The one-row metrics document: summary plus the distribution as a struct, in one pass."""
    totals = _reason_lists(flagged).agg(
        _total(is_rejected().cast("int")).alias("_rejected"), _total(F.lit(1)).alias("_all"), *_code_counts()
    )
    distribution = F.struct(*S.REJECTION_CODES).alias("error_distribution")
    return totals.select(*_summary(F.col("_rejected"), F.col("_all")), distribution)


# --- record contracts ---------------------------------------------------------------------------


def _outside(name: str, low: float | None = None, high: float | None = None, above: float | None = None) -> Column:
    c = F.col(name)
    bad = c.isNull()
    if low is not None:
        bad = bad | (c < low)
    if high is not None:
        bad = bad | (c > high)
    if above is not None:
        bad = bad | (c <= above)
    return bad


def _not_in(name: str, values: Sequence[str]) -> Column:
    return F.col(name).isNull() | ~F.col(name).isin(*values)


def contracts() -> dict[str, dict[str, Column]]:
    """Per record kind: rule name -> condition under which a row violates it."""
    return {
        "customer": {
            "tier": _not_in("tier", S.CUSTOMER_TIERS),
            "contract_sla_tier": _not_in("contract_sla_tier", S.CONTRACT_TIERS),
        },
        "service": {
            "tier_level": _outside("tier_level", 1, 3),
            "default_sla_minutes": _outside("default_sla_minutes", above=0),
        },
        "location": {c: F.col(c).isNull() for c in S.LOCATION.names},
        "agent": {"skill_level": _outside("skill_level", 1, 5)},
        "event": {
            "duration_ms": F.col("duration_ms") < 0,
            "payload_bytes": F.col("payload_bytes") < 0,
            "status_code": _outside("status_code", 100, 599),
        },
        "sla": {
            "target_minutes": _outside("target_minutes", above=0),
            "elapsed_minutes": _outside("elapsed_minutes", 0),
            "sla_status": _not_in("sla_status", S.SLA_STATES),
        },
        "exception": {
            "financial_exposure": _outside("financial_exposure", 0),
            "priority_score": _outside("priority_score", 0, 100),
            "priority_band": _not_in("priority_band", S.PRIORITY_BANDS),
            "lifecycle_state": _not_in("lifecycle_state", S.LIFECYCLE_STATES),
        },
    }


def with_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Names of the violated rules per row."""
    return df.withColumn(
        "violations", present(*[F.when(bad, F.lit(name)) for name, bad in rules.items()])
    )


def check_constraints(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Violations per rule, every rule present, in one pass."""
    totals = df.agg(*[F.count_if(bad).alias(name) for name, bad in rules.items()])
    pairs = F.array(
        *[F.struct(F.lit(name).alias("rule"), F.col(name).alias("violations")) for name in rules]
    )
    return totals.select(F.inline(pairs))


# --- assertions over stored tables --------------------------------------------------------------


def assert_no_duplicate_ids(df: DataFrame, key: str = "event_id") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("duplicate_count")).where("duplicate_count > 1")


def assert_no_negative_duration(df: DataFrame) -> DataFrame:
    return df.agg(F.count_if(F.col("duration_ms") < 0).alias("negative_duration_count"))


def assert_no_orphan_exceptions(exceptions: DataFrame, events: DataFrame) -> DataFrame:
    orphans = exceptions.join(events.select("event_id"), "event_id", "left_anti")
    return orphans.agg(F.count(F.lit(1)).alias("orphan_exception_count"))


def assert_score_bounds(exceptions: DataFrame) -> DataFrame:
    score = F.col("priority_score")
    return exceptions.agg(F.count_if((score < 0) | (score > 100)).alias("out_of_bounds_priority_count"))


# --- lifecycle and reconciliation ---------------------------------------------------------------

# Microseconds.
DAY = 86_400_000_000
SECOND = 1_000_000


def _is_legal(before: Column, after: Column) -> Column:
    moves = [(before == a) & after.isin(*bs) for a, bs in S.LEGAL_TRANSITIONS.items() if bs]
    return any_of(moves)


def illegal_transitions(log: DataFrame) -> DataFrame:
    """State changes that are not in the matrix, with the state before; any move out of CLOSED is one.

    The previous state is the latest (time, seq, state) strictly before the row, taken as a running
    maximum in bounded time chunks, so a case with very many changes is not one task.
    """
    steps = log.withColumn("_at", F.unix_micros("changed_at"))
    latest = {"_prev": ("max", F.struct("_at", "seq", "state"))}
    seen = running(
        steps, ["case_id"], "_at", latest, coarse=DAY, fine=SECOND, inclusive=False, tie_break=["seq"]
    )
    before = F.col("_prev.state")
    return seen.where(before.isNotNull() & ~_is_legal(before, F.col("state"))).select(
        "case_id", "changed_at", "seq", before.alias("from_state"), F.col("state").alias("to_state")
    )


def reconcile(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of two metric tables that differ or are on one side only. NULL equals NULL."""
    values = [c for c in a.columns if c not in keys]
    left = a.select(*keys, F.struct(*values).alias("left_values"))
    right = b.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys], F.struct(*values).alias("right_values")
    )
    same_key = all_of([F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return (
        left.join(right, same_key, "full")
        .where(~F.col("left_values").eqNullSafe(F.col("right_values")))
        .select(
            *[F.coalesce(F.col(k), F.col(f"_r_{k}")).alias(k) for k in keys], "left_values", "right_values"
        )
    )


# --- planted defects ----------------------------------------------------------------------------

# The kinds of planted defects, in their natural order.
DEFECTS = (
    "DUPLICATE_ID",
    "NULL_CUSTOMER",
    "FUTURE_TIMESTAMP",
    "NEGATIVE_DURATION",
    "INVALID_STATUS",
    "ORPHAN_SERVICE",
)


def inject_defects(df: DataFrame, rate: float, seed: int, as_of: Clock, seq: str = "seq") -> DataFrame:
    """Plant the six defects in raw events at `rate`, the same rows for the same seed.

    A duplicate takes the id of a row with a smaller ordinal that the hash picks evenly from all of
    them, so planted ids are no hotter in a larger input. `seq` is a whole number; where the row it
    picks is absent or has no id the event stays as it is.
    """
    n = F.col(seq)
    draw = stable_hash(n, F.lit(seed)) % 1_000_000
    kind = stable_hash(n, F.lit(seed), F.lit("kind")) % len(DEFECTS)
    defect = F.element_at(F.array(*map(F.lit, DEFECTS)), (kind + 1).cast("int"))
    marked = df.withColumn("_defect", F.when(draw < int(rate * 1_000_000), defect))
    d = F.col("_defect")
    repeats = F.coalesce(d == "DUPLICATE_ID", F.lit(False))
    next_year = F.date_format(clock_column(as_of) + F.expr("interval 365 days"), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    shortfall = F.lit(-1).cast("long") - stable_hash(n, F.lit(seed), F.lit("size")) % 2500
    changed = {
        "customer_id": F.when(d == "NULL_CUSTOMER", F.lit(None)).otherwise(F.col("customer_id")),
        "timestamp": F.when(d == "FUTURE_TIMESTAMP", next_year).otherwise(F.col("timestamp")),
        "duration_ms": F.when(d == "NEGATIVE_DURATION", shortfall).otherwise(F.col("duration_ms")),
        "status_code": F.when(d == "INVALID_STATUS", F.lit(777).cast("long")).otherwise(F.col("status_code")),
        "service_id": F.when(d == "ORPHAN_SERVICE", "no-such-service").otherwise(F.col("service_id")),
    }
    others = marked.where(~repeats).withColumns(changed).select(*df.columns)
    picked = stable_hash(n, F.lit(seed), F.lit("donor")) % F.greatest(n, F.lit(1))
    donors = df.where(~missing("event_id")).select(n.alias("_at"), F.col("event_id").alias("_id"))
    copies = marked.where(repeats).withColumn("_at", F.when(n > 0, picked)).join(donors, "_at", "left")
    return others.unionByName(
        copies.withColumn("event_id", F.coalesce("_id", "event_id")).select(*df.columns)
    )
