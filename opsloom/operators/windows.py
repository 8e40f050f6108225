"""Trailing-window counts, failure velocity and latest-version selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from opsloom.functions.calendar import on_days
from opsloom.functions.rounding import round_binary
from opsloom.operators.quality import Clock, clock_column
from opsloom.operators.scale import HOT_ROWS, all_of, chunk, join_back, running
from opsloom.session import staged

MINUTE = 60_000_000
HOUR = 60 * MINUTE


def breach_rate(breaches: Column, events: Column) -> Column:
    share = breaches.cast("double") / events.cast("double") * F.lit(100.0)
    return F.when(events > 0, round_binary(share, 2)).otherwise(F.lit(0.0))


def trailing_counts(
    df: DataFrame, ts: str, flag: Column, minutes: int = 60, by: Sequence[str] = ()
) -> DataFrame:
    """One row per (by, instant) with an event: counts over [instant - minutes, instant].

    Every event adds one at its instant and takes it back one microsecond after it leaves the
    window, so the trailing count is a running sum. Steps are combined per instant before the
    shuffle, and `running` keeps every task bounded: one key or one hour may hold any share of rows.
    """
    width = minutes * MINUTE
    at = F.unix_micros(ts)
    hit = flag.cast("long")
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")

    def step(moment: Column, enters: Column, leaves: Column, hits: Column) -> Column:
        return F.struct(moment.alias("_at"), enters.alias("_rows"), leaves.alias("_left"), hits.alias("_hits"))

    keyed = df.where(all_of([F.col(c).isNotNull() for c in (ts, *by)]))
    steps = (
        keyed.select(
            *by, F.inline(F.array(step(at, one, none, hit), step(at + F.lit(width + 1), none, one, -hit)))
        )
        .groupBy(*by, "_at")
        .agg(F.sum("_rows").alias("_rows"), F.sum("_left").alias("_left"), F.sum("_hits").alias("_hits"))
    )
    folds = {
        "rolling_event_count": ("sum", F.col("_rows") - F.col("_left")),
        "rolling_breach_count": ("sum", F.col("_hits")),
    }
    totals = running(steps, by, "_at", folds, coarse=HOUR, fine=MINUTE // 60)
    return totals.where(F.col("_rows") > 0).drop("_left", "_hits")


def _folded_window(
    df: DataFrame, ts: str, flag: Column, minutes: int, by: Sequence[str], row_id: str, hot_rows: int
) -> DataFrame:
    """The counts by a running sum over steps, for keys and times of any density."""
    counts = trailing_counts(df, ts, flag, minutes, by)
    keyed = df.withColumn("_at", F.unix_micros(ts))
    joined = join_back(keyed, counts, [*by, "_at"], "_rows", [row_id], hot_rows=hot_rows)
    return joined.drop("_at", "_rows")


def _framed_window(df: DataFrame, ts: str, flag: Column, minutes: int, by: Sequence[str]) -> DataFrame:
    """The counts by running sums inside buckets as wide as the window.

    A row's window lies in its own bucket and the one before, so every row also goes into the next
    bucket, as the time it leaves the window there and a flag only. A count is what the bucket before
    held, plus what has come, less what has left: frames that only grow, so a bucket takes time in
    proportion to its rows, where a sliding frame adds up every window anew. One shuffle; a task
    holds the rows of two buckets of a key.
    """
    width, at = minutes * MINUTE, F.unix_micros(ts)
    bucket, hit = chunk(at, width), flag.cast("long")
    names = df.columns

    def copy(place: Column, own: bool) -> Column:
        payload = [F.col(c) if own else F.lit(None).cast(df.schema[c].dataType) for c in names]
        moment, sign = (at, 1) if own else (at + F.lit(width + 1), -1)
        return F.struct(
            place.alias("_bucket"), F.lit(own).alias("_own"), moment.alias("_at"),
            F.lit(sign).cast("long").alias("_row"), (hit * F.lit(sign)).alias("_hit"),
            *[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)], *[p.alias(f"_c{i}") for i, p in enumerate(payload)],
        )

    both = df.select(F.inline(F.array(copy(bucket, True), copy(bucket + 1, False))))
    ordered = W.partitionBy(*[f"_k{i}" for i in range(len(by))], "_bucket").orderBy("_at")
    upto = ordered.rangeBetween(W.unboundedPreceding, W.currentRow)
    whole = ordered.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)

    def held(name: str) -> Column:
        """What the rows of the bucket before, all of which leave in this one or at its end, bring in."""
        return F.coalesce(-F.sum(F.when(~F.col("_own"), F.col(name))).over(whole), F.lit(0))

    counted = both.select(
        "*",
        (held("_row") + F.sum("_row").over(upto)).alias("_n"),
        (held("_hit") + F.coalesce(F.sum("_hit").over(upto), F.lit(0))).alias("_hits"),
    ).where("_own")
    return counted.select(
        *[F.col(f"_c{i}").alias(c) for i, c in enumerate(names)],
        F.col("_n").alias("rolling_event_count"),
        F.col("_hits").alias("rolling_breach_count"),
    )


def trailing_window(
    df: DataFrame,
    ts: str,
    flag: Column,
    minutes: int = 60,
    by: Sequence[str] = (),
    row_id: str = "event_id",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Every event with count, breach count and breach rate of the minutes up to it, old end included.

    Events without a time or a `by` key belong to no window and get NULLs. Rows are counted per key
    and bucket of the window's width first. Buckets with more than `hot_rows` rows are few by
    arithmetic; rows that see one go through the running sum, whose groups stay bounded, all others
    through running sums inside their bucket. Both give the same counts.
    """
    width, keys = minutes * MINUTE, [*by, "_bucket"]
    marked = df.withColumn("_bucket", chunk(F.unix_micros(ts), width))
    whole = all_of([F.col(c).isNotNull() for c in (ts, *by)])
    sizes = marked.where(whole).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
    hot = staged(sizes.select(*keys), "hot-buckets")
    none = [F.lit(None).cast("long").alias(f"rolling_{c}_count") for c in ("event", "breach")]
    loose = df.where(~whole).select("*", *none)
    if hot.isEmpty():
        counted = _framed_window(df.where(whole), ts, flag, minutes, by)
    else:
        # A bucket is folded if it or the one before is hot; the fold then needs the bucket before it.
        def beside(*steps: int) -> DataFrame:
            at = F.explode(F.array(*[F.col("_bucket") + i for i in steps])).alias("_bucket")
            return F.broadcast(hot.select(*by, at).distinct())

        seen = marked.where(whole)
        folded = _folded_window(
            seen.join(beside(-1, 0, 1), keys, "left_semi"), ts, flag, minutes, by, row_id, hot_rows
        ).join(beside(0, 1), keys, "left_semi")
        # Rows just after a hot bucket are folded, but the bucket after theirs still needs them.
        framed = _framed_window(seen.join(beside(0), keys, "left_anti"), ts, flag, minutes, by).join(
            beside(1), keys, "left_anti"
        )
        counted = framed.unionByName(folded).drop("_bucket")
    rate = breach_rate(F.col("rolling_breach_count"), F.col("rolling_event_count"))
    return counted.unionByName(loose).select(
        *df.columns, "rolling_event_count", "rolling_breach_count", rate.alias("rolling_breach_rate_pct")
    )


def window_metrics(df: DataFrame, ts: str, flag: Column, as_of: Clock, minutes: int = 60) -> DataFrame:
    """One row: counts over [as_of - minutes, as_of]; an empty window has rate 0."""
    clock = clock_column(as_of)
    start = clock - F.make_dt_interval(mins=F.lit(minutes))
    inside = on_days(df, start, clock).where(F.col(ts).between(start, clock))
    totals = inside.agg(
        F.count(F.lit(1)).alias("rolling_event_count"), F.count_if(flag).alias("rolling_breach_count")
    )
    return totals.select(
        F.lit(minutes).alias("window_duration_minutes"),
        "rolling_event_count",
        "rolling_breach_count",
        breach_rate(F.col("rolling_breach_count"), F.col("rolling_event_count")).alias(
            "rolling_breach_rate_pct"
        ),
    )


def failure_velocity(incidents: DataFrame, ts: str, minutes: int = 60, by: Sequence[str] = ()) -> DataFrame:
    """Incidents per window and the change against the window just before it (0 when that had none).

    The lag runs over the aggregated windows, at most one row per key and window of the time range.
    """
    width = f"{minutes} minutes"
    counts = (
        incidents.groupBy(*by, F.window(ts, width).start.alias("window_start"))
        .agg(F.count(F.lit(1)).alias("incidents"))
    )
    order = W.partitionBy(*by).orderBy("window_start")
    gap = F.make_dt_interval(mins=F.lit(minutes))
    adjacent = F.lag("window_start").over(order) == F.col("window_start") - gap
    previous = F.when(adjacent, F.lag("incidents").over(order)).otherwise(F.lit(0).cast("long"))
    return counts.withColumn("previous_incidents", previous).withColumn(
        "velocity", F.col("incidents") - F.col("previous_incidents")
    )


def latest_by_key(df: DataFrame, key: str, version: str) -> DataFrame:
    """The row with the highest version per key; combined before the shuffle, so a hot key is cheap."""
    rest = [c for c in df.columns if c != key]
    newest = df.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(version)).alias("_row"))
    return newest.select(key, "_row.*").select(*df.columns)
