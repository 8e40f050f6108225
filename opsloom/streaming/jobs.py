"""Streaming forms: validation, dedup, sliding and trailing windows, cases and the lake.

The ids that were seen are keyed state of the stream's query. Every batch writes below its own
`batch_id` partition that a replay overwrites, so a restart changes nothing; the sliding windows' store
keeps the last states alone and says how it gets there.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from opsloom import schemas as S
from opsloom.functions.calendar import date_text
from opsloom.operators import quality as Q
from opsloom.operators.windows import breach_rate, trailing_window
from opsloom.plans.cases import score_cases
from opsloom.session import staged
from opsloom.sources.lake import conform_events, stored_or_none

BATCH = "batch_id"
DAY_TEXT = T.StructField("day", T.StringType())
SLOT = T.StructField("slot", T.IntegerType())


def stream_validate(
    stream: DataFrame,
    customers: DataFrame | None = None,
    services: DataFrame | None = None,
    locations: DataFrame | None = None,
    as_of: Q.Clock | None = None,
) -> DataFrame:
    """The row-level rules on a stream. The clock is the batch's own time unless given."""
    clock = F.current_timestamp() if as_of is None else as_of
    plain = stream.withColumn("_duplicate", F.lit(False))
    return Q.with_reasons(plain, clock, customers, services, locations)


def stream_sliding(
    stream: DataFrame, ts: str, flag: Column, minutes: int = 60, slide: int = 5, late: str = "60 minutes"
) -> DataFrame:
    """Counts per sliding window. Rows later than `late` are dropped and counted in the progress."""
    window = F.window(ts, f"{minutes} minutes", f"{slide} minutes")
    counts = (
        stream.withWatermark(ts, late)
        .groupBy(window)
        .agg(F.count(F.lit(1)).alias("rolling_event_count"), F.count_if(flag).alias("rolling_breach_count"))
    )
    return counts.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "rolling_event_count",
        "rolling_breach_count",
        breach_rate(F.col("rolling_breach_count"), F.col("rolling_event_count")).alias(
            "rolling_breach_rate_pct"
        ),
    )


def dropped_from_windows(query: StreamingQuery) -> int:
    """Late rows as Spark counts them: once per window they belong to, over its latest progress reports.

    `late_rows` has them as rows and from the first batch on.
    """
    return sum(
        op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"]
    )


# --- batch tables -------------------------------------------------------------------------------


def write_batch(df: DataFrame, batch: int, path: str, partitions: Sequence[str] = ()) -> None:
    """Put a micro-batch below its own partition, replacing what a failed attempt left there."""
    keyed = df.withColumn(BATCH, F.lit(batch).cast("long"))
    (
        keyed.hint("rebalance", *partitions)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions, BATCH)
        .parquet(path)
    )


def adaptive(handle: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """Run a batch handler with adaptive execution, which a stream's session has switched off.

    The handler's own queries are plain batch queries; they need it for measured joins and for
    splitting a day that holds most of a batch.
    """
    name = "spark.sql.adaptive.enabled"

    def run(batch: DataFrame, batch_id: int) -> None:
        conf = batch.sparkSession.conf
        before = conf.get(name)
        conf.set(name, "true")
        try:
            handle(batch, batch_id)
        finally:
            conf.set(name, before)

    return run


def run_available(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> StreamingQuery:
    """Feed everything that is there to `handle`, batch by batch, and stop."""
    query = (
        stream.writeStream.foreachBatch(adaptive(handle))
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


# --- batch handlers -----------------------------------------------------------------------------


FIRST = "_first_seen"
SALTS = 16


def with_first_ids(
    stream: DataFrame, key: str = "event_id", seq: str = "seq", salts: int = SALTS, within: tuple[str, str] | None = None
) -> DataFrame:
    """The stream's rows, and again, marked by `_first_seen`, one row of each id no batch held before.

    The ids that were seen are keyed state of the query, kept by Spark from batch to batch: a batch
    looks up its own ids, whatever came before. An id is dropped per salt first and then over all, so
    the rows of a hot id meet in no one task. Rows without an id need no state.

    `within`, a timestamp column and a delay, sets a watermark and forgets an id once it has passed
    the id's time by the delay, so the state stays as large as that time. A repeat with a time after
    that counts as new; a row that comes behind the watermark never does.
    """
    salted = stream.where(~Q.missing(key)).withColumn("_salt", F.pmod(F.xxhash64(seq), F.lit(salts)))
    if within is None:
        once = salted.dropDuplicates([key, "_salt"]).dropDuplicates([key])
    else:
        once = salted.withWatermark(*within).dropDuplicatesWithinWatermark([key])
    new = once.drop("_salt").withColumn(FIRST, F.lit(True))
    return stream.withColumn(FIRST, F.lit(False)).unionByName(new)


def seen_before(batch: DataFrame, seq: str = "seq", flag: str = "is_duplicate") -> DataFrame:
    """The rows of a batch of `with_first_ids`, flagged if their id came before, in this batch or another.

    The batch is staged, so the stateful part runs once. Of an id that is new the row with the least
    ordinal is its first.
    """
    table = staged(batch, "stream-batch", (FIRST,))
    rows, new = table.where(~F.col(FIRST)).drop(FIRST), table.where(FIRST).select("event_id")
    # One row per id, counted so that a hot id is split.
    ids = rows.where(~Q.missing("event_id")).groupBy("event_id").agg(F.count(F.lit(1)).alias("_copies"))
    old = ids.join(new, "event_id", "left_anti").withColumn("_old", F.lit(True))
    marked = Q.mark_duplicates(rows, ["event_id"], seq, flag="_again")
    joined = Q.join_back(marked, old, ["event_id"], "_copies", [seq], unmatched=Q.missing("event_id"))
    again = F.col("_again") | F.coalesce(F.col("_old"), F.lit(False))
    return joined.withColumn(flag, again).drop("_again", "_old", "_copies")


def dedup_handler(path: str, seq: str = "seq") -> Callable[[DataFrame, int], None]:
    """First occurrences and duplicates, also of ids from earlier batches; nothing is dropped.

    Takes the batches of `with_first_ids` and writes every row with `is_duplicate`; nothing that
    earlier batches wrote is read.
    """
    return lambda batch, batch_id: write_batch(seen_before(batch, seq), batch_id, path, ("is_duplicate",))


def sliding_handler(path: str) -> Callable[[DataFrame, int], None]:
    """Keeps the last state of every window, for `current_windows`.

    Run `stream_sliding` with it in update mode: open windows are then known before the watermark
    passes them, so the last hours of the input are not missing.

    A batch rewrites the days whose windows it touched and reads only those. Each day has two places,
    `slot` 0 and 1: the new states go to the one that does not hold the day's last, so a batch that
    fails half-way, or runs again, loses nothing, and the store holds a window twice at most.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark, names = batch.sparkSession, batch.columns
        fresh = staged(batch.withColumn("day", date_text(F.col("window_start"))), "windows")
        # Days a batch has rows of: dates, not rows.
        days = [r.day for r in fresh.select("day").distinct().collect()]
        if not days:
            return
        fields = [*batch.schema.fields, T.StructField(BATCH, T.LongType()), DAY_TEXT, SLOT]
        stored = stored_or_none(lambda: spark.read.schema(T.StructType(fields)).parquet(path))
        if stored is None:
            stored = spark.createDataFrame([], T.StructType(fields))
        # What an earlier run of this batch left is not read.
        before = _last_of_days(stored.where(F.col("day").isin(days) & (F.col(BATCH) < batch_id)))
        places = before.groupBy("day").agg((F.lit(1) - F.max("slot")).alias("slot"))
        kept = before.join(fresh, ["window_start", "window_end"], "left_anti").select(*names, "day")
        states = fresh.unionByName(kept).join(places, "day", "left")
        merged = staged(states.withColumn("slot", F.coalesce("slot", F.lit(0))), "windows")
        (
            merged.withColumn(BATCH, F.lit(batch_id).cast("long"))
            .hint("rebalance", "day", "slot")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("day", "slot")
            .parquet(path)
        )

    return handle


def _last_of_days(stored: DataFrame) -> DataFrame:
    """Of each day the windows that the latest batch wrote."""
    last = stored.groupBy("day").agg(F.max(BATCH).alias(BATCH))
    return stored.join(last, ["day", BATCH], "left_semi")


def current_windows(spark: SparkSession, path: str) -> DataFrame:
    """The last state of every window that `sliding_handler` kept."""
    return _last_of_days(spark.read.parquet(path)).drop("day", "slot", BATCH)


MARK = "watermark long"
MICROS = 1_000_000


def trailing_handler(
    path: str,
    ts: str,
    flag: str,
    minutes: int = 60,
    by: Sequence[str] = (),
    row_id: str = "event_id",
    late_minutes: int = 60,
) -> Callable[[DataFrame, int], None]:
    """Trailing metrics per event, given once all events up to it are in, however batches are cut.

    Rows are held below `path` until the watermark, the latest time seen less `late_minutes`, has
    passed them; then their counts are final. A row that comes after its time was closed is not
    counted but kept below `late`. Rows without a time get NULLs at once. `held_metrics` has what is
    still open. Each batch reads the days between the last watermark, less the window, and its own,
    and the mark of the batch before.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        names = {row_id, ts, flag, *by}
        fields = T.StructType([f for f in batch.schema.fields if f.name in names])
        fresh = staged(batch.select(*fields.names), "trailing")
        at = F.unix_micros(ts)
        closed = None
        if batch_id:
            closed = spark.read.schema(MARK).parquet(f"{path}/marks/{BATCH}={batch_id - 1}").first()[0]
        newest = fresh.agg(F.max(at)).first()[0]
        ends = [m for m in (closed, None if newest is None else newest - late_minutes * 60 * MICROS) if m is not None]
        reached = max(ends, default=None)
        late = F.lit(False) if closed is None else F.coalesce(at < closed, F.lit(False))
        in_time = fresh.where(~late & F.col(ts).isNotNull()).withColumn("day", date_text(F.col(ts)))
        write_batch(in_time, batch_id, f"{path}/rows", ("day",))
        write_batch(fresh.where(late), batch_id, f"{path}/late")
        ready = fresh.where(F.col(ts).isNull()).withColumn("_new", F.lit(True))
        if reached is not None and reached != closed:
            held = _held_rows(spark, path, fields, closed, reached, minutes, batch_id)
            passed = F.lit(True) if closed is None else at >= closed
            ready = ready.unionByName(held.where(at < reached).withColumn("_new", passed))
        metrics = trailing_window(ready, ts, F.col(flag), minutes, by, row_id).where("_new").drop("_new")
        write_batch(metrics.withColumn("day", date_text(F.col(ts))), batch_id, f"{path}/metrics", ("day",))
        write_batch(spark.createDataFrame([(reached,)], MARK), batch_id, f"{path}/marks")

    return handle


def _held_rows(
    spark: SparkSession, path: str, fields: T.StructType, closed: int | None, reached: int, minutes: int, upto: int
) -> DataFrame:
    """Rows that came in time, from a window before `closed` on; only their days are listed and read."""
    reader = spark.read.schema(T.StructType([*fields.fields, DAY_TEXT, T.StructField(BATCH, T.LongType())]))
    folder = f"{path}/rows"
    if closed is None:
        held = reader.parquet(folder)
    else:
        first, last = (
            datetime.fromtimestamp(m // MICROS, timezone.utc).date() for m in (closed - minutes * 60 * MICROS, reached)
        )
        days = [(first + timedelta(days=i)).isoformat() for i in range((last - first).days + 1)]
        try:
            held = reader.option("basePath", folder).parquet(f"{folder}/day={{{','.join(days)}}}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            held = spark.createDataFrame([], T.StructType([*fields.fields, T.StructField(BATCH, T.LongType())]))
    return held.where(F.col(BATCH) <= upto).select(*fields.names)


def held_metrics(
    spark: SparkSession,
    path: str,
    ts: str,
    flag: str,
    minutes: int = 60,
    by: Sequence[str] = (),
    row_id: str = "event_id",
) -> DataFrame:
    """Metrics of the rows the watermark has not passed, over what has come so far: the final ones
    where nothing more comes."""
    fields = spark.read.parquet(f"{path}/rows").drop("day", BATCH).schema
    marks = spark.read.schema(f"{MARK}, {BATCH} long").parquet(f"{path}/marks")
    closed = marks.agg(F.max("watermark")).first()[0]
    held = spark.read.schema(T.StructType([*fields.fields, DAY_TEXT])).parquet(f"{path}/rows")
    new = F.lit(True)
    if closed is not None:
        start = F.timestamp_micros(F.lit(closed - minutes * 60 * MICROS))
        held = held.where((F.col("day") >= date_text(start)) & (F.col(ts) >= start))
        new = F.unix_micros(ts) >= closed
    both = held.select(*fields.names).withColumn("_new", new)
    return trailing_window(both, ts, F.col(flag), minutes, by, row_id).where("_new").drop("_new")


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """Per batch of a trailing stream, the rows that came after their time was closed; none is left out."""
    marks = spark.read.schema(f"{MARK}, {BATCH} long").parquet(f"{path}/marks").select(BATCH)
    try:
        late = spark.read.schema(f"{BATCH} long").parquet(f"{path}/late").groupBy(BATCH).agg(F.count(F.lit(1)).alias("_n"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return marks.select(BATCH, F.lit(0).cast("long").alias("late_rows"))
    return marks.join(late, BATCH, "left").select(BATCH, F.coalesce("_n", F.lit(0).cast("long")).alias("late_rows"))


def cases_handler(
    path: str, customers: DataFrame, services: DataFrame, as_of: Q.Clock | None = None, **options
) -> Callable[[DataFrame, int], None]:
    """Scored cases per micro-batch of `with_first_ids`; an event that came before has one already."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        clock = F.current_timestamp() if as_of is None else as_of
        first = seen_before(batch, flag="_again").where(~F.col("_again")).drop("_again")
        write_batch(score_cases(first, customers, services, clock, **options), batch_id, path)

    return handle


def lake_handler(
    lake: str,
    quarantine: str,
    metrics: str,
    customers: DataFrame | None = None,
    services: DataFrame | None = None,
    locations: DataFrame | None = None,
    as_of: Q.Clock | None = None,
) -> Callable[[DataFrame, int], None]:
    """Valid rows to the lake, rejected rows to quarantine, one metrics row per batch of `with_first_ids`.

    The first occurrence claims an id even when its row is rejected.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        clock = F.current_timestamp() if as_of is None else as_of
        once = seen_before(batch, flag="_duplicate")
        flagged = Q.with_reasons(once, clock, customers, services, locations, ["seq"])
        table = staged(flagged.withColumn("_rejected", Q.is_rejected()), "stream-flagged", ("_rejected",))
        valid = table.where(~F.col("_rejected")).drop("_rejected", "rejection_reasons")
        rejected = table.where("_rejected").drop("_rejected")
        write_batch(conform_events(valid), batch_id, lake, S.LAKE_PARTITIONS)
        write_batch(Q.quarantine_envelope(rejected, clock), batch_id, quarantine)
        write_batch(Q.dq_metrics(table), batch_id, metrics)

    return handle
