"""The date-partitioned event lake, quarantine, metrics and case tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsloom import schemas as S
from opsloom.functions.calendar import parse_iso, with_calendar
from opsloom.session import staged
from opsloom.sources.idindex import IdIndex

# The answer before the first validation run.
NO_METRICS = ("NO_METRICS_LOGGED", "Validation pipeline has not run yet.")


def conform_events(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Declared column list, order and types of the lake, with calendar columns; texts are parsed.
    Columns to `keep` follow as they are."""
    ts = F.col("timestamp")
    if dict(df.dtypes)["timestamp"] == "string":
        ts = parse_iso(ts)
    absent = {f.name: F.lit(None) for f in S.EVENT.fields if f.name not in df.columns}
    typed = with_calendar(df.withColumns({**absent, "timestamp": ts.cast("timestamp")}))
    return typed.select(*[F.col(f.name).cast(f.dataType) for f in S.LAKE_EVENT.fields], *keep)


def write_event_lake(df: DataFrame, path: str, whole_days: bool = False, index: str | None = None) -> None:
    """Write valid events as Snappy Parquet below year/month/day.

    A batch appends the event ids the lake does not hold yet, so running it again, in parts or late
    loses and doubles nothing. Only a batch known to have every row of its days may replace them
    (`whole_days`). The rebalance hint splits a day with much of the data over several tasks and
    joins small ones.

    `index`, a folder, keeps the ids beside the lake (`IdIndex`): an append then opens the parts of it
    that may hold one of its ids instead of the id column of the whole lake. All appends of a lake
    must name it.
    """
    held = None if index is None else IdIndex(df.sparkSession, index)
    if held is not None and not whole_days:
        return _append_indexed(df, path, held)
    _write_days(conform_events(df) if whole_days else new_lake_rows(df, path), path, whole_days)
    if held is not None:  # replaced days may have lost ids
        held.rebuild(read_event_lake(df.sparkSession, path))


def _append_indexed(df: DataFrame, path: str, index: IdIndex) -> None:
    """Ids first, then rows, then the record that makes the ids count.

    A load that ends in between leaves ids without a record. The next one looks those up in the lake
    itself, so it neither drops nor repeats the rows they stand for.
    """
    rows = staged(_first_rows(df), "lake-rows")
    lake = stored_or_none(lambda: read_event_lake(df.sparkSession, path).select("event_id"))
    if lake is not None:
        begun = index.pending()
        if not index.runs():
            index.rebuild(lake)
        elif begun:
            index.record(index.begin(index.ids_of(begun).join(lake, "event_id", "left_semi")), begun)
    known = index.known(rows.where(F.col("event_id").isNotNull()))
    fresh = rows.join(known, "event_id", "left_anti").select(*S.LAKE_EVENT.names)
    run = index.begin(fresh.where(F.col("event_id").isNotNull()))
    _write_days(fresh, path, False)
    index.record(run)
    index.compact()


def _write_days(rows: DataFrame, path: str, whole_days: bool) -> None:
    writer = rows.hint("rebalance", *S.LAKE_PARTITIONS).write.option("compression", "snappy")
    if whole_days:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode("append")
    writer.partitionBy(*S.LAKE_PARTITIONS).parquet(path)


def new_lake_rows(df: DataFrame, path: str) -> DataFrame:
    """Rows whose event id the lake does not hold on any day; of a repeated id the first by `seq`.

    Ids are unique over the whole table, so the check reads the id column of all of it, and no
    other. Rows without an id are all new. Without `seq` the least row of an id counts as its first.
    """
    fresh, spark = _first_rows(df), df.sparkSession
    stored = stored_or_none(lambda: read_event_lake(spark, path).select("event_id"))
    if stored is not None:
        fresh = fresh.join(stored, "event_id", "left_anti")
    return fresh.select(*S.LAKE_EVENT.names)


def _first_rows(df: DataFrame) -> DataFrame:
    """The first row of each id, in the lake's form; all rows without an id."""
    order = ["seq"] if "seq" in df.columns else []
    kept = conform_events(df, order)
    rest = [c for c in kept.columns if c not in ("event_id", *order)]
    at = F.col("seq") if order else F.struct(*rest)
    has_id = F.col("event_id").isNotNull()
    first = kept.where(has_id).groupBy("event_id").agg(F.min_by(F.struct(*rest), at).alias("_row"))
    names = S.LAKE_EVENT.names
    return first.select("event_id", "_row.*").select(*names).unionByName(kept.where(~has_id).select(*names))


def stored_or_none(read: Callable[[], DataFrame]) -> DataFrame | None:
    """A table that an earlier run may have written."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def read_event_lake(spark: SparkSession, path: str) -> DataFrame:
    """The lake with its declared schema, so partition keys stay zero-padded text."""
    return spark.read.schema(S.LAKE_EVENT).parquet(path).select(*S.LAKE_EVENT.names)


def write_dimensions(dims: dict[str, DataFrame], path: str) -> None:
    """Each dimension as unpartitioned Snappy Parquet; file count follows the size."""
    for name, df in dims.items():
        df.hint("rebalance").write.mode("overwrite").option("compression", "snappy").parquet(f"{path}/{name}")


def write_quarantine(
    envelope: DataFrame, path: str, fmt: str = "parquet", mode: str = "append", run: str | None = None
) -> None:
    """Rejected rows with their envelope below the date of quarantine.

    With a `run` they lie below run_id=<run>, and writing the same run again replaces them.
    """
    at = F.col("quarantined_at")
    dated = envelope.withColumns(
        {
            "year": F.date_format(at, "yyyy"),
            "month": F.date_format(at, "MM"),
            "day": F.date_format(at, "dd"),
        }
    )
    writer = dated.hint("rebalance").write.mode(mode)
    if run is not None:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "static")
        path = f"{path}/run_id={run}"
    writer.partitionBy(*S.LAKE_PARTITIONS).format(fmt).save(path)


def write_dq_metrics(metrics: DataFrame, path: str) -> None:
    """The one-row metrics document, replaced by every run."""
    metrics.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "static").json(path)


METRICS_SCHEMA = (
    "rows_processed long, rows_valid long, rows_rejected long, acceptance_rate_pct double, "
    "error_distribution struct<" + ", ".join(f"{c}: long" for c in S.REJECTION_CODES) + ">"
)


def read_dq_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The last metrics document, or the answer that validation has not run."""
    try:
        return spark.read.schema(METRICS_SCHEMA).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([NO_METRICS], "status string, detail string")


def write_cases(sla: DataFrame, exceptions: DataFrame, path: str, mode: str = "append") -> None:
    """SLA records by year and month of their start; exceptions beside them.

    Appending leaves out records whose id the table holds, in each table for itself: a run that is
    repeated, or that ended between the two writes, completes both and doubles nothing.
    """
    if mode == "append":
        spark = sla.sparkSession
        sla = _absent(sla, stored_or_none(lambda: read_sla(spark, path)), "sla_id")
        exceptions = _absent(exceptions, stored_or_none(lambda: read_exceptions(spark, path)), "exception_id")
    start = F.col("start_time")
    dated = sla.withColumns({"year": F.date_format(start, "yyyy"), "month": F.date_format(start, "MM")})
    dated.hint("rebalance", "year", "month").write.mode(mode).partitionBy("year", "month").parquet(
        f"{path}/fact_sla_record"
    )
    exceptions.hint("rebalance").write.mode(mode).parquet(f"{path}/fact_exception")


def _absent(rows: DataFrame, stored: DataFrame | None, key: str) -> DataFrame:
    return rows if stored is None else rows.join(stored.select(key), key, "left_anti").select(*rows.columns)


def read_sla(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.SLA_RECORD).parquet(f"{path}/fact_sla_record").select(*S.SLA_RECORD.names)


def read_exceptions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.EXCEPTION_RECORD).parquet(f"{path}/fact_exception")


# --- incremental loads --------------------------------------------------------------------------


def insert_if_absent(target: DataFrame, incoming: DataFrame, key: str, seq: str) -> DataFrame:
    """Incoming rows to append: keys the target lacks, the first occurrence of each; no updates.

    The first row per key is a minimum over the ordinal, combined before the shuffle.
    """
    rest = [c for c in incoming.columns if c != key]
    first = incoming.groupBy(key).agg(F.min_by(F.struct(*rest), F.col(seq)).alias("_row"))
    fresh = first.join(target.select(key), key, "left_anti")
    return fresh.select(key, "_row.*").select(*[c for c in incoming.columns if c != seq])


def append_new_events(target: DataFrame, incoming: DataFrame, seq: str = "seq") -> DataFrame:
    """Events to append, timestamps parsed and absent optional columns NULL."""
    ts = F.col("timestamp")
    if dict(incoming.dtypes)["timestamp"] == "string":
        ts = parse_iso(ts)
    absent = {f.name: F.lit(None).cast(f.dataType) for f in S.EVENT.fields if f.name not in incoming.columns}
    typed = incoming.withColumns({**absent, "timestamp": ts}).select(
        *[F.col(f.name).cast(f.dataType) for f in S.EVENT.fields], seq
    )
    return insert_if_absent(target, typed, "event_id", seq)
