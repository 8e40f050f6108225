"""Streams give what the batch operators give, over several micro-batches and replays."""

from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from opsloom import schemas as S
from opsloom.operators import quality as Q
from opsloom.operators.windows import trailing_window
from opsloom.plans.cases import score_cases
from opsloom.sources import binding as B
from opsloom.sources import lake as L
from opsloom.streaming import jobs as St

PARTS = 3


def split_input(spark, df, scratch, order="seq"):
    """The rows as PARTS files in time order; the stream takes one file per batch."""
    n = df.count()
    for part in range(PARTS):
        piece = df.where((F.col(order) >= part * n // PARTS) & (F.col(order) < (part + 1) * n // PARTS))
        piece.coalesce(1).write.mode("append").parquet(f"{scratch}/in")
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/in")


def events(spark, sf):
    return B.bind_events(B.table(spark, sf, "events"))


def flags_of(spark, path):
    table = spark.read.schema("seq long, event_id string, is_duplicate boolean").parquet(path)
    return {r.seq: r.is_duplicate for r in table.collect()}


def test_validation_stream(spark, sf, scratch):
    s = B.bind_star(spark, sf)
    dirty = B.bind_dirty_events(events(spark, sf))
    stream = St.stream_validate(
        split_input(spark, dirty, scratch), s.customers, s.services, s.locations, B.DIRTY_AS_OF
    )
    query = (
        stream.writeStream.format("parquet")
        .option("path", f"{scratch}/out")
        .option("checkpointLocation", f"{scratch}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    got = {r.seq: r.rejection_reasons for r in spark.read.parquet(f"{scratch}/out").collect()}
    plain = dirty.withColumn("_duplicate", F.lit(False))
    batch = Q.with_reasons(plain, B.DIRTY_AS_OF, s.customers, s.services, s.locations)
    assert got == {r.seq: r.rejection_reasons for r in batch.collect()} and len(got) == 1000
    live = St.stream_validate(dirty).where(F.array_contains("rejection_reasons", S.ERR_FUTURE_TIMESTAMP))
    assert live.count() > 0


def replayed(handle):
    """Every batch runs twice, as after a failure between its writes and the commit."""

    def run(batch, batch_id):
        handle(batch, batch_id)
        handle(batch, batch_id)

    return run


def test_dedup_across_batches_and_replay(spark, sf, scratch):
    dirty = B.bind_dirty_events(events(spark, sf)).select("seq", "event_id")
    # Every id comes again a whole input later, so most duplicates are in another batch.
    twice = dirty.union(dirty.withColumn("seq", F.col("seq") + 1000))
    out = f"{scratch}/out"
    rows = St.with_first_ids(split_input(spark, twice, scratch))
    St.run_available(rows, replayed(St.dedup_handler(out)), f"{scratch}/checkpoint")
    want = {r.seq: r._duplicate for r in Q.mark_duplicates(twice, ["event_id"], "seq").collect()}
    assert flags_of(spark, out) == want and sum(want.values()) > 900
    assert spark.read.parquet(out).count() == 2000


def test_a_batch_does_not_depend_on_the_history(spark, scratch):
    """Four batches of new ids: the state grows, what a batch reads and updates does not."""
    for i in range(4):
        rows = spark.range(i * 50, i * 50 + 50).selectExpr("id AS seq", "concat('E', id) AS event_id")
        rows.coalesce(1).write.mode("append").parquet(f"{scratch}/in")
    again = spark.range(200, 250).selectExpr("id AS seq", "concat('E', id - 200) AS event_id")
    again.unionByName(spark.range(250, 260).selectExpr("id AS seq", "'HOT' AS event_id")).coalesce(1).write.mode(
        "append"
    ).parquet(f"{scratch}/in")
    stream = spark.readStream.schema("seq long, event_id string").option("maxFilesPerTrigger", 1).parquet(f"{scratch}/in")
    out, opened = f"{scratch}/out", []

    def handle(batch, batch_id):
        seen = St.seen_before(batch)
        opened.append(sum("/out/" in f for f in seen.inputFiles()))
        St.write_batch(seen, batch_id, out, ("is_duplicate",))

    query = St.run_available(St.with_first_ids(stream), handle, f"{scratch}/checkpoint")
    steps = [p["stateOperators"] for p in query.recentProgress if p["numInputRows"]]
    assert len(steps) == 5 and opened == [0] * 5
    last = [ops[-1] if ops[-1]["numRowsTotal"] <= ops[0]["numRowsTotal"] else ops[0] for ops in steps]
    assert [op["numRowsTotal"] for op in last] == [50 * (i + 1) for i in range(4)] + [201]
    assert [op["numRowsUpdated"] for op in last] == [50] * 4 + [1]
    flags = flags_of(spark, out)
    assert sum(flags.values()) == 59 and len(flags) == 260


def test_ids_may_be_forgotten_behind_the_watermark(spark, scratch):
    base = datetime(2026, 1, 1, tzinfo=timezone.utc)
    for hours in ((0, 1), (1, 50), (90,), (0, 90)):
        made = [(h, f"E{h}", base + timedelta(hours=h)) for h in hours]
        spark.createDataFrame(made, "seq long, event_id string, timestamp timestamp").coalesce(1).write.mode("append").parquet(f"{scratch}/in")
    stream = spark.readStream.schema("seq long, event_id string, timestamp timestamp").option("maxFilesPerTrigger", 1).parquet(f"{scratch}/in")
    out = f"{scratch}/out"
    rows = St.with_first_ids(stream, within=("timestamp", "24 hours"))
    query = St.run_available(rows, St.dedup_handler(out), f"{scratch}/checkpoint")
    table = spark.read.schema("event_id string, is_duplicate boolean, batch_id long").parquet(out)
    got = sorted((r.batch_id, r.event_id, r.is_duplicate) for r in table.collect())
    assert got[:5] == [(0, "E0", False), (0, "E1", False), (1, "E1", True), (1, "E50", False), (2, "E90", False)]
    assert got[5:] == [(3, "E0", True), (3, "E90", True)]  # too late to be judged: not taken for new
    states = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    assert max(states) == 3 and states[-1] == 2  # E50 and E90; E0 and E1 are forgotten


def trailing_rows(spark, path, minutes):
    names = ["event_id", "rolling_event_count", "rolling_breach_count", "rolling_breach_rate_pct"]
    closed = spark.read.parquet(f"{path}/metrics").select(*names)
    rest = St.held_metrics(spark, path, "timestamp", "bad", minutes, ("customer_id",)).select(*names)
    return sorted(closed.collect()), sorted(rest.collect())


def test_trailing_stream_equals_batch_however_it_is_cut(spark, sf, scratch):
    rows = events(spark, sf).select(
        "event_id", "customer_id", "timestamp", (F.col("status_code") >= 500).alias("bad"), "seq"
    )
    names = ["event_id", "rolling_event_count", "rolling_breach_count", "rolling_breach_rate_pct"]
    width = 24 * 60
    want = sorted(trailing_window(rows, "timestamp", F.col("bad"), width, ("customer_id",)).select(*names).collect())
    in_order = f"{scratch}/in-order"
    handler = St.trailing_handler(in_order, "timestamp", "bad", width, ("customer_id",))
    St.run_available(split_input(spark, rows, scratch), handler, f"{scratch}/checkpoint")
    closed, rest = trailing_rows(spark, in_order, width)
    assert sorted(closed + rest) == want and len(closed) > 900
    # Rows up to six days out of order, three batches, the last one twice.
    mixed = f"{scratch}/mixed"
    handler = St.trailing_handler(mixed, "timestamp", "bad", width, ("customer_id",), late_minutes=11 * 24 * 60)
    shifted = F.col("seq") + F.when(F.col("seq") % 4 == 0, 200).otherwise(0)
    for batch in (0, 1, 2, 2):
        handler(rows.where(F.least(F.floor(shifted / 400), F.lit(2)) == batch), batch)
    closed, rest = trailing_rows(spark, mixed, width)
    assert sorted(closed + rest) == want and len(closed) > 400 and len(rest) > 300
    assert {r.batch_id: r.late_rows for r in St.late_rows(spark, mixed).collect()} == {0: 0, 1: 0, 2: 0}


def test_trailing_stream_keeps_late_rows_and_rows_without_a_time(spark, scratch):
    base = datetime(2026, 1, 1, 10, tzinfo=timezone.utc)
    def rows(*found):
        made = [(i, "B", None if m is None else base + timedelta(minutes=m), bad) for i, m, bad in found]
        return spark.createDataFrame(made, "event_id long, customer_id string, timestamp timestamp, bad boolean")

    out = f"{scratch}/out"
    handler = St.trailing_handler(out, "timestamp", "bad", 60, ("customer_id",), late_minutes=60)
    handler(rows((1, 0, False), (2, 30, False), (3, None, True)), 0)
    handler(rows((4, 10, True), (5, 300, False)), 1)
    handler(rows((6, 20, True), (7, 301, True)), 2)
    handler(rows(), 3)
    closed, rest = trailing_rows(spark, out, 60)
    assert [tuple(r)[:3] for r in closed] == [(1, 1, 0), (2, 3, 1), (3, None, None), (4, 2, 1)]
    assert [tuple(r)[:3] for r in rest] == [(5, 1, 0), (7, 2, 1)]
    assert sorted(map(tuple, St.late_rows(spark, out).collect())) == [(0, 0), (1, 0), (2, 1), (3, 0)]


def test_sliding_stream_shows_open_windows(spark, scratch):
    base = datetime(2026, 1, 1, 12, tzinfo=timezone.utc)
    for minutes in ((0, 50), (10, 400), (401,)):
        made = [(base + timedelta(minutes=m), m % 2 == 0) for m in minutes]
        spark.createDataFrame(made, "ts timestamp, bad boolean").coalesce(1).write.mode("append").parquet(f"{scratch}/in")
    stream = spark.readStream.schema("ts timestamp, bad boolean").option("maxFilesPerTrigger", 1).parquet(f"{scratch}/in")
    windows = St.stream_sliding(stream, "ts", F.col("bad"))
    St.run_available(windows, St.sliding_handler(f"{scratch}/out"), f"{scratch}/checkpoint", "update")
    got = {
        round((r.window_start.timestamp() - base.timestamp()) / 60): (r.rolling_event_count, r.rolling_breach_count)
        for r in St.current_windows(spark, f"{scratch}/out").collect()
    }
    assert got[0] == (3, 3) and got[-5] == (3, 3) and got[-10] == (2, 2) and got[400] == (2, 1) and got[345] == (2, 1)


def test_window_store_keeps_last_states_only(spark, scratch):
    """Every batch run twice, then a batch that dies after half its days; the store stays small and right."""
    base = datetime(2026, 1, 1, tzinfo=timezone.utc)
    schema = "window_start timestamp, window_end timestamp, rolling_event_count long, rolling_breach_count long, rolling_breach_rate_pct double"

    def states(hours, n):
        rows = [(base + timedelta(hours=h), base + timedelta(hours=h + 1), n, 0, 0.0) for h in hours]
        return spark.createDataFrame(rows, schema)

    def now():
        rows = St.current_windows(spark, out).collect()
        return {round((r.window_start.timestamp() - base.timestamp()) / 3600): r.rolling_event_count for r in rows}

    out = f"{scratch}/out"
    handle = replayed(St.sliding_handler(out))
    want = {}
    for batch_id in range(12):
        hours = range(batch_id * 4, batch_id * 4 + 12)
        handle(states(hours, batch_id + 1), batch_id)
        want |= dict.fromkeys(hours, batch_id + 1)
        assert St.current_windows(spark, out).count() == len(want)
    assert now() == want
    handle(states([], 0), 12)
    # Two places a day hold everything, whatever number of batches touched it.
    assert spark.read.parquet(out).count() <= 2 * len(want)
    assert spark.read.parquet(out).select("day", "slot").distinct().count() <= 2 * 3
    # A failed attempt wrote other states under its batch id: the next attempt does not build on them.
    handle(states([1, 30], 77), 13)
    handle(states([30], 78), 13)
    got = now()
    assert got[30] == 78 and all(got[h] == n for h, n in want.items() if h not in (1, 30))


def test_sliding_stream_drops_and_counts_late_rows(spark, scratch):
    base = datetime(2026, 1, 1, 12, tzinfo=timezone.utc)
    def batch(*minutes):
        rows = [(base + timedelta(minutes=m), m % 2 == 0) for m in minutes]
        spark.createDataFrame(rows, "ts timestamp, bad boolean").coalesce(1).write.mode("append").parquet(f"{scratch}/in")

    batch(0, 1, 2, 50)
    batch(400)
    batch(-300, 401)
    batch(900)
    stream = spark.readStream.schema("ts timestamp, bad boolean").option("maxFilesPerTrigger", 1).parquet(f"{scratch}/in")
    query = (
        St.stream_sliding(stream, "ts", F.col("bad"))
        .writeStream.format("parquet")
        .option("path", f"{scratch}/out")
        .option("checkpointLocation", f"{scratch}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    # One late row belongs to twelve sliding windows; the drop is counted per window.
    assert St.dropped_from_windows(query) == 12
    got = {
        (r.window_start, r.window_end): (r.rolling_event_count, r.rolling_breach_count, r.rolling_breach_rate_pct)
        for r in spark.read.parquet(f"{scratch}/out").collect()
    }
    start = base.replace(tzinfo=None)
    hour = timedelta(hours=1)
    def at(m):
        window = [k for k in got if k[0].timestamp() == (base + timedelta(minutes=m)).timestamp()]
        return got[window[0]] if window else None

    assert at(0) == (4, 3, 75.0) and at(-55) == (3, 2, 66.67) and at(50) == (1, 1, 100.0)
    assert all(end - begin == hour for begin, end in got) and at(-300) is None and start


def test_case_stream_equals_batch(spark, sf, scratch):
    s = B.bind_star(spark, sf)
    exposures = B.bind_exposures(B.table(spark, sf, "orders"))
    once = events(spark, sf)
    # Each event is delivered twice, in different batches or within one.
    rows = once.union(once.withColumn("seq", F.col("seq") + 500)).withColumn("seq", F.col("seq"))
    out = f"{scratch}/out"
    handler = St.cases_handler(out, s.customers, s.services, F.col("clock"), exposures=exposures)
    St.run_available(St.with_first_ids(split_input(spark, rows, scratch)), handler, f"{scratch}/checkpoint")
    got = spark.read.parquet(out).drop("batch_id")
    want = score_cases(once, s.customers, s.services, F.col("clock"), exposures=exposures)
    key = want.columns.index("event_id")
    def sort(df):
        return sorted(df.select(*want.columns).collect(), key=lambda r: r[key])

    assert sort(got) == sort(want) and got.count() > 100


def test_lake_stream_equals_batch_and_survives_replay(spark, sf, scratch):
    s = B.bind_star(spark, sf)
    dims = (s.customers, s.services, s.locations)
    dirty = B.bind_dirty_events(events(spark, sf))
    paths = [f"{scratch}/{n}" for n in ("lake", "quarantine", "metrics")]
    handler = St.lake_handler(*paths, *dims, B.DIRTY_AS_OF)
    rows = St.with_first_ids(split_input(spark, dirty, scratch))
    St.run_available(rows, replayed(handler), f"{scratch}/checkpoint")
    valid, rejected = Q.route(Q.validate_events(dirty, B.DIRTY_AS_OF, *dims))
    def outcome():
        lake = sorted(r.event_id for r in L.read_event_lake(spark, paths[0]).collect())
        held = spark.read.parquet(paths[1])
        pairs = sorted((r.raw_record.seq, tuple(r.rejection_reasons)) for r in held.collect())
        return lake, pairs

    want = (
        sorted(r.event_id for r in valid.collect()),
        sorted((r.seq, tuple(r.rejection_reasons)) for r in rejected.collect()),
    )
    assert outcome() == want
    m = spark.read.parquet(paths[2])
    assert m.count() == PARTS and m.agg(F.sum("rows_processed")).first()[0] == 1000


def test_table_as_a_folder_of_part_files(spark, sf, scratch):
    from opsloom.plans import registry

    spark.read.parquet(f"{sf}/events.parquet").repartition(3).write.parquet(f"{scratch}/events.parquet")
    one, many = (registry.event_stream(spark, d).drop("clock") for d in (sf, scratch))
    counts = []
    for i, stream in enumerate((one, many)):
        query = stream.writeStream.format("memory").queryName(f"rows_{i}").trigger(availableNow=True).start()
        query.awaitTermination()
        counts.append((spark.table(f"rows_{i}").count(), len([p for p in query.recentProgress if p["numInputRows"]])))
    assert counts[0][0] == counts[1][0] > 0 and counts[1][1] == 3


def test_stream_queries_over_several_months(spark, sf, scratch):
    """Deliveries follow the time range of the table, so no row of a longer one is lost."""
    from opsloom.plans import registry

    first = F.lit("2024-01-01").cast("timestamp")
    at = F.timestamp_micros(F.unix_micros(first) + 4 * (F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(first)))
    table = B.table(spark, sf, "events")
    table.withColumn("ts", at.cast("timestamp_ntz")).coalesce(1).write.parquet(f"{scratch}/events.parquet")
    queries = registry.queries()
    names = [c for c in registry.TRAILING_COLUMNS]
    rows = queries["stream_trailing"](spark, scratch).select(*names)
    events_ = B.bind_events(B.table(spark, scratch, "events")).withColumn("bad", F.col("status_code") >= 500)
    want = trailing_window(events_, "timestamp", F.col("bad"), 60, ("customer_id",)).select(*names)
    assert sorted(rows.collect()) == sorted(want.collect()) and rows.count() == 1000
    windows = queries["stream_sliding"](spark, scratch)
    assert windows.agg(F.sum("rolling_event_count")).first()[0] == 12 * 1000


def test_a_delivery_is_one_batch_of_many_files(spark, sf, scratch, monkeypatch):
    """Three deliveries are three batches, however many files a larger table makes of each."""
    from opsloom.plans import registry

    spark.read.parquet(f"{sf}/events.parquet").repartition(6).write.parquet(f"{scratch}/events.parquet")
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    batches, handler = [], St.dedup_handler

    def noted(path):
        handle = handler(path)

        def run(batch, batch_id):
            batches.append(batch_id)
            handle(batch, batch_id)

        return run

    monkeypatch.setattr(St, "dedup_handler", noted)
    try:
        for name in names:
            spark.conf.set(name, "4096")
        rows = registry.queries()["stream_dedup"](spark, scratch)
        got = {r.seq: r.is_duplicate for r in rows.collect()}
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    dirty = B.bind_dirty_events(B.bind_events(B.table(spark, scratch, "events"))).select("seq", "event_id")
    assert batches == [0, 1, 2]
    # A repeat comes a delivery later than the id it repeats, so the least ordinal is its first.
    want = {r.seq: r._duplicate for r in Q.mark_duplicates(dirty, ["event_id"], "seq").collect()}
    assert got == want and len(got) == 1000
