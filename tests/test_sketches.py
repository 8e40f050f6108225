"""Stored latency sketches against exact ranks, and the order reports come in."""

from datetime import datetime

from pyspark.sql import functions as F

from opsloom.operators import scale as Sc
from opsloom.operators import sketches as Sk
from opsloom.session import scratch_path

LEVELS = {"p50": 0.5, "p99": 0.99}
SCHEMA = "grp string, timestamp timestamp, duration_ms long"


def by_hand(spark):
    rows = [("a", datetime(2024, 1, d, 12), 100 * d + i) for d in (1, 2, 3) for i in range(10)]
    rows += [("b", datetime(2024, 1, 2), None), (None, datetime(2024, 1, 2), 7), ("a", None, 1)]
    return spark.createDataFrame(rows, SCHEMA)


def test_days_are_merged_for_any_range(spark):
    path = scratch_path(spark, "sketches")
    Sk.write_daily_sketches(Sk.daily_sketches(by_hand(spark), ["grp"]), path)
    stored = Sk.read_daily_sketches(spark, path, "2024-01-02", "2024-01-03")
    found = {r.grp: r for r in Sk.merged_latency(stored, ["grp"], LEVELS).collect()}
    a = found["a"]
    assert (a.total_events, a.timed_events, a.avg_latency_ms) == (20, 20, 254.5)
    assert 208 <= a.p50 <= 301 and a.p99 == 309  # few values are kept as they are
    assert (found["b"].total_events, found["b"].avg_latency_ms, found["b"].p50) == (1, None, None)
    assert found[None].p50 == 7


def test_other_days_are_not_opened_and_a_day_is_replaced(spark):
    path = scratch_path(spark, "sketches")
    daily = Sk.daily_sketches(by_hand(spark), ["grp"])
    Sk.write_daily_sketches(daily, path)
    Sk.write_daily_sketches(daily.where(F.col(Sk.DAY) == "2024-01-02"), path)
    assert Sk.read_daily_sketches(spark, path, "2024-01-01", "2024-01-31").count() == 5
    one = Sk.read_daily_sketches(spark, path, "2024-01-03", "2024-01-03")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sketch_day" in plan
    assert [r.sketch_day for r in one.collect()] == ["2024-01-03"]


def test_ranks_of_many_values(spark):
    many = spark.range(60_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, F.lit("x")).otherwise("hot").alias("grp"),
        (F.timestamp_seconds(F.lit(1704067200) + F.col("id"))).alias("timestamp"),
        F.pmod(F.hash("id"), F.lit(100_000)).cast("long").alias("duration_ms"),
    )
    merged = Sk.merged_latency(Sk.daily_sketches(many, ["grp"]), ["grp"], LEVELS)
    errors = Sk.rank_errors(many, merged, ["grp"], LEVELS).collect()
    assert len(errors) == 2 and all(max(r.p50, r.p99) <= 0.02 for r in errors)
    wrong = merged.withColumn("p50", F.col("p99"))
    assert all(r.p50 > 0.4 for r in Sk.rank_errors(many, wrong, ["grp"], LEVELS).collect())


def test_empty_events(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert Sk.merged_latency(Sk.daily_sketches(none, ["grp"]), ["grp"], LEVELS).count() == 0


def test_rows_are_numbered_in_the_order_they_come(spark):
    table = spark.range(1000, numPartitions=7).select((F.col("id") * 37 % 1000).alias("v"))
    found = Sc.numbered(table.orderBy(F.col("v").desc())).collect()
    assert sorted((r.position, r.v) for r in found) == [(i, 999 - i) for i in range(1000)]
    assert Sc.numbered(table.where("v < 0").orderBy("v")).count() == 0
