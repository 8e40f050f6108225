"""Skew-safe building blocks against brute force."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from opsloom.operators import scale as Sc


def plan_of(df):
    return df._jdf.queryExecution().toString()


@pytest.fixture
def no_broadcast(spark):
    """A cluster-sized situation: nothing is below the broadcast limit."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    spark.conf.set(keys[0], "-1")
    spark.conf.set(keys[1], "-1")
    yield
    for key in keys:
        spark.conf.unset(key)


def skewed_rows(n=3000, seed=5):
    """A third of the rows on one key, some without a key."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else (None if i % 50 == 1 else f"k{rng.randrange(200)}")
        rows.append((i, key))
    return rows


@pytest.mark.parametrize("hot_rows", [5, 100, 10**9])
def test_join_back(spark, no_broadcast, hot_rows):
    rows = spark.createDataFrame(skewed_rows(), "id long, key string")
    per_key = rows.where("key IS NOT NULL").groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
    got = Sc.join_back(rows, per_key, ["key"], "n", ["id"], hot_rows=hot_rows)
    want = defaultdict(list)
    for i, k in skewed_rows():
        want[k].append(i)
    for r in got.collect():
        expected = (None, None) if r.key is None else (len(want[r.key]), min(want[r.key]))
        assert (r.n, r.first) == expected
    assert got.count() == 3000


def test_hot_rows_spread_over_the_shuffle(spark, no_broadcast):
    """The salt is part of the shuffle key, and a hot key's rows land in every partition."""
    rows = spark.createDataFrame(skewed_rows(), "id long, key string").repartition(3)
    per_key = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    got = Sc.join_back(rows, per_key, ["key"], "n", ["id"], hot_rows=100)
    physical = plan_of(got)
    assert "hashpartitioning(key" in physical and "_salt" in physical[physical.index("hashpartitioning(key") :][:80]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        hot = F.count_if((F.col("key") == "hot") & (F.col("n") == 1000)).alias("hot")
        spread = [r.hot for r in got.groupBy(F.spark_partition_id()).agg(hot).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(spread) == 4 and max(spread) < 400


def test_lookup_beyond_the_broadcast_limit(spark, no_broadcast):
    rows = spark.createDataFrame(skewed_rows(), "id long, key string")
    dim = spark.createDataFrame([(f"k{i}", i) for i in range(100)], "key string, v int")
    got = {r.id: r.v for r in Sc.lookup(rows, dim, "key", ["id"]).collect()}
    for i, k in skewed_rows():
        number = int(k[1:]) if k and k != "hot" else None
        assert got[i] == (number if number is not None and number < 100 else None)
    hot_dim = spark.createDataFrame([("hot", 1)], "key string, v int")
    assert Sc.lookup(rows, hot_dim, "key", ["id"]).agg(F.sum("v")).first()[0] == 1000


def test_lookup_below_the_limit_shuffles_nothing(spark):
    rows = spark.createDataFrame(skewed_rows(), "id long, key string")
    dim = spark.createDataFrame([("hot", 1)], "key string, v int")
    joined = Sc.lookup(rows, dim, "key", ["id"])
    joined.collect()
    assert joined.count() == 3000


@pytest.mark.parametrize("inclusive", [True, False])
def test_running(spark, inclusive):
    rng = random.Random(1)
    rows = {(rng.choice("ab"), rng.randrange(-500, 3000)): rng.randrange(-5, 9) for _ in range(800)}
    steps = spark.createDataFrame([(k, t, v) for (k, t), v in rows.items()], "k string, t long, v long")
    folds = {"total": ("sum", F.col("v")), "top": ("max", F.struct("t", "v"))}
    got = Sc.running(steps, ["k"], "t", folds, coarse=500, fine=20, inclusive=inclusive).collect()
    assert len(got) == len(rows)
    for r in got:
        before = [(t, v) for (k, t), v in rows.items() if k == r.k and (t <= r.t if inclusive else t < r.t)]
        assert r.total == sum(v for _, v in before)
        assert (tuple(r.top) if r.top else None) == (max(before) if before else None)


def test_running_keeps_null_keys_apart(spark):
    steps = spark.createDataFrame([(None, 1, 1), (None, 90, 1), ("a", 50, 1)], "k string, t long, v long")
    got = Sc.running(steps, ["k"], "t", {"n": ("sum", F.col("v"))}, 40, 10, null_safe=True).collect()
    assert {(r.k, r.t): r.n for r in got} == {(None, 1): 1, (None, 90): 2, ("a", 50): 1}


def test_exact_percentiles(spark):
    rng = random.Random(2)
    groups = {"a": [rng.randrange(10**7) for _ in range(501)], "b": [7], "c": [rng.randrange(5) for _ in range(400)]}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs] + [("a", None)], "g string, v long")
    levels = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p99": 0.99, "p100": 1.0}
    for r in Sc.exact_percentiles(df, ["g"], "v", levels).collect():
        for name, p in levels.items():
            assert r[name] == pytest.approx(np.percentile(groups[r.g], p * 100), abs=0.006)
    everything = [v for vs in groups.values() for v in vs]
    assert Sc.exact_percentiles(df, [], "v", {"m": 0.5}).first().m == np.percentile(everything, 50)


def test_positions(spark):
    rng = random.Random(4)
    rows = [(rng.randrange(20) / 2, f"E{i:04d}") for i in range(700)]
    df = spark.createDataFrame(rows, "score double, id string").repartition(5)
    got = Sc.positions(df, [F.col("score").desc(), F.col("id")]).collect()
    want = sorted(rows, key=lambda x: (-x[0], x[1]))
    assert [(r.score, r.id) for r in sorted(got, key=lambda r: r.position)] == want
    assert sorted(r.position for r in got) == list(range(700))


def test_lookup_uncounted_spreads_a_hot_key(spark):
    """Nine tenths of the rows on one key, a dimension above the broadcast limit."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")
    before = {n: spark.conf.get(n) for n in names}
    rows = spark.range(2000).select(
        "id", F.when(F.col("id") % 10 > 0, "hot").when(F.col("id") % 20 > 0, F.lit(None)).otherwise("lost").alias("key")
    )
    side = spark.createDataFrame([("hot", 1), ("other", 2)], "key string, known int")
    want = [(r.id, r.key, r.known) for r in rows.join(side, "key", "left").orderBy("id").select("id", "key", "known").collect()]
    try:
        for name, value in zip(names, ("-1", "false", "32")):
            spark.conf.set(name, value)
        out = Sc.lookup_uncounted(rows, side, "key")
        got = out.withColumn("task", F.spark_partition_id()).collect()
        assert out.columns == ["id", "key", "known"]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sorted((r.id, r.key, r.known) for r in got) == want
    tasks = Counter(r.task for r in got if r.key == "hot")
    assert len(tasks) >= 8 and max(tasks.values()) < 1800 / 3


def test_a_side_of_many_rows_in_small_files_is_not_broadcast(spark, scratch):
    """200,000 keys take few bytes as packed Parquet and far more than the limit in a hash table."""
    keys = F.col("id").cast("string").alias("key")
    spark.range(200_000).select(keys, F.lit(True).alias("known")).coalesce(1).write.parquet(f"{scratch}/side")
    side = spark.read.schema("key string, known boolean").parquet(f"{scratch}/side")
    rows = spark.range(400).select("id", (F.col("id") * 1000).cast("string").alias("key"))
    assert Sc.estimated_bytes(side) <= Sc.broadcast_limit(side)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        for joined in (Sc.lookup_uncounted(rows, side, "key"), Sc.lookup(rows, side, "key", ["id"])):
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and ("BroadcastHashJoin" not in plan or "_hot_known" in plan)
            assert joined.where("known").count() == 200 and joined.count() == 400
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_a_stored_side_is_broadcast_by_its_rows(spark, scratch):
    # Some kilobytes of file: the keys are packed.
    rows = spark.range(0, 4000, 1, 1).select("id", F.lit(1).alias("v"))
    rows.write.parquet(f"{scratch}/many")
    rows.limit(1000).write.parquet(f"{scratch}/few")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    plans = {}
    try:
        for most in ("200k", "1k", "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
            for name in ("many", "few"):
                joined = spark.range(5000).join(Sc.by_rows(spark.read.parquet(f"{scratch}/{name}")), "id", "left")
                plans[most, name] = plan_of(joined)
                assert joined.agg(F.sum("v")).first()[0] == (4000 if name == "many" else 1000)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "BroadcastHashJoin" not in plans["200k", "many"] and "strategy=merge" in plans["200k", "many"]
    assert "BroadcastHashJoin" in plans["200k", "few"]
    # What Catalyst takes for large is left to it.
    assert not any("strategy=" in plans[most, name] for most in ("1k", "-1") for name in ("many", "few"))
