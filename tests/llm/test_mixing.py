"""Mixing: targets against a plain loop, rounding against its invariants, whole runs against targets."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from opsloom.llm import mixing
from opsloom.llm.queries import queries


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, target, capped = sum(sizes.values()), {}, set()
    while True:
        free = [s for s in names if s not in capped]
        rest = total - sum(3 * sizes[s] for s in capped)
        target = {s: 3.0 * sizes[s] for s in capped}
        target |= {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        above = {s for s in free if target[s] > 3 * sizes[s]}
        if not above:
            return target
        capped |= above


def test_chain_keeps_sum_and_expectation():
    rng = np.random.default_rng(1)
    probs = rng.random(41)
    runs = np.array([mixing.chain(probs, np.random.default_rng(i)) for i in range(4000)])
    assert np.allclose(runs.sum(axis=1), probs.sum())
    assert ((runs > 0) & (runs < 1)).sum(axis=1).max() <= 1
    assert np.abs(runs.mean(axis=0) - probs).max() < 0.035


def sources_of(rows):
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    return dict(sizes)


def check(spark, rows, tolerance):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    out = mixing.mix(docs).collect()
    assert sorted((r.doc_id for r in out), key=repr) == sorted((r[0] for r in rows), key=repr)
    by_id = {r[0]: r for r in rows}
    sizes = sources_of(rows)
    target = plain_targets(sizes) if sum(sizes.values()) else {s: 0.0 for s in sizes}
    taken = defaultdict(int)
    for r in out:
        source = by_id[r.doc_id][2]
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", by_id[r.doc_id][1] or ""))
        assert r.source_size == sizes[source] and r.target == pytest.approx(target[source])
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
        taken[source] += r.taken
    for s in sizes:
        assert abs(taken[s] - target[s]) <= tolerance * max(1, target[s]) + 2, s
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, out))


def test_many_sources_and_a_hot_one(spark):
    rng = random.Random(2)
    rows = []
    for i in range(3000):
        source = "hot" if rng.random() < 0.4 else f"s{rng.randrange(6)}"
        rows.append((i, "w " * int(rng.lognormvariate(4, 1)), source))
    rows += [(9001, "a b c", None), (9002, None, None), (9003, "", "empty"), (9004, "one", "é")]
    check(spark, rows, 0.01)


def test_parts_of_a_band(spark, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP", 8)
    monkeypatch.setattr(mixing, "FAN_IN", 2)
    check(spark, [(i, "w " * (i % 50 + 10), f"s{i % 4}") for i in range(1200)], 0.01)


def test_equal_rows_are_dealt_over_the_parts(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(mixing, "GROUP", 8)
    monkeypatch.setattr(mixing, "FAN_IN", 2)
    rows = [(i, "w " * (i % 50 + 10), f"s{i % 3}") for i in range(200)] + [(7, "w " * 17, "s1")] * 400
    check(spark, rows, 0.01)
    keys = spark.range(0, 300, 1, 5).select(
        F.monotonically_increasing_id().alias("row"), F.when(F.col("id") < 260, 1).otherwise(F.col("id")).alias("key")
    )
    out = mixing.copy_numbers(keys).collect()
    assert sorted(r.copy for r in out if r.key == 1) == list(range(260))
    assert len(out) == 300 and all(r.copy == 0 for r in out if r.key != 1)
    seen = []
    inner = mixing._chained

    def spied(seed, level):
        run = inner(seed, level)

        def sized(key: tuple, rows):
            return run(key, rows.assign(size=len(rows)))

        seen.append(level)
        return sized

    monkeypatch.setattr(mixing, "_chained", spied)
    many = spark.range(0, 400, 1, 5).select(
        F.monotonically_increasing_id().alias("row"), F.lit(1).cast("long").alias("key"), F.lit(17).cast("long").alias("size"),
        F.lit(0).cast("long").alias("source_row"), F.lit(16).alias("band"), F.lit(0).cast("long").alias("sub"), F.lit(0.3).alias("prob"),
    )
    out = mixing.rounded(many, 1).collect()
    assert seen[0] == 0 and max(r.size for r in out) <= 2 * mixing.GROUP
    assert len(out) == 400 and sum(r.prob for r in out) in (119, 120, 121)


def test_nothing_to_take(spark):
    check(spark, [(1, None, "a"), (2, " ", None)], 0)
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(docs).count() == 0 and mixing.mixed(docs).count() == 0


def test_mixed_repeats_rows(spark):
    rows = [(i, f"w{i} " * (10 + i % 7), f"s{i % 3}", i) for i in range(60)] + [(5, "w5 " * 15, "s2", 5)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, copies int")
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    plan = mixing.mix(docs).collect()
    assert out.count() == sum(r.copies for r in plan)


def test_query(spark, sf):
    out = queries()["op3_mixing"](spark, sf).collect()
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "source").collect()]
    sizes, taken, by_id = sources_of(rows), defaultdict(int), {r[0]: r for r in rows}
    target = plain_targets(sizes)
    for r in out:
        taken[by_id[r.doc_id][2]] += r.taken
    assert len(out) == len(rows) and sum(target.values()) == pytest.approx(sum(sizes.values()))
    assert sum(abs(taken[s] - target[s]) for s in sizes) < 0.05 * sum(sizes.values())
