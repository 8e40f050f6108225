"""SimHash groups against a brute-force comparison of all pairs."""

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from opsloom.llm import simhash


def brute(rows, shingle=3):
    prints = {}
    for i, (_, text) in enumerate(rows):
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", lower)
        grams = [" ".join(words[k : k + shingle]) for k in range(max(1, len(words) - shingle + 1))] if words else []
        hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    groups = {}
    for i, (doc, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc)
    least = {g: min((d for d in docs if d is not None), default=None) for g, docs in groups.items()}
    return sorted(
        ((doc, f"{prints[i]:016x}", least[find(i)]) for i, (doc, _) in enumerate(rows)), key=repr
    )


def same(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in simhash.near_duplicates(docs).collect()]
    assert sorted(got, key=repr) == brute(rows)


def test_edge_cases(spark):
    same(spark, [(1, None), (2, ""), (3, " \t\n"), (4, "A"), (5, "a"), (5, "a"), (None, "a b"), (7, "a b É"),
                 (8, "x y z"), (9, "X\ny  z"), (10, "word " * 30_000)])


def test_groups_of_near_copies(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for group in range(12):
        base = [rng.choice(words) for _ in range(300)]
        for _ in range(9):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 6])):
                copy[rng.randrange(300)] = rng.choice(words)
            rows.append((len(rows) * 7 % 1000, " ".join(copy)))
    same(spark, rows)


@pytest.mark.parametrize("crowded", [0, 2, 10, 1024])
def test_links_connect_all_within_two_bits(spark, crowded):
    rng = random.Random(5)
    values = {0, (1 << 64) - 1, 1 << 63, 1 << 31, 1 << 32, 3 << 31}
    for _ in range(6):
        x = rng.getrandbits(64)
        for _ in range(60):
            values.add(x)
            x ^= 1 << rng.randrange(64)
    shared = rng.getrandbits(32)  # one half in common, some of the other halves close to each other
    others = [rng.getrandbits(32) for _ in range(20)]
    values |= {shared << 32 | o ^ flip for o in others for flip in (0, 1, 1 << 31, 6)}
    values |= {(shared ^ 4) << 32 | others[0] ^ flip for flip in (0, 2, 3)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], "fp long")
    found = {tuple(r) for r in simhash.links(frame, crowded).collect()}
    near = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 2}
    assert found <= near
    if crowded == 1024:
        assert found == near
    root = {v: v for v in signed}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in found:
        root[find(a)] = find(b)
    assert all(find(a) == find(b) for a, b in near)


def test_a_broadcast_is_decided_by_rows_not_by_the_stored_size(spark, scratch):
    numbers = spark.range(6000).select(F.xxhash64("id").alias("fp"))
    pairs = numbers.where("pmod(fp, 50) = 0").select(F.col("fp").bitwiseXOR(F.lit(5)).alias("fp"))
    numbers.unionByName(pairs).coalesce(1).write.parquet(f"{scratch}/prints")
    prints = spark.read.parquet(f"{scratch}/prints")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")

    def joined(most):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
        try:
            found = simhash.links(prints)
            plan = found._jdf.queryExecution().executedPlan().toString()
            return sorted(map(tuple, found.collect())), set(re.findall(r"(\w+Join) \[segment.*?, Inner(?:, (Build\w+))?", plan))
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)

    # 0.05 MB of file are some 12,000 entries and 210,000 lookups.
    by_shuffle, shuffled = joined("256k")
    by_broadcast, tables = joined("10m")
    assert shuffled == {("SortMergeJoin", "")} and tables == {("BroadcastHashJoin", "BuildLeft")}
    assert by_shuffle == by_broadcast and len(by_shuffle) == pairs.count() > 50


def test_empty_table_and_clashing_columns(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).count() == 0
    rows = [(1, "a b c", "x", 2), (2, "a b c", "y", 3), (2, "a b c", "y", 3), (3, "other words here now", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string, component_id int")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3]


def test_one_row_of_each_group_stays(spark):
    a, b, c = "a b c d e", "other words stand here now", "third text without any id"
    rows = [(3, a, 0), (5, a, 1), (5, b, 2), (None, c, 3), (None, c, 4), (None, a, 5), (None, "alone as well", 6),
            (7, "one id", 7), (7, "with two texts", 8), (None, None, 9), (9, "", 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row int").repartition(3)
    kept = simhash.keep_one(docs)
    assert kept.dtypes == docs.dtypes
    found = sorted((tuple(r)[:2] for r in kept.collect()), key=repr)
    assert found == sorted(
        [(3, a), (5, b), (None, c), (None, "alone as well"), (7, "one id"), (7, "with two texts"), (9, "")], key=repr
    )
    assert simhash.keep_one(docs.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["documents"])
def test_query_against_all_pairs(spark, sf, name):
    from opsloom.llm.queries import queries

    docs = spark.read.parquet(f"{sf}/{name}.parquet").select("doc_id", "text")
    got = sorted((tuple(r) for r in queries()["op5_simhash"](spark, sf).select(
        "doc_id", "fingerprint", "component_id").collect()), key=repr)
    assert got == brute([tuple(r) for r in docs.orderBy(F.col("doc_id")).collect()])
