"""Importance resampling against plain counters."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

from opsloom.llm import resampling
from opsloom.llm.queries import queries


def listed(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def plain(rows, target, buckets=10_000, percent=25, least=20):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(map(bucket, listed(text)[1]))
    for text in target:
        t.update(map(bucket, listed(text)[1]))
    S, T = s.total(), t.total()
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets))))
    out = []
    for doc, text in rows:
        words, found = listed(text)
        weight = sum(gain(bucket(f)) for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc, len(found), weight, score, len(words) >= least])
    able = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0]))
    for rank, row in enumerate(able):
        row[4] = rank + 1 if rank < len(able) * percent // 100 else None
    return sorted((tuple(None if x is False else x for x in r) for r in out), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


def test_random_texts(spark, monkeypatch):
    rng = random.Random(2)
    parts = ["a", "B", "Zz9", "é", "É", "漢字", " ", " ", "\n", ",", "\x00", "-", "_", "{", "\x7f", "\x80", "\u2028", "ss "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(120))) for _ in range(400)]
    texts += [None, "", " ", "a", "x" * 300, "w " * 50_000, "\n"]
    rows = list(enumerate(texts)) + [(None, "a b " * 30)]
    target = [t for t in texts[:30] if t] + [None, ""]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    assert got(resampling.resample(docs, aim)) == plain(rows, target)
    assert got(resampling.resample(docs, aim, buckets=7, percent=60, least_words=3)) == plain(rows, target, 7, 60, 3)
    monkeypatch.setattr("opsloom.llm.common.BYTES_PER_SLICE", 100)
    want = [len(listed(t)[1]) for t in texts]
    hashes, owner, _ = resampling.features([(t or "").encode() for t in texts])
    assert [sum(owner == i) for i in range(len(texts))] == want and len(hashes) == sum(want)


def test_ties_repeats_and_empty_tables(spark):
    rows = [(1, "a b c " * 9, "x")] * 8 + [(2, "a b c " * 9, None)] * 4 + [(3, "short", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rank string").repartition(3)
    aim = spark.createDataFrame([("a b",)], "text string")
    out = resampling.resample(docs, aim)
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    rows = out.collect()
    assert sorted(r["rank"] for r in rows if r["rank"]) == [1, 2, 3] and len(rows) == 13
    best = max(r.score for r in rows if r.doc_id != 3)
    assert all(r.score == best for r in rows if r["rank"])
    assert resampling.resample(docs.limit(0), aim).count() == 0
    assert resampling.resample(docs, aim.limit(0)).count() == 13


def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert got(queries()["op11_resampling"](spark, sf)) == plain(rows, target)
