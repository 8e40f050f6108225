"""Vector links against all pairs: recall, no false link, components and counts of copies."""

import numpy as np

from opsloom.llm import embeddings
from opsloom.llm.queries import queries

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, least=0.93):
    good = [(i, np.array(v, float), y) for i, v, y in rows if y is not None and v and None not in v]
    good = [(i, v, y) for i, v, y in good if np.isfinite(v).all() and v.any()]
    links = set()
    for k, (i, v, y) in enumerate(good):
        for j, w, z in good[:k]:
            if y == z and len(v) == len(w) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= least:
                links.add((min(i, j), max(i, j)))
    return links


def near(rng, v, cosine):
    noise = rng.normal(size=len(v))
    noise -= noise @ v / (v @ v) * v
    return v / np.linalg.norm(v) * cosine + noise / np.linalg.norm(noise) * np.sqrt(1 - cosine**2)


def found(spark, rows):
    return {r.vec_id: r for r in embeddings.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}


def test_recall_near_the_limit(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 7)
    rng = np.random.default_rng(1)
    rows = []
    for pair in range(300):
        v = rng.normal(size=32)
        cosine = rng.choice([0.9, 0.925, 0.935, 0.95, 0.97, 0.99])
        rows += [(2 * pair, v.tolist(), pair % 3), (2 * pair + 1, near(rng, v, cosine).tolist(), pair % 3)]
    want = brute(rows)
    out = found(spark, rows)
    n = {i: sum(i in pair for pair in want) for i, _, _ in rows}
    assert all(out[i].n_links <= n[i] for i in n)
    assert sum(r.n_links for r in out.values()) >= 0.93 * 2 * len(want)
    assert all(r.kept == (r.vec_id == r.component_id) for r in out.values())


def test_dense_group_and_copies(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 16)
    rng = np.random.default_rng(2)
    v = rng.normal(size=16)
    rows = [(i, near(rng, v, 0.999).tolist(), 1) for i in range(100, 220)] + [(i, v.tolist(), 1) for i in range(40)]
    rows += [(300 + i, v.tolist(), 2) for i in range(5)] + [(400, (2 * v).tolist(), 2)]
    out = found(spark, rows)
    assert all(out[i].n_links == 159 and out[i].component_id == 0 for i, _, y in rows if y == 1)
    assert all(out[i].n_links == 5 and out[i].component_id == 300 for i, _, y in rows if y == 2)
    assert sum(r.kept for r in out.values()) == 2


def test_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [nan, 1.0], 1), (5, [inf, 1.0], 1), (6, [None, 1.0], 1),
            (7, [1.0, 0.0], None), (8, [1.0, 0.0], 1), (9, [1.0, 0.0, 0.0], 1), (10, [1.0, -0.0], 1), (10, [1.0, 0.0], 1)]
    out = embeddings.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    linked = sorted((r.vec_id, r.n_links, r.component_id) for r in out if r.n_links)
    assert len(out) == 11 and linked == [(8, 2, 8), (10, 2, 8), (10, 2, 8)]
    assert embeddings.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_very_large_and_very_small_components(spark):
    rng = np.random.default_rng(5)
    v = rng.normal(size=8)
    rows = [(i, (near(rng, v, 0.999) * scale).tolist(), 1) for i, scale in enumerate((1.0, 1e200, 1e-200, 1e307, 1e-300))]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    out = embeddings.near_duplicates(vectors).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in out) == [(i, 4, 0) for i in range(5)]


def test_query_recall(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    out = queries()["op6_embeddings"](spark, sf).collect()
    assert len(out) == len(rows) and sum(r.n_links for r in out) >= 0.9 * 2 * len(brute(rows))
