"""The pipeline's stages, each on what its predecessor kept, against plain checks."""

import random
import re
from collections import Counter

import corpus_pipeline
from opsloom.llm import mixing, simhash, substrings, toxicity
from opsloom.llm.common import held_out, staged, table
from test_simhash import brute as groups
from test_substrings import brute as cut

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    kept = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = staged(stage(spark, docs, SF), name)
        assert after.columns == docs.columns and after.dtypes == docs.dtypes
        kept[name], docs = after, after
    model = toxicity.fit(kept["documents"], table(spark, SF, "labels"), ~held_out("doc_id", 3, 1))
    texts = {r.doc_id: r.text for r in kept["documents"].collect()}
    clean = {i for i, t in texts.items() if model.scores([(t or "").encode()])[0] < toxicity.THRESHOLD}
    assert {r.doc_id for r in kept["toxicity"].collect()} == clean
    rows = [(i, texts[i]) for i in sorted(clean)]
    assert sorted(r.doc_id for r in kept["simhash_near_dedup"].collect()) == sorted({g for _, _, g in groups(rows)})
    rows = [(r.doc_id, r.text) for r in kept["simhash_near_dedup"].collect()]
    removed = {doc: n for doc, _, n, _ in cut(rows, 35)}
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    before = {i: words(t) for i, t in rows}
    for r in kept["substring_dedup"].collect():
        assert words(r.text) == before[r.doc_id] - removed[r.doc_id] and r.n_chars == len(r.text)
    copies = Counter(r.doc_id for r in kept["mixing"].collect())
    assert max(copies.values()) <= 3 and set(copies) <= set(before)
    out = corpus_pipeline.run(spark, SF).collect()
    assert Counter(r.doc_id for r in out if r.piece == 0) == copies
    spans = {}
    for r in out:
        spans.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in spans.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


def test_stored_sides_of_many_rows_are_not_broadcast(spark, monkeypatch):
    """At a limit of 64 KB, which some 650 rows fill, joins of a few thousand keys in a few KB of files."""
    rng = random.Random(11)
    word = lambda: f"w{rng.randrange(10**6)}"
    passages = [" ".join(word() for _ in range(200)) for _ in range(100)]
    rows = [(i, f"{passages[i % 100]} {word()} {i}" if i < 200 else " ".join(word() for _ in range(9 + i % 7)),
             "en", f"s{i % 5}", 0) for i in range(1600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").coalesce(2)
    plans, limit = {}, spark.conf.get("spark.sql.autoBroadcastJoinThreshold")

    def joins(df):
        return set(re.findall(r"(\w+Join) .*?(Inner|LeftSemi|LeftOuter)", df._jdf.queryExecution().executedPlan().toString()))

    def watched(df, name, *rest):
        plans.setdefault(name, joins(df))
        return staged(df, name, *rest)

    for module in (simhash, substrings, mixing):
        monkeypatch.setattr(module, "staged", watched)

    def run(most):
        plans.clear()
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
        try:
            kept = simhash.keep_one(docs)
            plans["kept"] = joins(kept)
            return [sorted(map(tuple, df.collect())) for df in (kept, substrings.without_repeats(docs), mixing.mix(docs))]
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)

    found = run("64k")
    assert plans["kept"] == {("SortMergeJoin", "LeftSemi")}
    assert ("SortMergeJoin", "LeftSemi") in plans["marked-texts"]
    assert ("BroadcastHashJoin", "LeftSemi") not in plans["marked-texts"] | plans["kept"]
    assert plans["taken"] == {("SortMergeJoin", "LeftOuter")}
    assert found == run("10m")
    assert plans["kept"] == {("BroadcastHashJoin", "LeftSemi")} and ("BroadcastHashJoin", "LeftOuter") in plans["taken"]
    assert len(found[0]) > 1300 and sum(r[0] < 200 and len(r[1].split()) == 2 for r in found[1]) == 200
