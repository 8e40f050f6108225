"""Classifiers: held-out accuracy, counterfactual regularisation, gradients, edge cases."""

import numpy as np
import pytest

from opsloom.llm import quality, toxicity

LARGER = "/root/testdata/sf0.01"


def accuracy(spark, module, label):
    docs, labels = (spark.read.parquet(f"{LARGER}/{n}.parquet") for n in ("documents", "labels"))
    rows = module.scored(docs, labels).where("held_out").join(labels, "doc_id").toPandas()
    y = rows[label].to_numpy()
    return (rows.predicted[y == 1] == 1).mean(), (rows.predicted[y == 0] == 0).mean()


def test_held_out_accuracy(spark):
    hit, clean = accuracy(spark, quality, "quality")
    assert hit > 0.95 and clean > 0.95
    hit, clean = accuracy(spark, toxicity, "toxic")
    assert hit > 0.6 and clean > 0.97


def labelled(spark, texts, label):
    ids = range(len(texts))
    docs = spark.createDataFrame([(i, t, "x") for i, t in zip(ids, texts)], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, v) for i, v in zip(ids, label)], "doc_id long, toxic int")
    return docs.select("doc_id", "text"), labels


def test_identity_terms_lose_their_weight(spark):
    # Women are named in toxic texts more often than men; the insult is what is toxic.
    texts = [f"the women are {w}" for w in ["idiots"] * 60 + ["here"] * 20] + [f"the men are {w}" for w in ["here"] * 60 + ["idiots"] * 20]
    label = [1] * 60 + [0] * 20 + [0] * 60 + [1] * 20
    docs, labels = labelled(spark, texts, label)
    from pyspark.sql import functions as F

    def gap(penalty):
        model = toxicity.fit(docs, labels, F.lit(True), penalty=penalty)
        a, b, insult = model.scores([b"the women are here", b"the men are here", b"the men are idiots"])
        assert insult > 0.7
        return abs(a - b)

    assert gap(20.0) < 0.3 * gap(0.0) + 1e-3


def test_swap_in_sentences():
    turn = toxicity.swaps((("women", "men"),))
    pattern = toxicity.term_pattern(turn)
    found = toxicity.mentions("Omens. Women and men, omens! None here?\nThe men", turn, pattern)
    assert sorted(found) == [("The men", "The women"), ("Women and men, omens", "men and women, omens")]
    assert toxicity.mentions("omens", turn, pattern) == []
    assert len(toxicity.mentions(". ".join(f"men {i}" for i in range(200)), turn, pattern)) == toxicity.MENTIONS
    assert toxicity.mentions("men", {}, toxicity.term_pattern({})) == []


def test_terms_stand_in_one_group():
    terms = [t for group in toxicity.IDENTITY_GROUPS for t in group]
    assert len(terms) == len(set(terms)) == len(toxicity.swaps())


@pytest.mark.parametrize("one, other", [("women", "men"), ("juden", "christen"), ("musulmans", "chrétiens"), ("mujeres", "hombres")])
def test_neutral_mentions_are_not_blamed(spark, one, other):
    """Labelled prose in which a group is named in many insulting texts: clean held-out texts that name it pass."""
    from pyspark.sql import functions as F

    rng = np.random.default_rng(3)
    words = [f"word{i}" for i in range(300)]

    def text(term, insult):
        said = lambda n: " ".join(rng.choice(words, n))
        middle = f" {said(2)} {insult} {said(2)}." if insult else ""
        return f"{said(6)}.{middle} {said(3)} {term} {said(3)}."

    insults = ["".join(rng.choice(list("abcdefghij"), 7)) for _ in range(15)]
    texts = [text(one, rng.choice(insults)) for _ in range(200)] + [text(other, None) for _ in range(200)]
    texts += [text("word1", rng.choice(insults)) for _ in range(40)] + [text("word1", None) for _ in range(40)]
    docs, labels = labelled(spark, texts, [1] * 200 + [0] * 200 + [1] * 40 + [0] * 40)
    neutral = [text(one, None).encode() for _ in range(200)]
    toxic = [text(other, rng.choice(insults)).encode() for _ in range(200)]

    def rates(penalty):
        model = toxicity.fit(docs, labels, F.lit(True), penalty=penalty)
        return [(model.scores(t) >= 0.5).mean() for t in (neutral, toxic)]

    (blamed, _), (cleared, found) = rates(0.0), rates(20.0)
    print(one, blamed, cleared, found)
    assert blamed > 0.5 and cleared < 0.05 and found > 0.9


@pytest.mark.parametrize("module", [quality, toxicity])
def test_edge_cases(spark, module):
    name = "quality" if module is quality else "toxic"
    docs = spark.createDataFrame(
        [(1, None, "a"), (2, "", "b"), (2, "", "b"), (None, "x y", None), (4, "w " * 30_000, "c")], "doc_id long, text string, label string"
    )
    empty = spark.createDataFrame([], f"doc_id long, {name} int")
    out = module.scored(docs, empty).collect()
    assert len(out) == 5 and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in out)
    some = spark.createDataFrame([(i, v) for i in range(12) for v in (None, 1)], f"doc_id long, {name} int")
    assert module.scored(docs, some).count() == 5
    assert module.scored(docs.limit(0), some).count() == 0


@pytest.mark.parametrize("module", [quality, toxicity])
def test_an_id_with_many_rows_does_not_fill_the_sample(spark, monkeypatch, module):
    from pyspark.sql import functions as F

    name = "quality" if module is quality else "toxic"
    rows = [(i, f"text {i} {'good' if i % 2 else 'bad'}") for i in range(20)]
    rows += [(0, f"word{i} of its own bad") for i in range(1500)] + [(1, "text 1 good")] * 1500
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], f"doc_id long, {name} int")
    seen = []
    inner = "learn" if module is quality else "_logistic"
    kept = getattr(module, inner)
    monkeypatch.setattr(module, inner, lambda *a: seen.append(a) or kept(*a))
    module.fit(docs, labels, F.lit(True), sample=200)
    target = seen[0][2] if module is quality else seen[0][1]
    assert 20 <= len(target) <= 60  # every id, and about 200 / 20 texts of the one that has many


def test_passages_of_all_lengths():
    texts = [b"", b"a", b"w " * 64, b"w " * 65, b"x y " * 5000]
    x, owner = quality.passages(texts)
    assert np.bincount(owner).tolist() == [1, 1, 1, 2, 157] and x.shape[1] == quality.WIDTH and np.isfinite(x).all()
    x, owner = quality.passages([b"", b" "])
    assert owner.tolist() == [0, 1] and x.shape == (2, quality.WIDTH)


def test_the_fit_reads_a_bounded_number_of_passages(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(quality, "BAG", 5)
    docs = spark.createDataFrame([(i, f"{'good' if i % 2 else 'BAD!'} " * (64 * n)) for i, n in enumerate((1, 3, 5, 6, 400))], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(5)], "doc_id long, quality int")
    seen = []
    kept = quality.learn
    monkeypatch.setattr(quality, "learn", lambda *a: seen.append(a) or kept(*a))
    quality.fit(docs, labels, F.lit(True))
    assert np.bincount(seen[0][1]).tolist() == [1, 3, 5, 5, 5]


def test_attention_finds_the_one_bad_passage():
    rng = np.random.default_rng(0)
    owner = np.repeat(np.arange(200), 6)
    x = rng.normal(size=(1200, 4))
    label = np.arange(200) % 2
    x[np.arange(200) * 6 + rng.integers(0, 6, 200), 0] += np.where(label == 1, 6, 0)
    model = quality.learn(x, owner, label.astype(float))
    found = model.forward(x, owner, 200)
    assert ((found["s"] > 0.5) == label).mean() > 0.95
    assert np.allclose(np.bincount(owner, found["a"]), 1)
