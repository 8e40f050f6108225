"""Toxicity: a sparse word classifier, regularised by counterfactual swaps of identity terms."""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsloom.llm.common import held_out, mapped, ready, slices, staged, text_or_empty
from opsloom.llm.tokens import byte_values, joined, mix, powers, runs, utf8

SAMPLE = 12_000  # labelled rows the classifier is fitted on, about
FEATURES = 4096  # words and word beginnings it weighs
LEAST_TOLD = 7.0  # nats that a feature's presence tells about the label, over the sample
BEGINNINGS = (4, 5, 6)  # bytes
PENALTY = 2.0  # of squared score changes under a swap
THRESHOLD = 0.7

# Sentences of one text that the penalty reads; of a text with more, those of least hash.
MENTIONS = 32

# Terms of one group are swapped for each other, in turn; a term stands in one group only.
IDENTITY_GROUPS = (
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("female", "male"),
    ("gay", "straight"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino"),
    ("africans", "europeans", "americans", "mexicans", "arabs"),
    ("immigrants", "natives"),
    ("frauen", "männer"),
    ("frau", "mann"),
    ("mädchen", "jungen"),
    ("schwule", "lesben"),
    ("christen", "muslime", "juden", "buddhisten", "atheisten"),
    ("afrikaner", "europäer", "amerikaner", "mexikaner", "araber"),
    ("einwanderer", "einheimische"),
    ("femmes", "hommes"),
    ("femme", "homme"),
    ("filles", "garçons"),
    ("chrétiens", "musulmans", "juifs", "hindous", "bouddhistes", "athées"),
    ("africains", "européens", "américains", "mexicains", "arabes"),
    ("immigrés", "autochtones"),
    ("mujeres", "hombres"),
    ("mujer", "hombre"),
    ("chicas", "chicos"),
    ("cristianos", "musulmanes", "judíos", "budistas", "ateos"),
    ("africanos", "europeos", "americanos", "mexicanos", "árabes"),
    ("inmigrantes", "nativos"),
)
SENTENCE = re.compile(r"[^.!?\u2026\u3002\uff01\uff1f\n]+")


def swaps(groups: tuple[tuple[str, ...], ...] = IDENTITY_GROUPS) -> dict[str, str]:
    return {term: group[(i + 1) % len(group)] for group in groups for i, term in enumerate(group)}


def term_pattern(turn: dict[str, str]) -> re.Pattern:
    return re.compile(r"\b(" + "|".join(map(re.escape, turn)) + r")\b", re.IGNORECASE) if turn else re.compile("(?!)")


def mentions(text: str, turn: dict[str, str], pattern: re.Pattern, most: int = MENTIONS) -> list[tuple[str, str]]:
    """The different sentences with an identity term, each with its terms exchanged; `most` at most."""
    if not pattern.search(text):
        return []
    found = {s for s in (m[0].strip() for m in SENTENCE.finditer(text)) if pattern.search(s)}
    kept = sorted(found, key=lambda s: (zlib.crc32(s.encode()), s))[:most]
    # Lower-casing may turn a letter into two, which no listed term has; such a match stays.
    return [(s, pattern.sub(lambda m: turn.get(m[0].lower(), m[0]), s)) for s in kept]


def _letters() -> np.ndarray:
    flags = np.zeros(256, bool)
    flags[np.r_[65:91, 97:123, 128:256]] = True
    return flags


_LETTERS = _letters()


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (runs of letters, A-Z lowered) and of their beginnings, and whose they are."""
    buffer, text_starts = joined(texts)
    buffer = buffer.copy()
    buffer[(buffer >= 65) & (buffer <= 90)] += 32
    starts, ends = runs(_LETTERS[buffer])
    up, down = powers(len(buffer))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(byte_values(21)[buffer] * up[: len(buffer)])])
    owner = np.searchsorted(text_starts, starts, side="right") - 1
    base, scale = sums[starts], down[starts]
    hashes, owners = [mix((sums[ends] - base) * scale + np.uint64(1))], [owner]
    for n in BEGINNINGS:
        on = np.flatnonzero(ends - starts > n)
        hashes.append(mix((sums[starts[on] + n] - base[on]) * scale[on] + np.uint64(n)))
        owners.append(owner[on])
    return np.concatenate(hashes), np.concatenate(owners)


def _feature_lists(texts: list[bytes]) -> list[np.ndarray]:
    out = []
    for i, j in slices(texts):
        hashes, owner = features(texts[i:j])
        order = np.lexsort([hashes, owner])
        hashes, owner = hashes[order], owner[order]
        new = np.append(True, (np.diff(hashes) != 0) | (np.diff(owner) != 0))[: len(hashes)]
        hashes, owner = hashes[new].view(np.int64), owner[new]
        out += np.split(hashes, np.searchsorted(owner, np.arange(1, j - i)))
    return out


@dataclass(frozen=True)
class Model:
    """Sorted feature hashes, their weights, and the constant. A bounded size: at most FEATURES."""

    keys: np.ndarray
    weights: np.ndarray
    constant: float

    def scores(self, texts: list[bytes]) -> np.ndarray:
        out = [np.zeros(0)]
        near = np.zeros(1 << 18, bool)
        near[(self.keys >> np.uint64(46)).astype(np.int64)] = True
        for i, j in slices(texts):
            total = np.full(j - i, self.constant)
            if len(self.keys):
                hashes, owner = features(texts[i:j])
                on = near[(hashes >> np.uint64(46)).astype(np.int64)]
                hashes, owner = hashes[on], owner[on]
                at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
                on = self.keys[at] == hashes
                pairs = np.unique(owner[on] * len(self.keys) + at[on])
                total += np.bincount(pairs // len(self.keys), self.weights[pairs % len(self.keys)], minlength=j - i)
            out.append(1 / (1 + np.exp(-np.clip(total, -50, 50))))
        return np.concatenate(out)

    def score(self, text: Column) -> Column:
        model = self

        @F.pandas_udf("double")
        def run(texts: pd.Series) -> pd.Series:
            return pd.Series(model.scores([t.encode() for t in texts]))

        return run(text)


def _flat(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all rows, one after another, and the row of each."""
    index = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
    return index, np.repeat(np.arange(len(rows)), [len(r) for r in rows])


def _logistic(
    rows: list[np.ndarray], labels: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]], n: int, penalty: float,
    turns: int = 400, decay: float = 2e-5,
) -> tuple[np.ndarray, float]:
    """Weights by gradient descent on log loss + penalty * mean squared change of score over the pairs."""
    index, owner = _flat(rows)
    sides = [_flat([pair[i] for pair in pairs]) for i in (0, 1)]
    weights, constant = np.zeros(n + 1), float(np.log((labels.mean() + 1e-6) / (1 - labels.mean() + 1e-6)))
    weights[n] = constant
    first, second = np.zeros(n + 1), np.zeros(n + 1)
    for turn in range(1, turns + 1):
        z = weights[n] + np.bincount(owner, weights[index], minlength=len(rows))
        s = 1 / (1 + np.exp(-z))
        pull = (s - labels) / len(rows)
        gradient = np.zeros(n + 1)
        if pairs:
            sums = [weights[n] + np.bincount(of, weights[at], minlength=len(pairs)) for at, of in sides]
            sentence, twin = (1 / (1 + np.exp(-v)) for v in sums)
            change = 2 * penalty * (sentence - twin) / len(pairs)
            for (at, of), score, sign in zip(sides, (sentence, twin), (1, -1)):
                slope = sign * change * score * (1 - score)
                gradient[:n] += np.bincount(at, slope[of], minlength=n)
                gradient[n] += slope.sum()
        gradient[:n] += np.bincount(index, pull[owner], minlength=n) + decay * weights[:n]
        gradient[n] += pull.sum()
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        step = (first / (1 - 0.9**turn)) / (np.sqrt(second / (1 - 0.999**turn)) + 1e-8)
        weights = weights - 0.05 * step
    return weights[:n], float(weights[n])


def labelled_sample(labels: DataFrame, label_col: str, training: Column, sample: int) -> DataFrame:
    """About `sample` rows doc_id, label by the hash of the id; null labels out, the largest of several."""
    usable = (
        labels.where(training & F.col("doc_id").isNotNull() & F.col(label_col).isNotNull())
        .groupBy("doc_id")
        .agg(F.max(F.col(label_col).cast("int")).alias("label"))
    )
    share = min(1.0, sample / max(1, usable.count()))
    return usable.where(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 20)) < int(share * (1 << 20)))


def labelled_texts(docs: DataFrame, labels: DataFrame, label_col: str, training: Column, sample: int) -> DataFrame:
    """About `sample` rows doc_id, label, text at most, for the ids of `labelled_sample`.

    A text that an id repeats is one row. The rows are shared out evenly over the ids: of an id with
    more different texts than its share a part is drawn by the hash of the text.
    """
    chosen = labelled_sample(labels, label_col, training, sample)
    # The sample's ids are few by the parameter, so the texts need no shuffle.
    rows = staged(
        docs.select("doc_id", text_or_empty("text").alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .withColumn("hash", F.xxhash64("text")),
        "labelled-texts",
    )
    counts = staged(
        rows.select("doc_id", "hash").distinct().groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")), "labelled-counts"
    )
    share = max(1.0, sample / max(1, counts.count())) / F.col("n")
    drawn = F.pmod(F.xxhash64("doc_id", "hash", F.lit(11)), F.lit(1 << 20)) < share * (1 << 20)
    return (
        rows.join(F.broadcast(counts), "doc_id")
        .where(drawn)
        .groupBy("doc_id", "hash")
        .agg(F.first("label").alias("label"), F.first("text").alias("text"))
        .select("doc_id", "label", "text")
    )


def fit(
    docs: DataFrame,
    labels: DataFrame,
    training: Column,
    label_col: str = "toxic",
    sample: int = SAMPLE,
    groups: tuple[tuple[str, ...], ...] = IDENTITY_GROUPS,
    penalty: float = PENALTY,
) -> Model:
    """A classifier from labelled rows for which `training` (over labels) holds.

    Features are the words and beginnings whose presence tells most about the label in the sample.
    Every sentence of a sample row that has an identity term (MENTIONS a text at most) is also read with
    the term swapped for another of its group, and the loss has the squared difference of the two
    scores: the terms themselves then carry no weight, neutral mentions no blame. Without both labels
    in the sample the score is the share of label 1, or 0.
    """
    rows = labelled_texts(docs, labels, label_col, training, sample)
    turn = swaps(groups)
    pattern = term_pattern(turn)

    def lists(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").to_pylist()
        pairs = [mentions(t, turn, pattern) for t in texts]
        kind = pa.list_(pa.int64())

        def sides(i: int) -> pa.Array:
            flat = iter(_feature_lists([pair[i].encode() for found in pairs for pair in found]))
            return pa.array([[next(flat) for _ in found] for found in pairs], pa.list_(kind))

        own = pa.array(_feature_lists([t.encode() for t in texts]), kind)
        return pa.RecordBatch.from_arrays(
            [batch.column("label"), own, sides(0), sides(1)], ["label", "own", "sentences", "twins"]
        )

    nested = "label int, own array<{0}>, sentences array<array<{0}>>, twins array<array<{0}>>"
    read = staged(mapped(rows, lists, nested.format("long")), "toxicity-sample")
    n, ones = read.agg(F.count(F.lit(1)), F.sum("label")).first()
    if not n or not 0 < ones < n:
        share = (ones or 0) / n if n else 0.0
        return Model(np.zeros(0, np.uint64), np.zeros(0), 50.0 if share == 1 else -50.0)
    count, hits = F.col("n").cast("double"), F.col("ones").cast("double")
    rate = (hits + 0.5) / (count + 1)
    # How much the rows with the feature depart from the overall rate, in nats.
    told = hits * F.log(rate / (ones / n)) + (count - hits) * F.log((1 - rate) / (1 - ones / n))
    best = (
        read.select("label", F.explode("own").alias("feature"))
        .groupBy("feature")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("ones"))
        .withColumn("told", told)
        .where(F.col("told") >= LEAST_TOLD)
        .orderBy(F.col("told").desc(), "feature")
        .limit(FEATURES)
        .select("feature")
    )
    keys = np.sort(np.array([r.feature for r in best.collect()], np.int64).view(np.uint64))
    if not len(keys):
        return Model(keys, np.zeros(0), float(np.log(ones / (n - ones))))

    def known(batch: pa.RecordBatch) -> pa.RecordBatch:
        def pick(values):
            hashes = np.array(values, np.int64).view(np.uint64)
            at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
            return at[keys[at] == hashes].astype(np.int32)

        kind = pa.list_(pa.int32())
        own = pa.array([pick(v) for v in batch.column("own").to_pylist()], kind)
        sides = [
            pa.array([[pick(v) for v in found] for found in batch.column(c).to_pylist()], pa.list_(kind))
            for c in ("sentences", "twins")
        ]
        return pa.RecordBatch.from_arrays([batch.column("label"), own, *sides], ["label", "own", "sentences", "twins"])

    small = mapped(read, known, nested.format("int")).toPandas()
    small = small.sort_values("label", kind="stable", ignore_index=True)
    own = [np.asarray(v, np.int64) for v in small["own"]]
    pairs = [
        (np.asarray(a, np.int64), np.asarray(b, np.int64))
        for sentences, twins in zip(small["sentences"], small["twins"])
        for a, b in zip(sentences, twins)
    ]
    weights, constant = _logistic(own, small["label"].to_numpy(float), pairs, len(keys), penalty)
    return Model(keys, weights, constant)


def scored(docs: DataFrame, labels: DataFrame, modulus: int = 3, remainder: int = 1) -> DataFrame:
    """All rows and columns of `docs` with held_out, score and predicted.

    Null texts are scored as empty ones (the constant alone). Labels of held-out ids are never read;
    null labels count as none, of several labels of an id the largest counts. Repeated rows get equal
    scores; an empty table gives no rows.
    """
    ready(docs.sparkSession)
    out = held_out("doc_id", modulus, remainder)
    model = fit(docs, labels, ~out)
    return docs.withColumn("held_out", out).withColumn("score", model.score(text_or_empty("text"))).withColumn(
        "predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0)
    )


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns."""
    ready(docs.sparkSession)
    model = fit(docs, labels, ~held_out("doc_id", 3, 1))
    return docs.where(model.score(text_or_empty("text")) < THRESHOLD)
