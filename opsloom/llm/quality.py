"""Quality: attention-based multiple-instance learning over the passages of a text."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsloom.llm.common import held_out, mapped, ready, slices, staged, text_or_empty
from opsloom.llm.tokens import Words, utf8
from opsloom.llm.toxicity import labelled_texts

SAMPLE = 8_000  # labelled rows the model is fitted on, about
BAG = 256  # passages of one such row, evenly spaced over the text, that the fit reads; scores read all
PASSAGE = 64  # words
HIDDEN, GATE = 16, 8
THRESHOLD = 0.7


def _class(*codes: int) -> np.ndarray:
    flags = np.zeros(256, bool)
    flags[list(codes)] = True
    return flags


_BYTES = {
    "upper": _class(*range(65, 91)),
    "lower": _class(*range(97, 123)),
    "digit": _class(*range(48, 58)),
    "symbol": _class(*b"#*$%&|<>"),
    "mark": _class(*b"!?"),
    "stop": _class(*b".,;:"),
    "other": _class(*b"\"'()[]{}/\\@=+-_~^`"),
    "wide": _class(*range(128, 256)),
}
WIDTH = 19


def passages(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One row of numbers per passage of PASSAGE words, and whose passage it is (at least one each)."""
    words = Words(texts)
    n = len(words)
    place = words.place() if n else np.zeros(0, np.int64)
    new = place % PASSAGE == 0
    owner = np.concatenate([words.text[new], np.flatnonzero(words.counts == 0)]).astype(np.int64)
    if not n:
        return np.zeros((len(owner), WIDTH)), owner
    length = (words.ends - words.starts).astype(float)
    per = []
    parts = {}
    for name, flags in _BYTES.items():
        sums = np.concatenate([[0], np.cumsum(flags[words.buffer], dtype=np.int32)])
        parts[name] = (sums[words.ends] - sums[words.starts]).astype(float)
        per.append(parts[name] / length)
    last = words.buffer[words.ends - 1]
    lines = np.concatenate([[0], np.cumsum(words.buffer == 10, dtype=np.int32)])
    hashes = words.hashes(31)
    per += [
        (parts["symbol"] > 0).astype(float),
        (parts["mark"] > 1).astype(float),
        ((parts["upper"] > 1) & (parts["lower"] == 0)).astype(float),
        (parts["upper"] + parts["lower"] + parts["wide"] == 0).astype(float),
        _BYTES["stop"][last].astype(float),
        np.minimum(length, 40) / 10,
        np.append(0, lines[words.starts[1:]] - lines[words.starts[:-1]] > 0).astype(float),
    ]
    # Words seen before in the text, and sequences of five seen before.
    per.append(_seen(hashes, words.text))
    first, five = words.windows(hashes, 5, 32)
    again = np.zeros(n)
    again[first] = _seen(five, words.text[first])
    per.append(again)
    begin = np.flatnonzero(new)
    size = np.diff(np.append(begin, n)).astype(float)
    table = np.add.reduceat(np.stack(per, axis=1), begin, axis=0) / size[:, None]
    whole = words.counts[words.text[begin]].astype(float)
    table = np.column_stack([table, np.log1p(size), np.log1p(whole) / 3])
    empty = np.zeros((len(owner) - len(table), table.shape[1]))
    owner_order = np.argsort(owner, kind="stable")
    return np.concatenate([table, empty])[owner_order], owner[owner_order]


def _seen(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    order = np.lexsort([hashes, owner])
    same = (np.diff(hashes[order]) == 0) & (np.diff(owner[order]) == 0)
    out = np.zeros(len(hashes))
    out[order[1:][same]] = 1.0
    return out


@dataclass
class Model:
    """An encoder, a gated attention and a logistic output; weights by name."""

    weights: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, owner: np.ndarray, n: int) -> dict[str, np.ndarray]:
        """Per passage: encoding h, gate parts and attention a; per text: representation z and score s."""
        w = self.weights
        h = np.tanh((x - w["mean"]) / w["scale"] @ w["E"] + w["e"])
        v, u = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-(h @ w["U"])))
        raw = (v * u) @ w["g"]
        top = np.full(n, -np.inf)
        np.maximum.at(top, owner, raw)
        power = np.exp(raw - top[owner])
        a = power / np.bincount(owner, power, minlength=n)[owner]
        begin = np.searchsorted(owner, np.arange(n))
        z = np.add.reduceat(a[:, None] * h, begin, axis=0)
        s = 1 / (1 + np.exp(-np.clip(z @ w["c"] + w["b"], -40, 40)))
        return {"h": h, "v": v, "u": u, "a": a, "z": z, "s": s}

    def scores(self, texts: list[bytes]) -> np.ndarray:
        out = [np.zeros(0)]
        for i, j in slices(texts):
            x, owner = passages(texts[i:j])
            out.append(self.forward(x, owner, j - i)["s"])
        return np.concatenate(out)

    def score(self, text: Column) -> Column:
        model = self

        @F.pandas_udf("double")
        def run(texts: pd.Series) -> pd.Series:
            return pd.Series(model.scores([t.encode() for t in texts]))

        return run(text)


def learn(x: np.ndarray, owner: np.ndarray, labels: np.ndarray, turns: int = 500, seed: int = 1) -> Model:
    """Fit by full-batch Adam on the labels' log loss, both labels weighing the same."""
    rng = np.random.default_rng(seed)
    d, n = x.shape[1], len(labels)
    w = {
        "mean": x.mean(axis=0), "scale": x.std(axis=0) + 1e-3,
        "E": rng.normal(0, d**-0.5, (d, HIDDEN)), "e": np.zeros(HIDDEN),
        "V": rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)), "U": rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)),
        "g": rng.normal(0, GATE**-0.5, GATE), "c": rng.normal(0, HIDDEN**-0.5, HIDDEN), "b": np.zeros(1),
    }
    model = Model(w)
    weight = np.where(labels == 1, 0.5 / max(1, labels.sum()), 0.5 / max(1, (1 - labels).sum()))
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in w.items() if k not in ("mean", "scale")}
    scaled = (x - w["mean"]) / w["scale"]
    for turn in range(1, turns + 1):
        f = model.forward(x, owner, n)
        out = (f["s"] - labels) * weight
        dz = out[:, None] * w["c"]
        da = (f["h"] * dz[owner]).sum(axis=1)
        mean = np.bincount(owner, f["a"] * da, minlength=n)
        draw = f["a"] * (da - mean[owner])
        dgate = draw[:, None] * w["g"]
        dv = dgate * f["u"] * (1 - f["v"] ** 2)
        du = dgate * f["v"] * f["u"] * (1 - f["u"])
        dh = f["a"][:, None] * dz[owner] + dv @ w["V"].T + du @ w["U"].T
        dx = dh * (1 - f["h"] ** 2)
        steps = {
            "E": scaled.T @ dx, "e": dx.sum(axis=0), "V": f["h"].T @ dv, "U": f["h"].T @ du,
            "g": (f["v"] * f["u"]).T @ draw, "c": f["z"].T @ out, "b": out.sum(keepdims=True),
        }
        for k, gradient in steps.items():
            gradient = gradient + 1e-5 * w[k]
            first = 0.9 * moments[k][0] + 0.1 * gradient
            second = 0.999 * moments[k][1] + 0.001 * gradient**2
            moments[k] = (first, second)
            w[k] = w[k] - 0.02 * first / (1 - 0.9**turn) / (np.sqrt(second / (1 - 0.999**turn)) + 1e-9)
    return model


def fit(docs: DataFrame, labels: DataFrame, training: Column, label_col: str = "quality", sample: int = SAMPLE) -> Model | None:
    """A model from labelled rows for which `training` holds; None without any such row.

    The driver gets `sample` rows of BAG passages at most, however long the texts are.
    """
    rows = labelled_texts(docs, labels, label_col, training, sample)

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, parts = utf8(batch.column("text")), []
        for i, j in slices(texts):
            x, owner = passages(texts[i:j])
            for p in np.split(x, np.searchsorted(owner, np.arange(1, j - i))):
                some = p if len(p) <= BAG else p[np.linspace(0, len(p) - 1, BAG).astype(np.int64)]
                parts.append(some.ravel().astype(np.float32))
        kind = pa.list_(pa.float32())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"), pa.array(parts, kind)], ["doc_id", "label", "x"]
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    read = staged(mapped(rows, encode, f"doc_id {kind}, label int, x array<float>"), "quality-sample").toPandas()
    if read.empty:
        return None
    read = read.sort_values("doc_id", kind="stable", ignore_index=True)
    tables = [np.asarray(v, np.float64).reshape(-1, WIDTH) for v in read["x"]]
    owner = np.repeat(np.arange(len(tables)), [len(t) for t in tables])
    return learn(np.concatenate(tables), owner, read["label"].to_numpy(float))


def scored(docs: DataFrame, labels: DataFrame, modulus: int = 4, remainder: int = 2) -> DataFrame:
    """All rows and columns of `docs` with held_out, score and predicted.

    The whole text is cut into passages; a null or empty text is one passage of zeros. Without a label
    to learn from all scores are 0. Labels of held-out ids are never read; null labels count as none,
    of several labels of an id the largest counts. Repeated rows get equal scores; an empty table
    gives no rows.
    """
    ready(docs.sparkSession)
    out = held_out("doc_id", modulus, remainder)
    model = fit(docs, labels, ~out)
    score = model.score(text_or_empty("text")) if model else F.lit(0.0)
    return docs.withColumn("held_out", out).withColumn("score", score).withColumn(
        "predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0)
    )
