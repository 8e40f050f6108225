"""Removal of long word sequences that occur more than once, found by difference-cover anchors."""

from __future__ import annotations

import hashlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsloom.llm.common import mapped, ready, release, slices, staged, text_or_empty
from opsloom.llm.tokens import Words, utf8
from opsloom.operators.scale import by_rows

# A perfect difference set: every residue modulo PERIOD is a difference of two marks. So for any two
# places there is a shift below PERIOD that puts both on a mark.
PERIOD = 21
MARKS = (0, 1, 6, 8, 18)
WINDOW = 35


@cache
def _marked() -> np.ndarray:
    flags = np.zeros(PERIOD, bool)
    flags[list(MARKS)] = True
    return flags


def _lists(values: np.ndarray, owner: np.ndarray, n: int, kind: pa.DataType) -> pa.ListArray:
    """One list per owner 0..n-1 of values that are sorted by owner."""
    ends = np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, kind))


def _sliced(texts: list[bytes]):
    for begin, end in slices(texts):
        yield begin, end, Words(texts[begin:end])


def _anchors(window: int):
    size = window - PERIOD + 1

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, parts, counts = utf8(batch.column("text")), [], []
        for begin, end, words in _sliced(texts):
            first, hashes = words.windows(words.digests()[0], size, 2)
            at = words.place()[first]
            # Only anchors of texts with a whole window matter.
            on = _marked()[at % PERIOD] & (words.counts[words.text[first]] >= window)
            parts.append(_lists(hashes[on].view(np.int64), words.text[first[on]], end - begin, pa.int64()))
            counts.append(words.counts)
        return pa.RecordBatch.from_arrays(
            [batch.column("k1"), batch.column("k2"), pa.array(np.concatenate(counts)), pa.concat_arrays(parts)],
            ["k1", "k2", "n_words", "hashes"],
        )

    return run


def _candidates(window: int):
    """Per text the windows around its repeated anchors, with two independent hashes."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, anchors = utf8(batch.column("text")), batch.column("anchors")
        starts, ones, twos = [], [], []
        for begin, end, words in _sliced(texts):
            some = anchors.slice(begin, end - begin)
            index = some.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            owner = np.repeat(np.arange(end - begin), np.diff(some.offsets.to_numpy()))
            at = index // len(MARKS) * PERIOD + np.array(MARKS)[index % len(MARKS)]
            # Windows that begin up to PERIOD - 1 words before an anchor hold it whole.
            reach = np.zeros(len(words) + 1, np.int64)
            place = words.first[owner] + at
            np.add.at(reach, np.maximum(place - PERIOD + 1, words.first[owner]), 1)
            np.add.at(reach, place + 1, -1)
            near = np.cumsum(reach)[:-1] > 0
            low, high = words.digests()
            first, one = words.windows(low, window, 3)
            _, two = words.windows(high, window, 5)
            on = near[first]
            first, owner = first[on], words.text[first[on]]
            starts.append(_lists((words.place()[first]).astype(np.int32), owner, end - begin, pa.int32()))
            ones.append(_lists(one[on].view(np.int64), owner, end - begin, pa.int64()))
            twos.append(_lists(two[on].view(np.int64), owner, end - begin, pa.int64()))
        return pa.RecordBatch.from_arrays(
            [batch.column("k1"), batch.column("k2"), *map(pa.concat_arrays, (starts, ones, twos))],
            ["k1", "k2", "starts", "h1", "h2"],
        )

    return run


def _text_key(text: Column) -> dict[str, Column]:
    """128 bits that stand for a whole text."""
    return {"k1": F.xxhash64(text), "k2": F.xxhash64(F.lit(7), text)}


def repeated_windows(docs: DataFrame, text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Per different text that has any: k1, k2, starts of its repeated windows, whole (a copied text).

    1. Equal texts are one row with a count. All windows of a text with copies are repeated.
    2. Anchors, the sequences of window - PERIOD + 1 words at the cover's places, are hashed and
       counted. Two equal windows always share an aligned anchor: the cover has a shift below PERIOD
       that puts both on a mark.
    3. Anchors that occur once are dropped. The others extend to the windows that hold them, and
       these windows, as 128-bit hashes, are counted over all texts. This finds exactly the repeated
       windows, without comparing pairs of occurrences: a passage in a third of all texts is one
       partial count per task.
    """
    if not PERIOD <= window:
        raise ValueError(f"window must be {PERIOD} words at least")
    text = text_or_empty(text_col)
    keyed = docs.select(text.alias("text")).withColumns(_text_key(F.col("text")))
    listed = mapped(keyed, _anchors(window), "k1 long, k2 long, n_words long, hashes array<long>")
    texts = staged(
        listed.groupBy("k1", "k2")
        .agg(F.count(F.lit(1)).alias("copies"), F.first("n_words").alias("n_words"), F.first("hashes").alias("hashes"))
        .withColumn("row", F.monotonically_increasing_id()),
        "anchors",
    )
    repeated = staged(
        texts.select(F.explode("hashes").alias("hash")).groupBy("hash").count().where("count > 1").select("hash"),
        "repeated-anchors",
    )
    marked = staged(
        texts.select("row", F.posexplode("hashes").alias("index", "hash"))
        .join(by_rows(repeated), "hash", "left_semi")
        .groupBy("row")
        .agg(F.collect_list("index").alias("anchors"))
        .join(texts.select("row", "k1", "k2"), "row")
        .select("k1", "k2", "anchors"),
        "marked-texts",
    )
    whole = staged(texts.where((F.col("copies") > 1) & (F.col("n_words") >= window)).select("k1", "k2"), "copied-texts")
    release(texts, repeated)
    once = keyed.groupBy("k1", "k2").agg(F.first("text").alias("text"))
    windows = staged(
        mapped(
            once.join(by_rows(marked), ["k1", "k2"]).select("k1", "k2", "text", "anchors"),
            _candidates(window),
            "k1 long, k2 long, starts array<int>, h1 array<long>, h2 array<long>",
        )
        .where(F.size("starts") > 0)
        .withColumn("row", F.monotonically_increasing_id()),
        "windows",
    )
    each = windows.select("row", F.inline(F.arrays_zip("starts", "h1", "h2")))
    # A window in a copied text is repeated without the count; it still counts for the others.
    again = staged(each.groupBy("h1", "h2").count().where("count > 1").select("h1", "h2"), "repeated-windows")
    found = (
        each.join(by_rows(again), ["h1", "h2"], "left_semi")
        .groupBy("row")
        .agg(F.sort_array(F.collect_list("starts")).alias("starts"))
        .join(windows.select("row", "k1", "k2"), "row")
        .select("k1", "k2", "starts")
    )
    out = staged(
        found.join(whole.withColumn("whole", F.lit(True)), ["k1", "k2"], "full").select(
            "k1", "k2", "starts", F.coalesce("whole", F.lit(False)).alias("whole")
        ),
        "covered-texts",
    )
    release(marked, whole, windows, again)
    return out


def _kept(window: int, columns: list[str]):
    """The batch with what stays of each text."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = utf8(batch.column("_text"))
        starts, whole = batch.column("_starts"), batch.column("_whole").to_pylist()
        kept, n_words, n_removed = [], [], []
        for i, text in enumerate(texts):
            words = text.split()
            n = len(words)
            if whole[i]:
                stay = []
            elif starts[i].is_valid:
                cover = np.zeros(n + 1, np.int64)
                at = starts[i].values.to_numpy()
                cover[at] += 1
                np.add.at(cover, at + window, -1)
                stay = [words[k] for k in np.flatnonzero(np.cumsum(cover)[:-1] == 0)]
            else:
                stay = words
            kept.append(b" ".join(stay))
            n_words.append(n)
            n_removed.append(n - len(stay))
        digests = [hashlib.sha256(k).hexdigest() for k in kept]
        rest = [batch.column(c) for c in columns]
        return pa.RecordBatch.from_arrays(
            [*rest, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests),
             pa.array(kept, pa.binary()).cast(pa.string())],
            [*columns, *OUTPUTS],
        )

    return run


OUTPUTS = {"_n_words": "long", "_n_removed": "long", "_kept_sha256": "string", "_kept": "string"}


def remove_repeats(docs: DataFrame, text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """All rows and columns of `docs`, with _n_words, _n_removed, _kept_sha256 and _kept (kept words).

    Every word covered by a window of `window` words whose sequence also starts anywhere else in
    `docs` (the same text included) is removed; windows are judged on the input. Null texts have no
    words, texts shorter than a window lose nothing, repeated rows count as copies, an empty table
    gives no rows. Columns of `docs` may have any name; one named like an output is replaced by it.
    """
    ready(docs.sparkSession)
    found = repeated_windows(docs, text_col, window).withColumnsRenamed(
        {"starts": "_starts", "whole": "_whole", "k1": "_k1", "k2": "_k2"}
    )
    names = [c for c in docs.columns if c not in OUTPUTS]
    inner = [f"c{i}" for i in range(len(names))]
    plain = docs.select(
        text_or_empty(text_col).alias("_text"), *[F.col(f"`{c}`").alias(i) for c, i in zip(names, inner)]
    )
    keyed = plain.withColumns({f"_{k}": c for k, c in _text_key(F.col("_text")).items()})
    joined = keyed.join(by_rows(found), ["_k1", "_k2"], "left").withColumn("_whole", F.coalesce("_whole", F.lit(False)))
    kinds = [f"{i} {docs.schema[c].dataType.simpleString()}" for c, i in zip(names, inner)]
    schema = ", ".join([*kinds, *[f"{n} {t}" for n, t in OUTPUTS.items()]])
    kept = mapped(joined.select(*inner, "_text", "_starts", "_whole"), _kept(window, inner), schema)
    return kept.withColumnsRenamed(dict(zip(inner, names)))


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents with repeats taken out of `text`; texts that lose nothing stay as they are."""
    taken = {c: f"c{i}" for i, c in enumerate(docs.columns) if c in OUTPUTS}
    changed = F.col("_n_removed") > 0
    out = remove_repeats(docs.withColumnsRenamed(taken), window=window)
    out = out.withColumn("text", F.when(changed, F.col("_kept")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(changed, size).otherwise(F.col("n_chars")))
    return out.drop(*OUTPUTS).withColumnsRenamed({i: c for c, i in taken.items()}).select(*docs.columns)
