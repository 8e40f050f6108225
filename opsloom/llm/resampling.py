"""Importance resampling towards a target corpus on hashed words and word pairs, batch by batch."""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsloom.llm.common import mapped, ready, slices, staged, text_or_empty
from opsloom.llm.tokens import utf8
from opsloom.operators.scale import positions

BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 25
SEED = 7
# Words of lower-cased UTF-8: digits, letters and everything beyond ASCII. In brackets, so that a
# split gives the words and what stands between them in turn.
WORDS = re.compile(rb"([0-9a-z\x80-\xff]+)")
SENTINEL, SPACE = b"\n", b" "  # no word holds them


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and text index of every feature of a batch, the words before the pairs; words per text.

    The texts become one buffer with sentinels between; one pass of the regex finds all words. Their
    places among the texts' offsets say which text they are of; a pair over two texts is masked out.
    The hash of a pair goes on from its first word's.
    """
    buffer = SENTINEL.join(texts).lower()
    offsets = np.cumsum([0, *[len(t) + len(SENTINEL) for t in texts[:-1]]])
    parts = WORDS.split(buffer)
    words = parts[1::2]
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
    starts = ends[:-1:2]  # where the gap before each word ends
    owner = np.searchsorted(offsets, starts, side="right") - 1
    single = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
    spaced = map(zlib.crc32, repeat(SPACE), single[:-1].tolist())
    pairs = np.fromiter(map(zlib.crc32, words[1:], spaced), np.uint32, max(0, len(words) - 1))
    same = owner[1:] == owner[:-1]
    counts = np.bincount(owner, minlength=len(texts)).astype(np.int64)
    return np.concatenate([single, pairs[same]]), np.concatenate([owner, owner[1:][same]]), counts


def bucket_counts(docs: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all rows. Tasks add up their batches; `buckets` numbers reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            texts = utf8(batch.column(0))
            for i, j in slices(texts):
                total += np.bincount(features(texts[i:j])[0] % buckets, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], ["bucket", "n"])

    found = docs.select(text_or_empty(text_col)).mapInArrow(run, "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for bucket, n in found.groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket the floored thousandfold log of its smoothed share in the target over that in the source."""
    buckets, all_s, all_t = len(source), int(source.sum()), int(target.sum())
    pairs = zip(source.tolist(), target.tolist())
    up, down = float(all_s + buckets), float(all_t + buckets)
    return np.array([math.floor(1000 * math.log((t + 1) * up / ((s + 1) * down))) for s, t in pairs], np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_words, n_features and weight, the floored mean gain of its features (none: 0)."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = docs.schema[id_col].dataType
    id_type = to_arrow_type(kind)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, n_words, n_features, weights = utf8(batch.column(1)), [], [], []
        for i, j in slices(texts):
            hashes, owner, words = features(texts[i:j])
            size = np.bincount(owner, minlength=j - i).astype(np.int64)
            total = np.zeros(j - i, np.int64)
            np.add.at(total, owner, gain[hashes % len(gain)])
            n_words.append(words)
            n_features.append(size)
            weights.append(np.where(size > 0, total // np.maximum(size, 1), 0))
        return pa.RecordBatch.from_arrays(
            [batch.column(0).cast(id_type), *[pa.array(np.concatenate(x)) for x in (n_words, n_features, weights)]],
            [id_col, "n_words", "n_features", "weight"],
        )

    schema = f"`{id_col}` {kind.simpleString()}, n_words long, n_features long, weight long"
    return mapped(docs.select(F.col(id_col), text_or_empty(text_col).alias("_t")), run, schema)


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text: str = "text",
    buckets: int = BUCKETS,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """Per row of `docs`: id, n_features, weight, score and rank (1, 2, … for those drawn, else null).

    The score is the weight plus Gumbel noise from the id's hash, so the highest scores are a draw
    without replacement in proportion to the weights, and reruns agree. Of the N rows with
    `least_words` words, floor(percent * N / 100) are drawn; equal scores go to the smaller id (null
    last). Both corpora are counted whole; the driver sees `buckets` counts of each and one number.
    Ranks come from a distributed sort; equal rows spread over its tasks. Null texts have no words,
    rows with one id share their noise, an empty table gives no rows, other columns are ignored.
    """
    ready(docs.sparkSession)
    gain = gains(bucket_counts(docs, text_col, buckets), bucket_counts(target, target_text, buckets))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0)))
    scored = staged(
        weighted(docs, gain, id_col, text_col)
        .withColumn("score", (F.col("weight") + noise).cast("long"))
        .withColumn("_row", F.monotonically_increasing_id()),
        "scored",
    )
    eligible = F.col("n_words") >= least_words
    drawn = scored.where(eligible).count() * percent // 100
    order = [F.col("score").desc(), F.col(id_col).asc_nulls_last(), F.col("_row")]
    ranked = positions(scored.where(eligible), order, "_place")
    place = F.when(F.col("_place") < drawn, F.col("_place") + 1).cast("long").alias("rank")
    columns = [id_col, "n_features", "weight", "score"]
    others = scored.where(~eligible).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*columns, place).unionByName(others)
