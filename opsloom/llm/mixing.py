"""Mixing sources to target weights: how often each document is taken, by pivotal dependent rounding."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsloom.llm.common import mapped, ready, slices, staged, text_or_empty
from opsloom.llm.tokens import Words, utf8
from opsloom.operators.scale import by_rows, positions

WEIGHTS = (1, 2, 3)
MOST = 3  # a source is taken this many times at most, and so is a document
GROUP = 4096  # documents of one task's chain
FAN_IN = 64  # residuals of one node of the tree
SURE = 1e-9

ROW = "row long, key long, size long, source_row long, band int, sub long, prob double"


def _count_words(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts = utf8(batch.column("text"))
    counts = [Words(texts[i:j]).counts for i, j in slices(texts)]
    names = [n for n in batch.schema.names if n != "text"]
    return pa.RecordBatch.from_arrays(
        [*[batch.column(n) for n in names], pa.array(np.concatenate(counts))], [*names, "size"]
    )


def targets(sizes: DataFrame) -> DataFrame:
    """Per source (columns source, source_size; null allowed): also source_row, its rank, and target.

    Sources by code point, null last, weigh 1, 2, 3, 1, ... and share the sum of all sizes. No target
    exceeds three times its source's size; what is above goes to the others by weight. Uncapped
    targets are one level times the weight, so the loop only has to find which sources are capped;
    each turn is one aggregate over the sources.
    """
    ranked = staged(
        positions(sizes, [F.col("source").isNull(), F.col("source").cast("binary")], "source_row").withColumn(
            "weight", F.element_at(F.lit(list(WEIGHTS)), (F.pmod("source_row", F.lit(len(WEIGHTS))) + 1).cast("int"))
        ),
        "sources",
    )
    cap = MOST * F.col("source_size")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        above = F.lit(capped >= 0) & (F.col("weight") * F.lit(level) > cap)
        n, full, free = ranked.agg(
            F.count(F.when(above, 1)), F.sum(F.when(above, cap)), F.sum(F.when(~above, F.col("weight")))
        ).first()
        if n == capped or not free:
            break
        level, capped = (total - (full or 0)) / free, n
    share = F.col("weight") * F.lit(float(level))
    return ranked.select(
        "source", "source_size", "source_row", F.least(share, cap.cast("double")).alias("target")
    )


def chain(probs: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Pivotal rounding along a sequence: all but one value become 0 or 1, the sum stays.

    Two fractions meet; a random amount of mass moves from one to the other until one is integral, with
    the odds that keep both expectations. The other goes on to the next.
    """
    out = probs.astype(float).copy()
    draws = rng.random(len(out))
    held = -1
    for i, b in enumerate(out.tolist()):
        if b < SURE or b > 1 - SURE:
            out[i] = round(b)
            continue
        if held < 0:
            held = i
            continue
        a = out[held]
        both = a + b
        if both < 1:
            stays, goes = (held, i) if draws[i] * both < a else (i, held)
            out[stays], out[goes] = both, 0.0
        else:
            full, rest = (held, i) if draws[i] * (2 - both) < 1 - b else (i, held)
            out[full], out[rest] = 1.0, both - 1
            stays = rest
        if out[stays] < SURE or out[stays] > 1 - SURE:
            out[stays] = round(out[stays])
            held = -1
        else:
            held = stays
    return out


def _chained(seed: int, level: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "key", "row"], ignore_index=True)
        rng = np.random.default_rng([seed, level, *(int(k) & (1 << 63) - 1 for k in key)])
        return rows.assign(prob=chain(rows["prob"].to_numpy(), rng))

    return run


def _open() -> Column:
    return (F.col("prob") > 0) & (F.col("prob") < 1)


def copy_numbers(rows: DataFrame) -> DataFrame:
    """`rows` with `copy`: the place of a row among those of its key, for keys with over GROUP rows; else 0.

    Rows are numbered inside the part of the input that their row number names, parts by running
    totals, so a task never gets more than such a part, however often a row is repeated.
    """
    many = rows.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > GROUP).select("key")
    many = staged(many, "repeated-keys")
    first = F.lit(0).cast("long")
    if many.isEmpty():
        return rows.withColumn("copy", first)
    part = F.shiftright("row", 33).alias("_part")
    repeated = staged(rows.join(many, "key", "left_semi").select("key", "row", part), "repeated-rows")
    sizes = repeated.groupBy("key", "_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("key", "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("key", "_part").orderBy("row")
    numbered = (
        repeated.withColumn("_place", F.row_number().over(inside) - 1)
        .join(starts, ["key", "_part"])
        .select("row", (F.col("_start") + F.col("_place")).alias("copy"))
    )
    return rows.join(numbered, "row", "left").withColumn("copy", F.coalesce("copy", first))


def rounded(rows: DataFrame, seed: int) -> DataFrame:
    """`rows` (columns ROW) with every prob rounded to 0 or 1, the sum per source kept within one.

    Documents of a source are chained in groups of like size, a few thousand each, so the words that
    the transfers move between documents nearly cancel. Equal rows are dealt out over the groups by
    their number; as any of them may stand for another, the result does not depend on the numbering.
    Each group leaves one fraction at most. These
    go up a tree with FAN_IN per node: first over the parts of a size band, then over bands, until
    one fraction per source is left, which is drawn.
    """
    counts = rows.groupBy("source_row", "band").agg(F.count(F.lit(1)).alias("_n"))
    parts = F.greatest(F.lit(1), F.ceil(F.col("_n") / GROUP)).cast("long")
    turn = F.floor(F.col("copy") / GROUP)
    split = (
        copy_numbers(rows.drop("sub"))
        .join(counts, ["source_row", "band"])
        .withColumn("sub", F.pmod(F.pmod("key", parts) + turn, parts))
        .select(*[c.split()[0] for c in ROW.split(", ")])
    )
    keys = ["source_row", "band", "sub"]
    # Dealt out by the parts as well: the join's deal by source and band would satisfy the grouping.
    dealt = split.repartition(*keys)
    out = staged(dealt.groupBy(*keys).applyInPandas(_chained(seed, 0), ROW), "chained")
    done = out.where(~_open())
    left = out.where(_open())
    most, span = left.agg(F.max("sub"), F.max("band")).first()
    level = 0
    while most is not None and (most or span):
        level += 1
        if most:
            left = left.withColumn("sub", F.floor(F.col("sub") / FAN_IN))
            most //= FAN_IN
        else:
            left = left.withColumn("band", F.floor(F.col("band") / FAN_IN).cast("int"))
            span //= FAN_IN
        step = staged(left.groupBy(*keys).applyInPandas(_chained(seed, level), ROW), "chained")
        done, left = done.unionByName(step.where(~_open())), step.where(_open())
    draw = F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    last = left.withColumn("prob", F.when(draw < F.col("prob"), 1.0).otherwise(0.0))
    return staged(done.unionByName(last), "rounded")


def _closer(taken: DataFrame) -> DataFrame:
    """Per source, add or drop the one extra copy that brings its words closest to the target."""
    totals = taken.groupBy("source_row").agg(
        F.first("target").alias("target"), F.sum((F.col("base") + F.col("prob")) * F.col("size")).alias("words")
    )
    sums = totals.select("source_row", (F.col("target") - F.col("words")).alias("miss"))
    # One candidate per source, size and state is enough, so a hot source is combined before the join.
    candidates = (
        taken.where("may_round")
        .groupBy("source_row", "size", "prob")
        .agg(F.min(F.struct("key", "row")).alias("least"))
        .withColumn("delta", F.when(F.col("prob") > 0, -F.col("size")).otherwise(F.col("size")))
    )
    after = F.abs(F.col("miss") - F.col("delta"))
    best = (
        candidates.join(sums, "source_row")
        .where(after < F.abs("miss"))
        .groupBy("source_row")
        .agg(F.min(F.struct(after, "least.key", "least.row")).alias("best"))
        .select(F.col("best.row").alias("row"), F.lit(True).alias("_flip"))
    )
    flipped = F.when(F.col("_flip"), 1 - F.col("prob")).otherwise(F.col("prob"))
    return taken.join(best, "row", "left").withColumn("prob", flipped).drop("_flip")


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 20
) -> DataFrame:
    """Per row of `docs`: id, size, source_size, target, taken, copies and key (a hash of the row).

    Every document's expected copies are its source's target over its source's size. The whole part
    is taken, the fraction is rounded by `rounded`; then at most two documents per source change by one copy
    to come closer to the target in words. Null texts and texts without a word have size 0 and are
    not taken; a null source is a source of its own, the last; repeated rows are rounded one by one;
    an empty table gives no rows. The same rows give the same result in any order and partitioning.
    """
    ready(docs.sparkSession)
    sized = staged(
        mapped(
            docs.select(
                F.col(id_col).alias("id"),
                F.col(source_col).alias("source"),
                F.xxhash64(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0")) for c in docs.columns]).alias("key"),
                text_or_empty(text_col).alias("text"),
            ),
            _count_words,
            f"id {docs.schema[id_col].dataType.simpleString()}, source string, key long, size long",
        ).withColumn("row", F.monotonically_increasing_id()),
        "sized",
    )
    sources = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"))).withColumnRenamed("source", "_s")
    joined = sized.join(by_rows(sources), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    all_rows = staged(
        joined.withColumn("share", share)
        .withColumn("base", F.floor("share"))
        .withColumn("prob", F.col("share") - F.col("base"))
        .withColumn("may_round", (F.col("size") > 0) & (F.col("prob") > SURE) & (F.col("prob") < 1 - SURE)),
        "shares",
    )
    # Bands of sizes that differ by a fifth at most.
    band = F.floor(4 * F.log2(F.col("size").cast("double"))).cast("int")
    open_rows = all_rows.where("may_round").withColumns({"band": band, "sub": F.lit(0).cast("long")})
    whole = rounded(open_rows.select(*[c.split()[0] for c in ROW.split(", ")]), seed).select("row", F.col("prob").alias("_prob"))
    sure = F.when(F.col("prob") > 0.5, 1.0).otherwise(0.0)
    taken = staged(
        all_rows.join(by_rows(whole), "row", "left").withColumn("prob", F.coalesce("_prob", sure)).drop("_prob"), "taken"
    )
    taken = staged(_closer(taken), "taken")
    taken = _closer(taken)
    copies = (F.col("base") + F.col("prob")).cast("long")
    return taken.select(
        F.col("id").alias(id_col), "size", "source_size", "target", (copies * F.col("size")).alias("taken"),
        F.when(F.col("size") > 0, copies).otherwise(F.lit(0)).cast("long").alias("copies"), "key",
    )


def mixed(docs: DataFrame, seed: int = 20) -> DataFrame:
    """The mix itself: every document as often as it is taken, with all its columns."""
    key = F.xxhash64(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0")) for c in docs.columns])
    copies = mix(docs, seed=seed).groupBy("key").agg(F.sum("copies").alias("copies")).where("copies > 0")
    once = docs.withColumn("_key", key).join(copies.withColumnsRenamed({"key": "_key", "copies": "_copies"}), "_key")
    # Equal rows are one key with the sum of their copies.
    return (
        once.dropDuplicates(["_key"])
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
        .select(*docs.columns)
    )
