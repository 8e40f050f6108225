"""Near-duplicate vectors by Euclidean p-stable hashing and exact cosine checks."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsloom.llm.common import mapped, ready, staged
from opsloom.llm.components import components

COSINE = 0.93
TABLES = 24
PROJECTIONS = 12  # of one table
WIDTH = 2.0  # of a projection's cells
BLOCK = 512  # vectors of one side of a comparison


@cache
def _projections(dimension: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng([17, dimension])
    count = TABLES * PROJECTIONS
    return rng.standard_normal((dimension, count)), rng.random(count) * WIDTH, rng.integers(1, 1 << 62, count) | 1


def _matrix(column) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    # Brought to a largest component of 1 first, so that no square overflows or vanishes.
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]


def bucket_keys(vectors: np.ndarray) -> np.ndarray:
    """Per vector and table a 32-bit hash of its cells."""
    lines, shifts, factors = _projections(vectors.shape[1])
    cells = np.floor((_unit(vectors) @ lines + shifts) / WIDTH).astype(np.int64)
    with np.errstate(over="ignore"):
        mixed = (cells * factors).reshape(len(vectors), TABLES, PROJECTIONS).sum(axis=2).view(np.uint64)
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _hashed(batch: pa.RecordBatch) -> pa.RecordBatch:
    sizes = batch.column("dimension").to_numpy()
    keys = np.zeros((batch.num_rows, TABLES), np.int32)
    for size in np.unique(sizes):
        some = np.flatnonzero(sizes == size)
        keys[some] = bucket_keys(_matrix(batch.column("vector").take(pa.array(some))))
    offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * TABLES)
    lists = pa.ListArray.from_arrays(offsets, pa.array(keys.ravel()))
    return pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "keys"])


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n items the least one linked to it by the pairs."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all():
            return root


def _compared(least: float):
    """Links within buckets. Input: rows of a partition sorted by bucket and side; sides 0 and 1 of a
    bucket's block pair are compared with each other, a side 2 with itself."""

    def bucket(rows: pa.Table) -> pa.RecordBatch:
        ids = rows["id"].to_numpy()
        weight = rows["copies"].to_numpy()
        table = int(rows["tab"][0].as_py())
        side = rows["side"].to_numpy()
        keys = np.array(rows["keys"].combine_chunks().flatten()).reshape(len(ids), TABLES)[:, : table + 1]
        units = _unit(_matrix(rows["vector"].combine_chunks()))
        left, right = (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
        if not len(left) and not len(right):
            left = right = np.arange(len(ids))
        a, b = np.nonzero(units[left] @ units[right].T >= least)
        a, b = left[a], right[b]
        if left is right:
            a, b = a[a < b], b[a < b]
        # A pair that meets in several tables counts in the first.
        equal = keys[a] == keys[b]
        first = equal[:, table] & (equal.argmax(axis=1) == table)
        a, b = a[first], b[first]
        links = np.bincount(a, weight[b], len(ids)) + np.bincount(b, weight[a], len(ids))
        # Least ids as roots: number the rows in order of their ids.
        order = np.argsort(ids, kind="stable")
        rank = np.empty_like(order)
        rank[order] = np.arange(len(ids))
        root = ids[order[_roots(len(ids), rank[a], rank[b])[rank]]]
        on = links > 0
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[on]), pa.array(links[on].astype(np.int64)), pa.array(root[on])], ["id", "links", "root"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = pa.concat_tables([rest, rows]) if rest is not None else rows
            marks = np.stack([rows[c].to_numpy() for c in ("bucket", "tab", "one", "two")])
            edges = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1
            starts = np.concatenate([[0], edges])
            for i, j in zip(starts[:-1].tolist(), edges.tolist()):
                if j - i > 1:
                    yield bucket(rows.slice(i, j - i))
            rest = rows.slice(int(starts[-1])).combine_chunks()
        if rest is not None and rest.num_rows > 1:
            yield bucket(rest)

    return run


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = COSINE
) -> DataFrame:
    """Per row of `vectors`: id, n_links, component_id, kept.

    1. Equal vectors of a label are one class with a count: copies are never paired.
    2. Each class's unit vector is hashed into TABLES tables, by PROJECTIONS quantised Gaussian
       projections each. Only buckets with two classes or more go on.
    3. A bucket is cut into blocks of BLOCK classes by hash, and pairs of blocks are compared in
       double precision, each in its own group of at most two blocks: no task sees a whole hot bucket,
       and no pairs leave a task, only sums of links and roots.
    A pair found in several tables counts in the first where it meets. Two vectors with the least
    cosine meet in some table with probability 0.97, closer ones with more.

    Rows with a null label, or whose vector is null, zero or has a null or non-finite component, link
    with nothing. Vectors of different dimensions are not compared. Repeated ids count as other vectors;
    a row without an id links like any, but its component has the least id there is. An empty table
    gives no rows; other columns are ignored.
    """
    spark = ready(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"), F.col(label_col).alias("label"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = F.forall("vector", lambda x: x == 0)
    fit = F.col("label").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0)
    usable = F.coalesce(fit & ~bad & ~zero, F.lit(False))
    # Equal vectors: the same components. The class's number stands for it, its least id names it.
    plain = F.transform("vector", lambda x: x.cast("double") + F.lit(0.0))
    marked = rows.withColumn("usable", usable).withColumn("vector", F.when(F.col("usable"), plain))
    classes = staged(
        marked.where("usable")
        .groupBy("label", "vector")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("least"))
        .select(F.monotonically_increasing_id().alias("id"), "label", "vector", "copies", "least"),
        "vector-classes",
    )
    hashed = staged(
        mapped(
            classes.select("id", "copies", F.xxhash64("label", F.size("vector")).alias("place"), "vector",
                           F.size("vector").alias("dimension")),
            _hashed,
            "id long, copies long, place long, vector array<double>, dimension int, keys array<int>",
        ),
        "vector-keys",
    )
    each = hashed.select("*", F.posexplode("keys").alias("tab", "key")).withColumn("bucket", F.xxhash64("place", "key"))
    counts = (
        hashed.select("place", F.posexplode("keys").alias("tab", "key"))
        .groupBy("tab", F.xxhash64("place", "key").alias("bucket"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
    )
    blocks = F.ceil(F.col("_n") / BLOCK).cast("int")
    placed = each.join(counts, ["tab", "bucket"]).withColumn("_blocks", blocks).withColumn(
        "_own", F.pmod(F.hash("id"), F.col("_blocks"))
    )
    # Block pairs (i, j) with i <= j; a block meets itself as side 2.
    pairs = placed.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).select(
        "bucket", "tab", F.least("_own", "_other").alias("one"), F.greatest("_own", "_other").alias("two"),
        F.when(F.col("_own") == F.col("_other"), 2).when(F.col("_own") < F.col("_other"), 0).otherwise(1).alias("side"),
        "id", "copies", "keys", "vector",
    )
    # A block that meets itself needs no second copy of its rows.
    group = ["bucket", "tab", "one", "two"]
    dealt = pairs.repartition(*group).sortWithinPartitions(*group)
    found = staged(dealt.mapInArrow(_compared(cosine), "id long, links long, root long"), "vector-links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("root").alias("a"), F.col("id").alias("b")))
    rooted = classes.join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    names = rooted.groupBy("root").agg(F.min("least").alias("component"))
    named = rooted.join(names, "root").join(links, "id", "left").select(
        "label", "vector", "component", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    # Rows that link with nothing have no vector here and match no class.
    out = marked.join(named, ["label", "vector"], "left").select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "id").alias("component_id"),
    )
    return out.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False)))
