"""Connected components of links between ids, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsloom.llm.common import release, staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the least node it sees."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    pairs = both.where("v > u").join(least, "u").select("v", F.least("u", "m").alias("m"))
    return pairs.select(F.col("m").alias("a"), F.col("v").alias("b")).where("a < b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the least of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    pairs = edges.join(least, "b").select(F.col("a").alias("v"), "m").where("m < v")
    own = least.select(F.col("b").alias("v"), "m")
    return pairs.unionByName(own).select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, root) for every node but the roots: root is the least node of its component.

    `edges` has two long columns a and b; order, repeats and loops don't matter. Each round writes
    its links to the shared folder, so a lost executor costs one round at most. Minima are combined
    before the shuffle and the joins split by size, so a node may have any number of links.
    """
    current = staged(
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "links"
    )
    mark = _mark(current)
    while True:
        after = staged(_small_star(_large_star(current)), "links")
        seen = _mark(after)
        release(current)
        current = after
        if seen == mark:
            return current.select(F.col("b").alias("node"), F.col("a").alias("root"))
        mark = seen


def _mark(edges: DataFrame) -> tuple:
    """Count and hash sums, equal for equal sets of links."""
    low, high = F.xxhash64("a", "b"), F.xxhash64("b", "a")
    row = edges.agg(
        F.count(F.lit(1)), F.sum(low.cast("decimal(38,0)")), F.sum(high.cast("decimal(38,0)"))
    ).first()
    return tuple(row)
