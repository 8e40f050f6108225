"""Building blocks that stay exact and bounded per task when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from opsloom.functions.barrier import computed_once
from opsloom.functions.rounding import round_binary
from opsloom.session import staged

# A key with more rows than this is spread over many tasks. At most total/HOT_ROWS keys can be hot,
# which bounds what is broadcast: 10^12 rows give at most 500,000 keys.
HOT_ROWS = 2_000_000
SPREAD = 4096


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a plan, without running it."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(df: DataFrame) -> int:
    spark = df.sparkSession
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if text.startswith("-"):
        return -1
    return int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text))


# A row with a short key takes about this much of a broadcast hash table.
HASHED_ROW_BYTES = 100


def rows_fit(side: DataFrame, rows: int) -> bool:
    """Whether a hash table of that many rows stays below the session's broadcast limit."""
    return rows * HASHED_ROW_BYTES <= broadcast_limit(side)


def fits_broadcast(side: DataFrame) -> bool:
    """Whether a table on one side of a join is small enough to go through the driver.

    Catalyst's estimate rests on compressed files: a packed column of keys grows some fifty times in
    a hash table. A side it takes for small is therefore counted as well.
    """
    return estimated_bytes(side) <= broadcast_limit(side) and rows_fit(side, side.count())


def by_rows(side: DataFrame) -> DataFrame:
    """A stored side of a join that is broadcast only if its rows fit, whatever its files compress to.

    One that Catalyst takes for large is left to it: the join then shuffles and goes on by measured sizes.
    """
    if estimated_bytes(side) > broadcast_limit(side):
        return side
    return F.broadcast(side) if rows_fit(side, side.count()) else side.hint("merge")


def chunk(at: Column, width: int) -> Column:
    """Floor division of an integer column, exact for negative values too."""
    return F.call_function("div", at - F.pmod(at, F.lit(width)), F.lit(width))


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool) -> DataFrame:
    """Inner equi-join; with `null_safe` a NULL key matches a NULL key, at the cost of a shuffle."""
    if not null_safe:
        return left.join(right, list(keys))
    other = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    matches = all_of([F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(other, matches).drop(*[f"_r_{k}" for k in keys])


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def join_back(
    rows: DataFrame,
    per_key: DataFrame,
    keys: Sequence[str],
    count_col: str,
    spread_by: Sequence[str],
    unmatched: Column | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left-join a table with one row per key, which knows how many `rows` each key has.

    Keys above `hot_rows` are few by arithmetic and are attached map-side. Their rows, rows without
    a key and rows the caller knows to be `unmatched` then go through the shuffle join under a salt
    that matches nothing, so no task gets more than `hot_rows` rows of one key. `spread_by` are
    columns that tell rows apart.
    """
    extra = [c for c in per_key.columns if c not in keys]
    # Always 0 and never NULL, but not a literal: a literal would be folded out of the join keys and
    # with it the salt out of the shuffle. Both sides below read this one shuffle; the count is fixed
    # above it, or the two filters would move below and make it two.
    zero = F.coalesce(F.pmod(F.col(count_col), F.lit(1)).cast("long"), F.lit(0).cast("long"))
    salted_keys = per_key.withColumn("_salt", zero)
    shared = computed_once(salted_keys.repartition(*keys, "_salt"), [count_col])

    def side(kept: Column, prefix: str, *salt: str) -> DataFrame:
        return shared.where(kept).select(*keys, *salt, *[F.col(c).alias(prefix + c) for c in extra])

    hot = side(F.col(count_col) > hot_rows, "_hot_")
    cold = side(F.col(count_col) <= hot_rows, "_cold_", "_salt")
    apart = F.col(f"_hot_{count_col}").isNotNull() | any_of([F.col(k).isNull() for k in keys])
    if unmatched is not None:
        apart = apart | unmatched
    salt = F.when(apart, F.lit(1) + F.pmod(F.xxhash64(*spread_by), F.lit(SPREAD)))
    salted = rows.join(F.broadcast(hot), list(keys), "left").withColumn(
        "_salt", salt.otherwise(F.lit(0).cast("long"))
    )
    return salted.join(cold, [*keys, "_salt"], "left").select(
        *rows.columns, *[F.coalesce(F.col("_hot_" + c), F.col("_cold_" + c)).alias(c) for c in extra]
    )


def lookup(
    rows: DataFrame,
    side: DataFrame,
    key: str,
    spread_by: Sequence[str],
    counted_on: DataFrame | None = None,
) -> DataFrame:
    """Left-join a dimension that is unique on `key`.

    A side below the session's broadcast limit, by Catalyst's size and by its rows, is left to
    Catalyst, which broadcasts it. A larger one meets the fact's distinct keys first (counted map-side, so a hot key
    is one row), and the matched keys go back to the rows with hot keys split off. `counted_on` is
    an earlier form of `rows` with the same keys, which spares running the steps between again.
    """
    if fits_broadcast(side):
        return rows.join(side, key, "left").select(*rows.columns, *[c for c in side.columns if c != key])
    source = rows if counted_on is None else counted_on
    counts = source.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    # Keys the dimension lacks stay in, so that a hot unknown key is split as well.
    return join_back(rows, counts.join(side.hint("merge"), key, "left"), [key], "_n", spread_by).drop("_n")


def lookup_uncounted(rows: DataFrame, side: DataFrame, key: str, salts: int = 16) -> DataFrame:
    """Left-join a dimension that is unique on `key` where the rows cannot be counted first, as on a stream.

    A side below the session's broadcast limit, by Catalyst's size and by its rows, is left to
    Catalyst. A larger one goes through no driver: it is repeated under every salt and each row meets it under one, taken from the row's own columns,
    so the rows of a hot key, or those without one, spread over that many tasks.
    """
    extra = [c for c in side.columns if c != key]
    if not fits_broadcast(side):
        side = side.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
        side = side.hint("merge")
        rows = rows.withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(salts)))
    on = [key, *[c for c in ("_salt",) if c in side.columns]]
    return rows.join(side, on, "left").select(*[c for c in rows.columns if c != "_salt"], *extra)


def running(
    steps: DataFrame,
    keys: Sequence[str],
    at: str,
    folds: Mapping[str, tuple[str, Column]],
    coarse: int,
    fine: int,
    inclusive: bool = True,
    tie_break: Sequence[str] = (),
    totals: bool = False,
    null_safe: bool = False,
) -> DataFrame:
    """Running sums or maxima per key along the integer column `at`, in bounded groups.

    A plain window over (keys) sorts all rows of a key in one task. Here `at` is cut into chunks of
    `fine`, grouped into chunks of `coarse`: one window runs inside a fine chunk, one over the fine
    chunks of a coarse chunk, one over the coarse chunks of a key. When `steps` has one row per
    (keys, at) the group sizes are at most `fine`, `coarse/fine` and range/`coarse`, however the data
    is skewed. `folds` maps an output name to ("sum" | "max", column).
    """
    keys = list(keys)
    start = W.unboundedPreceding

    def fold(name: str, column: Column) -> Column:
        return F.sum(column) if folds[name][0] == "sum" else F.max(column)

    def merge(name: str, *parts: Column) -> Column:
        if folds[name][0] == "max":
            return F.greatest(*parts)
        return reduce(lambda a, b: a + b, [F.coalesce(p, F.lit(0)) for p in parts])

    chunked = steps.withColumns(
        {
            # Never NULL: otherwise each consumer would filter the steps in its own way, and Spark
            # could not share their shuffle.
            "_coarse": F.coalesce(chunk(F.col(at), coarse), F.lit(0).cast("long")),
            "_fine": F.coalesce(chunk(F.col(at), fine), F.lit(0).cast("long")),
            **{f"_in_{n}": column for n, (_, column) in folds.items()},
        }
    )
    inside = (
        W.partitionBy(*keys, "_coarse", "_fine")
        .orderBy(at, *tie_break)
        .rowsBetween(start, 0 if inclusive else -1)
    )
    before_fine = W.partitionBy(*keys, "_coarse").orderBy("_fine").rowsBetween(start, -1)
    before_coarse = W.partitionBy(*keys).orderBy("_coarse").rowsBetween(start, -1)

    fine_totals = chunked.groupBy(*keys, "_coarse", "_fine").agg(
        *[fold(n, F.col(f"_in_{n}")).alias(f"_f_{n}") for n in folds]
    )
    coarse_totals = fine_totals.groupBy(*keys, "_coarse").agg(
        *[fold(n, F.col(f"_f_{n}")).alias(f"_c_{n}") for n in folds]
    )
    fine_offsets = fine_totals.select(
        *keys, "_coarse", "_fine", *[fold(n, F.col(f"_f_{n}")).over(before_fine).alias(f"_pf_{n}") for n in folds]
    )
    whole = {n: fold(n, F.col(f"_c_{n}")).over(W.partitionBy(*keys)) for n in folds if totals}
    coarse_offsets = coarse_totals.select(
        *keys,
        "_coarse",
        *[fold(n, F.col(f"_c_{n}")).over(before_coarse).alias(f"_pc_{n}") for n in folds],
        *[c.alias(f"{n}_total") for n, c in whole.items()],
    )
    offsets = join_on(fine_offsets, coarse_offsets, [*keys, "_coarse"], null_safe)
    within = chunked.select(
        *steps.columns,
        "_coarse",
        "_fine",
        *[fold(n, F.col(f"_in_{n}")).over(inside).alias(f"_w_{n}") for n in folds],
    )
    return join_on(within, offsets, [*keys, "_coarse", "_fine"], null_safe).select(
        *steps.columns,
        *[merge(n, F.col(f"_w_{n}"), F.col(f"_pf_{n}"), F.col(f"_pc_{n}")).alias(n) for n in folds],
        *[f"{n}_total" for n in whole],
    )


def positions(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """The rows with their 0-based place in the global order, without one task seeing them all."""
    return numbered(df.orderBy(*order), name)


def numbered(ordered: DataFrame, name: str = "position") -> DataFrame:
    """The rows of a sorted table with their 0-based place in the order it comes in.

    The range-partitioned sort is staged with each row's partition and place in it; the partition
    sizes, one row per partition, then give the offsets.
    """
    placed = ordered.withColumns({"_part": F.spark_partition_id(), "_row": F.monotonically_increasing_id()})
    table = staged(placed, "sorted")
    sizes = table.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.col("_start") + F.col("_row") - F.col("_first")
    return table.join(F.broadcast(starts), "_part").select(*ordered.columns, place.alias(name))


def exact_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    levels: Mapping[str, float],
    coarse: int = 1_000_000,
    fine: int = 1_000,
    rows: Column | None = None,
) -> DataFrame:
    """Exact interpolated percentiles of an integer column per group, to two decimals.

    For levels in whole percent the interpolated value of integers has no further decimals. `rows`
    says how many equal values a row of `df` stands for, one unless given.
    Values are counted per (group, value) before any shuffle and the ranks come from `running`, so
    neither the rows nor the distinct values of a large group have to fit in one task.
    """
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).cast("long").alias("_value"))
        .agg((F.count(F.lit(1)) if rows is None else F.sum(rows)).alias("_n"))
    )
    folds = {"_cum": ("sum", F.col("_n"))}
    placed = running(
        counts, keys, "_value", folds, coarse, fine, totals=True, null_safe=True
    ).withColumnRenamed("_cum_total", "_size")
    lows, highs = {}, {}
    for name, p in levels.items():
        position = F.lit(p) * (F.col("_size") - 1)
        lows[name] = F.min(F.when(F.col("_cum") > F.floor(position), F.col("_value"))).alias(f"_lo_{name}")
        highs[name] = F.min(F.when(F.col("_cum") > F.ceil(position), F.col("_value"))).alias(f"_hi_{name}")
    edges = placed.groupBy(*keys).agg(
        F.max("_size").alias("_size"), *lows.values(), *highs.values()
    )

    def blended(name: str, p: float) -> Column:
        position = F.lit(p) * (F.col("_size") - 1)
        low = F.col(f"_lo_{name}").cast("double")
        high = F.col(f"_hi_{name}").cast("double")
        return round_binary(low + (high - low) * (position - F.floor(position)), 2).alias(name)

    return edges.select(*keys, *[blended(n, p) for n, p in levels.items()])
