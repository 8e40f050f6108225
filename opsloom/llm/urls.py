"""URL rules by host and path prefix: a sort-merge range join, swept in key order with a stack of open rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from opsloom.llm.common import ready, release, staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
OUTPUTS = ("host", "path", "rule", "verdict")
NO_RULE = "allow"  # a URL that no rule fits is not blocked
START, POINT, END = 0, 1, 2  # order at one key: a rule holds at its own key


def address(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a URL; both empty without a `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    cut = F.substring_index(F.substring_index(rest, "?", 1), "#", 1)
    host = F.substring_index(cut, "/", 1)
    return F.translate(host, UPPER, LOWER), F.substr(cut, F.length(host) + 1)


def reversed_host(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, "\\.")), ".")


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rules given as (verdict, host, path) as a table."""
    rows = ", ".join("(" + ", ".join("'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'" for x in r) + ")" for r in rules)
    empty = "SELECT '' AS verdict, '' AS host, '' AS path WHERE false"
    return spark.sql(f"SELECT * FROM VALUES {rows} AS rules(verdict, host, path)" if rules else empty)


def _canonical(rules: DataFrame) -> DataFrame:
    """One row per host and path; of two verdicts `block` wins."""
    host = F.translate(F.col("host"), UPPER, LOWER).alias("host")
    known = rules.where("verdict IS NOT NULL AND host IS NOT NULL AND path IS NOT NULL").select(host, "path", "verdict")
    return known.groupBy("host", "path").agg(F.max("verdict").alias("verdict")).withColumn(
        "rhost", reversed_host(F.col("host"))
    )


def _key(rhost: Column, path: Column) -> Column:
    """Hosts hold no slash, so a rule's key begins a URL's only if the whole reversed host is equal."""
    return F.concat(rhost, F.lit("/"), path).cast("binary")


def fitting(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Per row of `urls` (row, host, path) that has one: row and `best`, its longest rule.

    1. A rule covers the keys that begin with its own, an interval; intervals of two rules are nested
       or apart. A URL is one key for each of the rules' hosts that its host lies in, so a path rule
       also fits subdomains. Keys are cut to the longest rule, so long URLs and hosts cost no more.
    2. Starts, ends and URLs are sorted together over all tasks and stored. Rows of one key spread
       by their number, so a hot URL or host is no hot task.
    3. Each stored part is swept by itself. A running sum of starts less ends is the height of the
       stack, a start at height h puts its rule at place h, and a URL at height h reads what was put
       there last: the innermost rule that is open. What a part finds open comes from the parts
       before it, a row for each part and height.
    """
    known = _canonical(rules)
    labels = F.split("host", "\\.")
    most, longest = known.agg(F.max(F.size(labels)), F.max(F.length("path"))).first()
    hosts = F.slice(F.reverse(labels), F.lit(1), F.col("_n"))
    points = (
        urls.select("row", "host", F.left("path", F.lit(longest or 0)).alias("path"))
        .withColumn("_n", F.explode(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(most or 1)))))
        .select("row", "path", F.array_join(hosts, ".").alias("rhost"))
        .join(known.select("rhost").distinct(), "rhost", "left_semi")
        .select(_key(F.col("rhost"), F.col("path")).alias("key"), F.lit(POINT).alias("kind"), "row")
    )
    text = F.concat("host", "path")
    rule = F.struct(F.length(text).alias("size"), F.length("host").alias("of_host"), text.alias("rule"), "verdict")
    edges = known.select(_key(F.col("rhost"), F.col("path")).alias("key"), rule.alias("own"))
    none = F.lit(None).cast("long").alias("row")
    starts = edges.select("key", F.lit(START).alias("kind"), none, "own")
    # No UTF-8 text holds the byte 0xFF: this key follows all that begin with the rule's.
    ends = edges.select(F.concat("key", F.lit(b"\xff")).alias("key"), F.lit(END).alias("kind"), none)
    events = starts.unionByName(points, allowMissingColumns=True).unionByName(ends, allowMissingColumns=True)
    step = F.when(F.col("kind") == START, 1).when(F.col("kind") == END, -1).otherwise(0).alias("step")
    swept = staged(
        events.orderBy("key", "kind", "row").select(
            "kind", "row", "own", step, F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")
        ),
        "url-sweep",
    )
    # One row per part.
    sums = swept.groupBy("part").agg(F.sum("step").alias("steps"))
    earlier = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    bases = sums.select("part", F.coalesce(F.sum("steps").over(earlier), F.lit(0)).alias("base"))
    upto = W.partitionBy("part").orderBy("at").rowsBetween(W.unboundedPreceding, 0)
    placed = (
        swept.withColumn("height", F.sum("step").over(upto))
        .where(F.col("kind") != END)
        .join(F.broadcast(bases), "part")
        .withColumn("height", F.col("height") + F.col("base"))
        .where("height > 0")
    )
    level = W.partitionBy("part", "height").orderBy("at").rowsBetween(W.unboundedPreceding, 0)
    tops = staged(
        placed.select("part", "height", "at", "row", "kind", F.last("own", ignorenulls=True).over(level).alias("best")),
        "url-tops",
    )
    last = tops.groupBy("part", "height").agg(F.max_by("best", "at").alias("last"))
    before = W.partitionBy("height").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    carried = last.select("part", "height", F.last("last", ignorenulls=True).over(before).alias("carried"))
    found = tops.where(F.col("kind") == POINT).join(F.broadcast(carried), ["part", "height"])
    best = staged(
        found.groupBy("row").agg(F.max(F.coalesce("best", "carried")).alias("best")), "url-rules"
    )
    release(swept, tops)
    return best


def judge(pages: DataFrame, rules: DataFrame, url_col: str = "url", no_rule: str = NO_RULE) -> DataFrame:
    """All rows and columns of `pages` with host, path, rule and verdict.

    `rules` has verdict (allow or block), host and path. A rule fits its host and all subdomains of
    it where the URL's path begins with the rule's; the longest wins (host and path together, then the
    longer host, then `block`). No rule fits: rule is null, verdict is `no_rule`. Null URLs and those
    without `://` have an empty host and path. Rules with a null are none; an empty rule table fits
    nothing; repeated rows are judged one by one; an empty table gives no rows. Columns of `pages`
    named like an output are replaced. DataFrame functions only.
    """
    ready(pages.sparkSession)
    names = [c for c in pages.columns if c not in OUTPUTS]
    inner = [f"c{i}" for i in range(len(names))]
    host, path = address(F.coalesce(F.col(f"`{url_col}`"), F.lit("")))
    urls = staged(
        pages.select(*[F.col(f"`{c}`").alias(i) for c, i in zip(names, inner)], host.alias("host"), path.alias("path"))
        .withColumn("row", F.monotonically_increasing_id()),
        "urls",
    )
    best = fitting(urls.select("row", "host", "path"), rules)
    return urls.join(best, "row", "left").select(
        *[F.col(i).alias(c) for c, i in zip(names, inner)],
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(no_rule)).alias("verdict"),
    )


# The rules of the registered query.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

SQL = f"""
WITH rules(verdict, host, path) AS (VALUES {", ".join(map(str, RULES))}),
cut AS (
  SELECT row_number() OVER () AS r, page_id, regexp_extract(
    CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END, '^[^?#]*') AS rest
  FROM pages
), parts AS (
  SELECT r, page_id, regexp_extract(rest, '^[^/]*') AS raw, rest FROM cut
), urls AS (
  SELECT r, page_id, translate(raw, '{UPPER}', '{LOWER}') AS host, substr(rest, length(raw) + 1) AS path FROM parts
), best AS (
  SELECT r, arg_max(rules.host || rules.path, length(rules.host || rules.path)) AS rule,
    arg_max(verdict, length(rules.host || rules.path)) AS verdict
  FROM urls JOIN rules ON (urls.host = rules.host OR ends_with(urls.host, '.' || rules.host))
    AND starts_with(urls.path, rules.path)
  GROUP BY r
)
SELECT page_id, host, path, rule, coalesce(verdict, '{NO_RULE}') AS verdict FROM urls LEFT JOIN best USING (r)
"""
