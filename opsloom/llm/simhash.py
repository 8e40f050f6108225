"""SimHash fingerprints and near-duplicate groups by multi-index hashing."""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsloom.llm.common import ready, staged, text_or_empty
from opsloom.llm.components import components
from opsloom.operators.scale import by_rows, rows_fit

BITS = 64
SEGMENTS = 2
SEGMENT_BITS = BITS // SEGMENTS
DISTANCE = 2
# Fingerprints a segment value may hold and still be looked up in its table.
CROWDED = 1024


def fingerprint_of(text: bytes, shingle: int) -> int:
    words = text.lower().split()  # on bytes: A-Z only, and exactly 0x20 and 0x09-0x0D
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]]).tolist()
    stops = (ends[min(shingle, len(words)) - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[i:j], 42) for i, j in zip(starts, stops)), np.uint64, len(stops))
    votes = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 1 << 14):
        some = hashes[i : i + (1 << 14)].astype(">u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(some, axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(votes * 2 > len(hashes)).view(">u8")
    return int(bits[0])


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """64-bit SimHash over word shingles, repeats included, as a signed long."""

    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        values = [fingerprint_of(t.encode("utf-8", "surrogatepass"), shingle) for t in texts]
        return pd.Series(np.array(values, np.uint64).view(np.int64), dtype="int64")

    return run(text)


def hex_digits(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def _segments() -> Column:
    """The segments of a fingerprint, each with its number, as an array of structs."""
    whole = (1 << SEGMENT_BITS) - 1
    parts = [F.shiftrightunsigned(F.col("fp"), i * SEGMENT_BITS).bitwiseAND(F.lit(whole)) for i in range(SEGMENTS)]
    return F.array(*[F.struct(F.lit(i).alias("segment"), part.alias("value")) for i, part in enumerate(parts)])


def _table(fingerprints: DataFrame) -> DataFrame:
    """The segment tables: each fingerprint under the value of each of its segments."""
    return fingerprints.select("fp", F.inline(_segments()))


def _probes(table: DataFrame) -> DataFrame:
    """The small Hamming ball in each segment: the value itself and, with one bit set, its neighbours.

    Of two values that differ in one bit only the one without the bit probes for the other, so every
    pair of neighbouring values is met once.
    """
    value = F.col("value")
    ball = [value, *[value.bitwiseOR(F.lit(1 << bit).cast("long")) for bit in range(SEGMENT_BITS)]]
    flipped = table.select("segment", F.posexplode(F.array(*ball)).alias("flip", "probe"), "fp", "value")
    return flipped.where((F.col("flip") == 0) | (F.col("probe") != value)).select(
        "segment", F.col("probe").alias("value"), F.col("fp").alias("b"), (F.col("flip") == 0).alias("itself")
    )


def _close(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= DISTANCE


def _crowd_links(fingerprints: DataFrame) -> DataFrame:
    """Links that connect exactly the fingerprints within two bits, whatever segments they share.

    Each is entered under its own value and all values one flip away. Two within two bits meet under
    a common entry, and an entry holds 65 fingerprints at most, so none can be hot. Within an entry
    all are linked to its least member, and each link's whole distance is verified.
    """
    masks = [0, *[1 << bit for bit in range(BITS - 1)], -(1 << (BITS - 1))]
    entries = fingerprints.select(
        "fp", F.explode(F.array(*[F.col("fp").bitwiseXOR(F.lit(m).cast("long")) for m in masks])).alias("entry")
    )
    least = entries.select(F.col("fp").alias("b"), F.expr("min(fp) OVER (PARTITION BY entry)").alias("a"))
    return least.where((F.col("a") < F.col("b")) & _close("a", "b")).select("a", "b")


def links(fingerprints: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """Links (a, b), a < b, that connect exactly the fingerprints (column fp, distinct) within two bits.

    Of two halves at least one differs in one bit or none. So each fingerprint is entered in one
    table per half, looks up the Hamming ball of radius one around each of its halves, and the whole
    distance to every match is verified inside the join.

    A half that more than `crowded` fingerprints share would compare them all with each other. Such
    values leave the tables; the fingerprints in them or one flip from them are linked under their
    whole values instead, where no entry can hold more than 65.

    Catalyst takes both sides of the join for as large as the stored fingerprints, however many rows
    each becomes. So their number decides: the tables are broadcast if they fit, else both sides are shuffled.
    """
    table = _table(fingerprints)
    sizes = table.groupBy("segment", "value").agg(F.count(F.lit(1)).alias("n"))
    hot = staged(sizes.where(F.col("n") > crowded).select("segment", "value"), "simhash-crowded")
    key = ["segment", "value"]
    calm = table.join(hot, key, "left_anti").withColumnRenamed("fp", "a")
    probes = _probes(table)
    if rows_fit(calm, SEGMENTS * fingerprints.count()):
        calm = F.broadcast(calm)
    else:
        probes = probes.hint("merge")
    pairs = calm.join(probes, key).where(
        (F.col("a") != F.col("b")) & (~F.col("itself") | (F.col("a") < F.col("b"))) & _close("a", "b")
    )
    crowd = _probes(table).join(hot, key, "left_semi").select(F.col("b").alias("fp")).distinct()
    ordered = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return ordered.unionByName(_crowd_links(crowd))


def _rooted(marked: DataFrame, least: Column) -> DataFrame:
    """Per fingerprint (column fp) of `marked`: root, the fingerprint that stands for its group, and the aggregate `least`."""
    by_fp = staged(marked.groupBy("fp").agg(least.alias("least")), "fingerprints")
    roots = components(links(by_fp.select("fp")))
    return by_fp.join(by_rows(roots.withColumnRenamed("node", "fp")), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least"
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3
) -> DataFrame:
    """Per row of `docs`: id, fingerprint (hex) and component_id, the least id reachable over links.

    Null text counts as empty; empty texts have fingerprint zero and are linked like any other.
    Shorter texts than a shingle are one shingle. Repeated rows are returned as often as they occur;
    rows without an id belong to a group but never name it (a group of such rows only has none).
    An empty table gives no rows. Other columns of `docs` are ignored.

    The maximum distance is two bits: the table of `links` is built for it.
    """
    spark = ready(docs.sparkSession)
    marked = staged(
        docs.select(F.col(id_col).alias("id"), fingerprint(text_or_empty(text_col), shingle).alias("fp")), "simhash"
    )
    rooted = _rooted(marked, F.min("id"))
    # Roots without any other member need no second look.
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = staged(rooted.join(names, "root").select("fp", "component_id"), "simhash-names")
    return marked.join(by_rows(named), "fp").select(
        F.col("id").alias(id_col), hex_digits(F.col("fp")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """One row (with all its columns) of each group of near duplicates: the one of least doc_id, nulls last.

    Of several rows of a group with that id, or without any id, the first row stays. An id whose rows
    have texts of several groups may stay once in each. Null and empty texts are one group.
    """
    ready(docs.sparkSession)
    marked = staged(
        docs.select(
            F.struct(*docs.columns).alias("doc"),
            fingerprint(text_or_empty("text"), shingle).alias("fp"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "simhash-rows",
    )
    order = F.struct(F.col("doc.doc_id").isNull().alias("no_id"), F.col("doc.doc_id").alias("id"), "row")
    rooted = _rooted(marked, F.min(order))
    kept = staged(rooted.groupBy("root").agg(F.min("least").alias("least")).select("least.row"), "simhash-kept")
    return marked.join(by_rows(kept), "row", "left_semi").select("doc.*")
