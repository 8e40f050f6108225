"""An index of the ids a table holds: hash buckets with Bloom words, so that a load opens only what it may meet."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsloom.session import staged

BUCKETS = 16  # of an index that begins; a lake of billions of events takes thousands
WORDS = 1 << 20  # Bloom words per bucket, of 64 bits; only those in use are stored
BITS = 4  # set per id, all in one word
COMPACT_RUNS = 16

IDS = "event_id string, word long, mask long, run string, bucket int"
WORD_ROWS = "word long, bits long, run string, bucket int"
RUNS = "run string, replaces array<string>, buckets int, seq long"


def _mask(key: Column) -> Column:
    """The bits of an id in its word, from a hash of its own."""
    h = F.xxhash64(key, F.lit(1))
    mask = F.lit(0).cast("long")
    for i in range(BITS):
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftright(h, 8 * i), F.lit(64)).cast("int")))
    return mask


class IdIndex:
    """Ids below `path`, written run by run.

    `ids` holds them by run and bucket of their hash, `words` a Bloom filter of each run's buckets, a
    row for every word in use: some two bytes an id. A probe reads the words of its own buckets, and
    ids only of the buckets in which a word says an id may be there. One id sets bits in one word
    only, so a run's words are tested as they are; a filter never misses an id it holds.

    A run is noted in `begun` and counts once its record is in `runs`. Ids of a run that ended between
    the two are no proof; `pending` gives them, for the loader to look up in the table itself.
    `compact` writes one run in place of many and then records what it replaces, so a reader sees
    either the old runs or the new one. One writer at a time; an object serves one load and reads the
    records once.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path = spark, path
        self.records = self._read("runs", RUNS).orderBy("seq").collect()  # few rows: `compact` keeps them so
        self.buckets = self.records[0]["buckets"] if self.records else buckets

    def _read(self, name: str, schema: str) -> DataFrame:
        from opsloom.sources.lake import stored_or_none

        found = stored_or_none(lambda: self.spark.read.schema(schema).parquet(f"{self.path}/{name}"))
        return self.spark.createDataFrame([], schema) if found is None else found

    def runs(self) -> list[str]:
        """The runs that count."""
        gone = {old for r in self.records for old in r["replaces"]}
        return [r["run"] for r in self.records if r["run"] not in gone]

    def _ids(self) -> DataFrame:
        return self._read("ids", IDS)

    def _placed(self, ids: DataFrame) -> DataFrame:
        h = F.xxhash64("event_id")
        return ids.select(
            "event_id",
            F.pmod(F.shiftright(h, 20), F.lit(WORDS)).alias("word"),
            _mask(F.col("event_id")).alias("mask"),
            F.pmod(h, F.lit(self.buckets)).cast("int").alias("bucket"),
        )

    def suspects(self, ids: DataFrame) -> DataFrame:
        """Of distinct ids those that a filter says may be held: event_id and bucket."""
        placed = staged(self._placed(ids), "probes")
        touched = [r[0] for r in placed.select("bucket").distinct().collect()]  # at most `buckets` numbers
        words = self._read("words", WORD_ROWS).where(F.col("run").isin(self.runs()) & F.col("bucket").isin(touched))
        hit = F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask")
        return placed.join(words, ["bucket", "word"]).where(hit).select("event_id", "bucket").distinct()

    def known(self, ids: DataFrame) -> DataFrame:
        """Of distinct ids those the index holds. Opens the id files of suspected buckets only."""
        if not self.runs():
            return self.spark.createDataFrame([], "event_id string")
        suspects = staged(self.suspects(ids), "suspects")
        opened = [r[0] for r in suspects.select("bucket").distinct().collect()]
        return suspects.join(self.held_in(opened), ["bucket", "event_id"], "left_semi").select("event_id")

    def held_in(self, buckets: list[int]) -> DataFrame:
        """The ids of some buckets; other buckets' files are not opened."""
        held = self._ids().where(F.col("run").isin(self.runs()) & F.col("bucket").isin(buckets))
        return held.select("bucket", "event_id")

    def pending(self) -> list[str]:
        """Runs that were begun and neither recorded nor replaced: loads that ended in between."""
        settled = {r for row in self.records for r in (row["run"], *row["replaces"])}
        return sorted(r[0] for r in self._read("begun", "run string").collect() if r[0] not in settled)

    def ids_of(self, runs: list[str]) -> DataFrame:
        return self._ids().where(F.col("run").isin(runs)).select("event_id").distinct()

    def begin(self, ids: DataFrame) -> str:
        """Write distinct ids as a run that does not count yet."""
        run = uuid.uuid4().hex
        self._note("begun", F.lit(run).alias("run"))
        self._write(self._placed(ids), "ids", run)
        written = self._ids().where(F.col("run") == run)
        words = written.groupBy("bucket", "word").agg(F.bit_or("mask").alias("bits"))
        self._write(words.select("word", "bits", "bucket"), "words", run)
        return run

    def _write(self, df: DataFrame, name: str, run: str) -> None:
        rows = df.withColumn("run", F.lit(run)).hint("rebalance", "bucket")
        rows.write.mode("append").partitionBy("run", "bucket").parquet(f"{self.path}/{name}")

    def record(self, run: str, replaces: list[str] | None = None) -> None:
        old = replaces or []
        names = F.array(*map(F.lit, old)).cast("array<string>").alias("replaces")
        seq = len(self.records)
        self._note(
            "runs", F.lit(run).alias("run"), names, F.lit(self.buckets).alias("buckets"), F.lit(seq).cast("long").alias("seq")
        )
        self.records.append({"run": run, "replaces": old, "buckets": self.buckets, "seq": seq})

    def _note(self, name: str, *columns: Column) -> None:
        self.spark.range(0, 1, 1, 1).select(*columns).write.mode("append").parquet(f"{self.path}/{name}")

    def compact(self, most: int = COMPACT_RUNS) -> None:
        """One run in place of all, once there are more than `most`."""
        if len(self.runs()) > most:
            self.record(self.begin(self.ids_of(self.runs())), self.runs())

    def rebuild(self, table: DataFrame) -> None:
        """The ids of `table` in place of all that is held or was begun."""
        gone = [*self.runs(), *self.pending()]
        self.record(self.begin(table.where(F.col("event_id").isNotNull()).select("event_id").distinct()), gone)
