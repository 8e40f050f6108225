"""Session settings, table reads and Arrow plumbing shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsloom.session import prepare, staged

__all__ = ["ready", "table", "staged", "text_or_empty", "mapped", "held_out", "slices", "release"]

# Python workers see texts in batches of this many rows, and numpy sees at most this many bytes of
# them at a time (a longer single text is taken alone).
ROWS_PER_BATCH = 1000
BYTES_PER_SLICE = 500_000
WORD = "[^\\x20\\x09-\\x0D]+"


def ready(spark: SparkSession) -> SparkSession:
    """Runtime settings of the operators: small Arrow batches, shuffle files freed after each job."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def release(*frames: DataFrame) -> None:
    """Empty staged tables whose readers have finished, so that their space is free again."""
    for df in frames:
        folder = df.inputFiles()[0].rsplit("/", 1)[0] if df.inputFiles() else None
        if folder:
            df.sparkSession.createDataFrame([], df.schema).write.mode("overwrite").parquet(folder)


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def held_out(id_col: str, modulus: int, remainder: int) -> Column:
    """crc32 of the id as text, by remainder; a null id counts as held out."""
    part = F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(modulus))
    return F.coalesce(part == remainder, F.lit(True))


def mapped(df: DataFrame, make: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """`df` through a function of one Arrow batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield make(batch)

    return df.mapInArrow(run, schema)


def slices(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts have BYTES_PER_SLICE together, or one row."""
    begin = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > BYTES_PER_SLICE:
            yield begin, i
            begin, size = i, 0
        size += len(text) + 1
    if begin < len(texts):
        yield begin, len(texts)
