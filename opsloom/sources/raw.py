"""Raw event batches and dimension files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsloom.schemas import LAKE_PARTITIONS, RAW_EVENT

CORRUPT = "_corrupt_record"


def _with_ordinal(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add `seq`, the place of a row in the input: file, then split, then row within the split.

    It is taken on the scan, before any shuffle, so reading the same files again gives the same
    ordinals.
    """
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("row"),
    )
    return df.select(*schema.names, place.alias("seq"))


def read_raw_events(
    spark: SparkSession,
    path: str,
    fmt: str = "json",
    multi_line: bool = False,
    days: tuple[str, str] | None = None,
) -> DataFrame:
    """Raw events as declared, plus the unparsable text in `_corrupt_record` and the ordinal `seq`.

    JSON lines and CSV files are splittable; `multi_line` reads files holding one JSON array. `days`,
    a first and a last date, opens only those folders of a zone laid out as year=/month=/day=.
    """
    schema = T.StructType([*RAW_EVENT.fields, T.StructField(CORRUPT, T.StringType())])
    reader = (
        spark.read.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
    )
    if fmt == "json":
        rows = reader.option("multiLine", str(multi_line).lower()).json(path)
    elif fmt == "csv":
        rows = reader.option("header", "true").csv(path)
    elif fmt == "parquet":
        rows = spark.read.schema(RAW_EVENT).parquet(path).withColumn(CORRUPT, F.lit(None).cast("string"))
    else:
        raise ValueError(f"unsupported raw format: {fmt}")
    if days is not None:
        # On folder columns alone, so the files of other days are not opened.
        folder_day = F.make_date(*[F.col(c).cast("int") for c in LAKE_PARTITIONS])
        rows = rows.where(folder_day.between(*[F.lit(d).cast("date") for d in days]))
    return _with_ordinal(rows, schema)


def read_dimension(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json") -> DataFrame:
    """A dimension as declared; a missing file is an empty dimension, which turns its key check off."""
    reader = spark.read.schema(schema)
    try:
        if fmt == "json":
            # A dimension document is one array per file.
            return reader.option("multiLine", "true").json(path)
        return reader.format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
