"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that may be changed on a running session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Where every partition of one join side is measured small, hash it instead of sorting both.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "32MB",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Streams keep their state off the heap, and a batch uploads what it changed, not all of it.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app: str = "opsloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the runtime settings; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    # Building a plan need not record the Python line of every expression.
    builder = builder.config("spark.python.sql.dataFrameDebugging.enabled", "false")
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Put the runtime settings on a session somebody else built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local-mode session, whose executors
    are on this machine, gets a folder of its own when the setting is missing.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    path = spark.conf.get("spark.opsloom.localScratch", None)
    if not path:
        path = tempfile.mkdtemp(prefix="opsloom-")
        spark.conf.set("spark.opsloom.localScratch", path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one run below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write `df` once to the shared folder and return the table read back.

    Cuts the lineage, so several consumers (or a retry after losing an executor) read the table
    instead of running the plan again. Flags in `partition_by` make the consumers' filters prune.
    """
    path = scratch_path(df.sparkSession, name)
    schema = df.schema
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path).select(*schema.names)
