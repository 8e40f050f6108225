"""Named views and catalog tables over the lake."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from opsloom import schemas as S
from opsloom.operators import reports
from opsloom.sources.lake import read_event_lake

FACT = "fact_operational_event"
DIMENSIONS = {
    "dim_customer": ("dim_customers", S.CUSTOMER),
    "dim_service": ("dim_services", S.SERVICE),
    "dim_location": ("dim_locations", S.LOCATION),
}


def register_views(spark: SparkSession, path: str) -> None:
    """Fact, dimensions and the three report views under the names users query."""
    tables = {FACT: read_event_lake(spark, f"{path}/{FACT}")}
    for view, (folder, schema) in DIMENSIONS.items():
        tables[view] = spark.read.schema(schema).parquet(f"{path}/{folder}")
    events = tables[FACT]
    views = {
        **tables,
        "vw_service_reliability_summary": reports.service_reliability(events, tables["dim_service"]),
        "vw_location_bottlenecks": reports.location_bottlenecks(events, tables["dim_location"]),
        "vw_customer_tier_exposure": reports.tier_exposure(events, tables["dim_customer"]),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def _columns(schema, skip: tuple[str, ...] = ()) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name not in skip)


def create_catalog(spark: SparkSession, db: str, root: str) -> None:
    """External database and tables over an existing lake; nothing happens where they exist."""
    root = root.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}` LOCATION '{root}/{db}'")
    partitions = ", ".join(f"`{p}` string" for p in S.LAKE_PARTITIONS)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS `{db}`.`{FACT}` "
        f"({_columns(S.LAKE_EVENT, S.LAKE_PARTITIONS)}, {partitions}) USING PARQUET "
        f"OPTIONS ('compression'='snappy') PARTITIONED BY ({', '.join(S.LAKE_PARTITIONS)}) "
        f"LOCATION '{root}/{FACT}'"
    )
    for table, (folder, schema) in DIMENSIONS.items():
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS `{db}`.`{table}` ({_columns(schema)}) USING PARQUET "
            f"LOCATION '{root}/{folder}'"
        )


def repair_partitions(spark: SparkSession, table: str) -> None:
    """Make partitions written to the folder since the last call visible in the catalog."""
    spark.catalog.recoverPartitions(table)


def create_if_absent(df: DataFrame, table: str, path: str | None = None) -> None:
    """Store a report as a table unless the table exists."""
    writer = df.write.format("parquet").mode("ignore")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def build_aggregate_tables(spark: SparkSession, db: str, root: str | None = None) -> None:
    """The two stored aggregates of the catalog: daily summary and customer incident profile."""
    events = spark.table(f"`{db}`.`{FACT}`")
    customers = spark.table(f"`{db}`.`dim_customer`")
    tables = {
        "agg_daily_operational_summary": reports.daily_summary(events),
        "agg_customer_incident_profile": reports.customer_incident_profile(events, customers),
    }
    for name, df in tables.items():
        create_if_absent(df, f"`{db}`.`{name}`", f"{root}/{name}" if root else None)
