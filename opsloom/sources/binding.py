"""Binding of the given benchmark tables to the star schema the operators work on.

The mapping is arithmetic on columns of the given tables, so its SQL twin is short and the work
grows with the tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsloom.schemas import struct
from opsloom.session import prepare

# Declared, so that opening a table reads no file.
TABLES = {
    "events": struct(
        "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    ),
    "customer": struct(
        "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "part": struct(
        "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    ),
    "supplier": struct("s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
    "nation": struct("n_nationkey int, n_name string, n_regionkey int"),
    "region": struct("r_regionkey int, r_name string"),
    "orders": struct(
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
}
DIRTY_AS_OF = "2024-02-01 00:00:00"


@dataclass(frozen=True)
class Star:
    events: DataFrame
    customers: DataFrame
    services: DataFrame
    locations: DataFrame


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def event_key(id_col: Column) -> Column:
    """EVT- and the number, at least eight digits."""
    digits = id_col.cast("string")
    return F.concat(F.lit("EVT-"), F.lpad(digits, F.greatest(F.length(digits), F.lit(8)), F.lit("0")))


def bind_events(raw: DataFrame) -> DataFrame:
    """Events file -> event schema, plus `seq`, the input ordinal, and `clock`, when its case is seen."""
    k, kind, status = F.col("k"), F.col("event_type"), F.col("status_code")
    server_error = F.when(k % 3 == 0, 500).when(k % 3 == 1, 503).otherwise(504)
    # The clock runs `value` minutes after the event; value has two decimals, so this is exact.
    waited_micros = F.floor(F.col("value") * 100 + F.lit(0.5)).cast("long") * 600000
    return (
        raw.withColumns(
            {
                "k": F.get_json_object("props", "$.k").cast("long"),
                "timestamp": F.col("ts").cast("timestamp"),
            }
        )
        .withColumn(
            "status_code",
            F.when(kind == "error", server_error)
            .when((kind == "view") & (k % 10 == 0), 404)
            .when((kind == "signup") & (k % 10 == 0), 400)
            .when(kind == "purchase", 201)
            .otherwise(200)
            .cast("long"),
        )
        .select(
            event_key(F.col("event_id")).alias("event_id"),
            "timestamp",
            F.col("user_id").cast("string").alias("customer_id"),
            k.cast("string").alias("service_id"),
            (F.col("event_id") % 25).cast("string").alias("location_id"),
            F.when(status >= 500, "PROCESSING_FAILED")
            .when(kind == "view", "REQUEST_RECEIVED")
            .otherwise("STATUS_CHANGE")
            .alias("event_type"),
            F.floor(F.col("value") * 10).cast("long").alias("duration_ms"),
            (k * 1024).alias("payload_bytes"),
            "status_code",
            F.when(status >= 400, F.concat(F.lit("Service exception HTTP "), status.cast("string"))).alias(
                "error_message"
            ),
            F.col("event_id").alias("seq"),
            F.timestamp_micros(F.unix_micros("timestamp") + waited_micros).alias("clock"),
        )
    )


def bind_customers(customer: DataFrame) -> DataFrame:
    seg = F.col("c_mktsegment")
    tier = F.when(seg == "AUTOMOBILE", "Enterprise").when(seg.isin("BUILDING", "FURNITURE"), "Commercial")
    contract = F.when(seg == "AUTOMOBILE", "Gold").when(seg.isin("BUILDING", "FURNITURE"), "Silver")
    return customer.select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        tier.otherwise("Retail").alias("tier"),
        contract.otherwise("Bronze").alias("contract_sla_tier"),
        seg.alias("industry"),
    )


def bind_services(part: DataFrame) -> DataFrame:
    level = (F.col("p_size") % 3 + 1).cast("int")
    return part.select(
        F.col("p_partkey").cast("string").alias("service_id"),
        F.col("p_name").alias("service_name"),
        F.col("p_type").alias("service_category"),
        level.alias("tier_level"),
        F.when(level == 1, 60).when(level == 2, 240).otherwise(720).alias("default_sla_minutes"),
    )


def bind_locations(nation: DataFrame, region: DataFrame) -> DataFrame:
    zone = F.concat(F.lit("DC-"), F.col("n_nationkey").cast("string"))
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").cast("string").alias("location_id"),
        F.col("r_name").alias("region"),
        zone.alias("datacenter_zone"),
        F.col("n_name").alias("country"),
    )


def bind_star(spark: SparkSession, sf_dir: str) -> Star:
    return Star(
        events=bind_events(table(spark, sf_dir, "events")),
        customers=bind_customers(table(spark, sf_dir, "customer")),
        services=bind_services(table(spark, sf_dir, "part")),
        locations=bind_locations(table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")),
    )


def bind_exposures(orders: DataFrame) -> DataFrame:
    """Measured exposure per customer: the largest order. A maximum does not depend on row order."""
    return orders.groupBy(F.col("o_custkey").cast("string").alias("customer_id")).agg(
        F.max("o_totalprice").alias("financial_exposure")
    )


def bind_dirty_events(events: DataFrame) -> DataFrame:
    """Bound events -> raw input with planted defects, keeping `seq`."""
    n = F.col("seq")
    text = F.concat(F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
    return events.select(
        F.when((n % 97 == 1) | (n % 101 != 0), event_key(n - (n % 97 == 1).cast("long"))).alias("event_id"),
        F.when(n % 67 == 0, "not-a-ts")
        .when(n % 83 == 0, "2999-01-01T00:00:00+00:00")
        .otherwise(text)
        .alias("timestamp"),
        F.when(n % 89 == 0, F.lit(None))
        .when(n % 61 == 0, "999999999")
        .otherwise(F.col("customer_id"))
        .alias("customer_id"),
        F.when(n % 71 == 0, "999999").otherwise(F.col("service_id")).alias("service_id"),
        (n % 27).cast("string").alias("location_id"),
        "event_type",
        F.when(n % 79 == 0, F.lit(-5).cast("long")).otherwise(F.col("duration_ms")).alias("duration_ms"),
        "payload_bytes",
        F.when(n % 73 == 0, F.lit(999).cast("long")).otherwise(F.col("status_code")).alias("status_code"),
        "error_message",
        "seq",
    )


def bind_transitions(orders: DataFrame) -> DataFrame:
    """Orders -> state-change log (case_id, changed_at, seq, state), with skipped and reopened steps planted."""
    key = F.col("o_orderkey")
    # The path of states per order status, and the two planted illegal paths.
    path = (
        F.when(key % 13 == 0, "DETECTED,RESOLVED")
        .when(key % 17 == 0, "DETECTED,CLOSED,IN_PROGRESS,RESOLVED")
        .when(F.col("o_orderstatus") == "O", "DETECTED,TRIAGED,ASSIGNED")
        .when(F.col("o_orderstatus") == "P", "DETECTED,TRIAGED,ASSIGNED,IN_PROGRESS")
        .otherwise("DETECTED,TRIAGED,ASSIGNED,IN_PROGRESS,RESOLVED,CLOSED")
    )
    steps = orders.select(
        key, F.col("o_orderdate").cast("timestamp").alias("opened"), F.posexplode(F.split(path, ",")).alias("seq", "state")
    )
    minutes = F.col("seq").cast("long") * (F.lit(60) + key % 240)
    return steps.select(
        F.concat(F.lit("CASE-"), key.cast("string")).alias("case_id"),
        F.timestamp_micros(F.unix_micros("opened") + minutes * 60000000).alias("changed_at"),
        "seq",
        "state",
    )
