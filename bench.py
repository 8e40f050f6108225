"""Headline timings. Prints one JSON line.

`queries` are seconds at $BENCH_SF_DIR, the best of three runs after one warm-up. `events_per_sec`
repeats the event table of that folder to a fixed number of rows, where work outweighs the fixed
cost of a Spark job, for the operations the baseline gives rates for.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsloom.operators import quality as Q
from opsloom.operators import reports as A
from opsloom.operators import triage as Tr
from opsloom.plans import registry
from opsloom.session import build_session, scratch_path
from opsloom.sources import binding as B
from opsloom.sources import lake as L

HEADLINE = (
    "dq_summary",
    "dq_reasons",
    "cases",
    "service_reliability",
    "location_bottlenecks",
    "tier_exposure",
    "hourly_trend",
    "daily_summary",
    "customer_incident_profile",
    "incident_rate_by_day_service",
    "latency_approx",
    "latency_exact",
    "measures_rollup",
    "summary_kpis",
    "exception_page",
    "triage_queue",
    "trailing_60m",
    "trailing_by_customer",
    "velocity",
    "impact_by_segment",
    "lake_roundtrip",
    "stream_lake",
)
RATE_ROWS = int(os.environ.get("BENCH_RATE_ROWS", "5000000"))


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def best(action, runs: int = 3) -> float:
    action()
    times = []
    for _ in range(runs):
        began = time.perf_counter()
        action()
        times.append(time.perf_counter() - began)
    return round(min(times), 3)


def repeated_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bound events, repeated with fresh ids to RATE_ROWS rows and stored as many files."""
    raw = B.table(spark, sf_dir, "events")
    n = raw.count()
    copies = max(1, RATE_ROWS // n)
    path = scratch_path(spark, "bench-events")
    many = raw.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    (
        many.withColumn("event_id", F.col("event_id") + F.col("_copy") * n)
        .drop("_copy")
        .repartition(16, "event_id")
        .write.parquet(path)
    )
    return B.bind_events(spark.read.parquet(path))


def rates(spark: SparkSession, sf_dir: str) -> dict[str, float]:
    events = repeated_events(spark, sf_dir)
    star = B.bind_star(spark, sf_dir)
    rows = events.count()
    raw_path = scratch_path(spark, "bench-raw")
    B.bind_dirty_events(events).write.parquet(raw_path)
    raw = spark.read.parquet(raw_path)
    lake = scratch_path(spark, "bench-lake")
    clean = scratch_path(spark, "bench-clean")
    events.drop("clock").write.parquet(clean)

    def validate() -> None:
        run(Q.validate_events(raw, B.DIRTY_AS_OF, star.customers, star.services, star.locations))

    def write() -> None:
        L.write_event_lake(spark.read.parquet(clean), lake, whole_days=True)

    seconds = {"validate": best(validate, 1), "lake_write": best(write, 1)}
    stored = L.read_event_lake(spark, lake)
    seconds["full_scan"] = best(lambda: A.scan_profile(stored).collect())
    day = Tr.partition_range(stored, "2024", "01", "16", "16")
    seconds["pruned_scan"] = best(lambda: A.scan_profile(day).collect())
    counted = {"pruned_scan": day.count()}
    return {name: round(counted.get(name, rows) / s) for name, s in seconds.items()}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "opsloom-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    times = {name: best(lambda name=name: run(queries[name](spark, sf_dir))) for name in HEADLINE}
    per_sec = rates(spark, sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rsplit("sf", 1)[-1],
                "rate_rows": RATE_ROWS,
                "events_per_sec": per_sec,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
