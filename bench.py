"""Times the headline queries and the full table build; prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the number of local threads. Every query runs once to
warm up and then twice, of which the faster run counts; results are written to Spark's `noop` sink, so all rows and columns are computed.

The table build runs over the given events, and over COPIES times as many: the deliveries repeated with other user
ids. The second one gives the events per second to compare with, as small tables measure Spark's cost per job.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from cartwright.plans import silver  # noqa: E402
from cartwright.plans.medallion import JOB_TABLES, MODEL_TABLES, Medallion  # noqa: E402
from cartwright.plans.queries import AS_OF, inputs, queries  # noqa: E402
from cartwright.session import build_session, delete_path, materialise, scratch_path  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
COPIES = 30
HEADLINE = [
    "events_cleaned",
    "stg_events",
    "dim_products",
    "dim_users",
    "stg_products",
    "stg_users",
    "daily_sales",
    "fct_daily_sales",
    "funnel_daily",
    "fct_funnel",
    "customer_rfm",
    "dim_customer_rfm",
    "hourly_traffic",
    "product_ranks",
    "segment_distribution",
    "revenue_by_month",
    "wow_growth",
    "kpi_summary",
    "top_products",
    "merge_upsert_events",
    "merge_bucketed_events",
    "monthly_customers",
    "dq_at_write",
    "dq_report",
]


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "16g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = queries()
    times: dict[str, float] = {}

    def once(run) -> float:
        start = time.perf_counter()
        run()
        return time.perf_counter() - start

    def timed(run) -> float:
        run()
        return round(min(once(run), once(run)), 3)

    def build(names: list[str], source):
        def run() -> None:
            path = scratch_path(spark, "bench")
            Medallion(spark, path, lambda: source, F.to_date(F.lit(AS_OF))).build(names)
            delete_path(spark, path)

        return run

    for name in HEADLINE:
        run = lambda: registered[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        times[name] = timed(run)
    # Raw events to bronze, silver and all gold tables, written as files.
    bronze = inputs(spark, SF_DIR).bronze
    # The clean tables with the dedupe, which the queries of the same name read as a written table.
    for model in (silver.events_cleaned, silver.stg_events):
        run = lambda: model(silver.deduplicated(bronze)).write.format("noop").mode("overwrite").save()
        times[f"{model.__name__}_from_bronze"] = timed(run)
    for label, names in (("build_job_tables", JOB_TABLES), ("build_model_tables", MODEL_TABLES)):
        times[label] = timed(build(names, bronze))
    events = bronze.count()
    copy = F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))).alias("copy")
    larger = bronze.select("*", copy).withColumn("user_id", F.col("user_id") * COPIES + F.col("copy")).drop("copy")
    larger = materialise(larger, "larger")
    large = round(once(build(JOB_TABLES, larger)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
                "raw_events": events,
                "large_build_sec": large,
                "large_build_events": events * COPIES,
                "build_events_per_sec": round(events * COPIES / large),
                "build_events_per_sec_per_thread": round(events * COPIES / large / int(CPUS)),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
