"""Command line: jobs over a lake folder, run as `python -m cartwright <command>`.

    build  raw CSV files to bronze, silver and gold tables
    serve  typed serving copies of four gold tables
    export one gold table as CSV
    check  the declared data tests
"""

from __future__ import annotations

import argparse
from datetime import datetime

from pyspark.sql import functions as F

from cartwright.operators import quality, sinks
from cartwright.plans.medallion import JOB_TABLES, MODEL_TABLES, Medallion
from cartwright.session import build_session
from cartwright.sources.files import ingest_csv, read_parquet

SERVED = {
    "daily_sales": "gold.daily_sales",
    "funnel_analysis": "gold.funnel_analysis",
    "customer_rfm": "gold.customer_rfm",
    "product_performance": "gold.product_performance",
}
TESTED = {
    "stg_events": "silver.stg_events",
    "stg_products": "silver.stg_products",
    "stg_users": "silver.stg_users",
    "fct_daily_sales": "gold.fct_daily_sales",
    "fct_funnel": "gold.fct_funnel",
    "dim_customer_rfm": "gold.dim_customer_rfm",
}


def parse(arguments: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="cartwright", description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    parser.add_argument("command", choices=["build", "serve", "export", "check"])
    parser.add_argument("--lake", required=True, help="folder of the tables")
    parser.add_argument("--source", help="CSV files for build, may be a glob")
    parser.add_argument("--target", help="folder for serve and export")
    parser.add_argument("--table", choices=list(SERVED), help="table for export")
    return parser.parse_args(arguments)


def main(arguments: list[str] | None = None) -> int:
    args = parse(arguments)
    spark = build_session(f"cartwright-{args.command}")

    def written(name: str):
        return read_parquet(spark, f"{args.lake}/{name.replace('.', '/')}")

    if args.command == "build":
        batch = datetime.now().strftime("%Y%m%d_%H%M%S")
        lake = Medallion(spark, args.lake, lambda: ingest_csv(spark, args.source, batch), F.current_date())
        lake.build(JOB_TABLES)
        lake.build(MODEL_TABLES)
        return 0
    if args.command == "serve":
        status = sinks.sync_all(spark, {n: (written(t), f"{args.target}/{n}") for n, t in SERVED.items()})
        status.show(truncate=False)
        return 0 if status.where(~F.col("ok")).isEmpty() else 1
    if args.command == "export":
        sinks.export_csv(written(SERVED[args.table]), f"{args.target}/{args.table}")
        return 0
    report = quality.report({name: written(table) for name, table in TESTED.items()})
    report.show(100, truncate=False)
    return 0 if report.where(~F.col("passed")).isEmpty() else 1


if __name__ == "__main__":
    raise SystemExit(main())
