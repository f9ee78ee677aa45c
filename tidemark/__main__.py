"""Run the pipeline's jobs: ``python -m tidemark <job> [<job> ...] [options]`` (or via ``spark-submit``).

Jobs mirror the reference's scheduled tasks and take the same parameters
(``--target`` is the bundle target; ``--market-batch-file`` picks a named
batch file under ``--sample-root``).  The principal defaults to the
session's ``current_user()``.  Several jobs given together run in order in
one session, like the tasks of one scheduled job; separate invocations
share tables only through a persistent catalog (a metastore configured for
the cluster), since the default catalog lives in the session.
"""

from __future__ import annotations

import argparse
import json
import sys

from tidemark.plans import jobs
from tidemark.session import build_session


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m tidemark", description=__doc__.splitlines()[0])
    p.add_argument(
        "jobs",
        nargs="+",
        choices=["market", "market-validate", "orders", "orders-validate", "cleanup", "dashboard"],
    )
    p.add_argument("--target", required=True, help="bundle target (part of every table name)")
    p.add_argument("--principal", default=None, help="override current_user() for table names")
    p.add_argument("--sample-root", help="folder holding the market batch files (market)")
    p.add_argument("--market-batch-file", default="", help="named batch file under --sample-root (market)")
    p.add_argument("--orders-csv", help="orders CSV path (orders)")
    p.add_argument("--buckets", type=int, default=None, help="bucket the orders tables on order_id (orders)")
    p.add_argument("--expect-counts", default=None, help="'bronze,silver' exact row counts (orders-validate)")
    p.add_argument("--output", help="output folder for the dashboard document (dashboard)")
    p.add_argument("--master", default=None, help="Spark master (default: from spark-submit / environment)")
    return p


def run_job(spark, job: str, args) -> object:
    who = args.principal
    if job == "market":
        return jobs.market_job(spark, args.sample_root, args.target, args.market_batch_file, who)
    if job == "market-validate":
        return [r.asDict() for r in jobs.market_validation(spark, args.target, who).collect()]
    if job == "orders":
        return jobs.orders_job(spark, args.orders_csv, args.target, who, buckets=args.buckets)
    if job == "orders-validate":
        counts = tuple(int(x) for x in args.expect_counts.split(",")) if args.expect_counts else None
        return [r.asDict() for r in jobs.orders_validation(spark, args.target, who, counts).collect()]
    if job == "cleanup":
        return jobs.cleanup(spark, args.target, who)
    return jobs.dashboard_export(spark, args.target, args.output, who)


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = build_session(args.master, app_name="tidemark-" + "-".join(args.jobs))
    try:
        for job in args.jobs:
            print(json.dumps({job: run_job(spark, job, args)}, default=str, sort_keys=True))
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
