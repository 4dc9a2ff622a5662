"""One daily run: python -m claimloom --inbox ... --root ... [--ingestion_date 2024-01-31]."""

from __future__ import annotations

import argparse
import datetime
import logging
import os

from pyspark.sql import SparkSession

from claimloom.operators.quality import ROW_FLOOR
from claimloom.plans import catalog
from claimloom.plans.pipeline import STEPS, Warehouse


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    day = datetime.date.fromisoformat
    parser = argparse.ArgumentParser(prog="claimloom", description=__doc__)
    parser.add_argument("--inbox", help="folder the delivered CSV files lie in; required for the extraction")
    parser.add_argument("--root", required=True, help="folder of the warehouse")
    parser.add_argument(
        "--ingestion_date",
        type=day,
        default=os.environ.get("INGESTION_DATE") or datetime.date.today().isoformat(),
        help="date of the delivery; default: INGESTION_DATE, else today",
    )
    parser.add_argument("--as_of", type=day, help="day versions open and close on; default: today")
    parser.add_argument("--run_id", help="name of the run; default: the two dates")
    parser.add_argument("--step", choices=STEPS, action="append", help="only this step; may be given again; default: all")
    parser.add_argument("--row_floor", type=int, default=ROW_FLOOR, help="fewest claims a complete load has")
    args = parser.parse_args(argv)
    args.step = tuple(args.step or STEPS)
    if not args.inbox and "extraction" in args.step:
        parser.error("the following arguments are required: --inbox")
    return args


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    logging.basicConfig(level=logging.INFO, format="%(levelname)s %(message)s")
    spark = SparkSession.builder.appName("claimloom").getOrCreate()
    warehouse = Warehouse(spark, args.root)
    result = warehouse.run(args.inbox, args.ingestion_date, args.as_of, args.run_id, args.row_floor, args.step)
    if "loading" in args.step:
        catalog.publish(warehouse, args.ingestion_date)
    for check in result.checks:
        logging.info("%s %s: %s (expected %s)", check.result, check.check_name, check.value, check.expected)
    spark.stop()


if __name__ == "__main__":
    main()
