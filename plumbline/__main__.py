"""``spark-submit`` entry: one daily run, its outcome as the exit code."""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import SparkSession

from plumbline.plans import daily_run
from plumbline.sources.contracts import Contract


def main() -> int:
    parser = argparse.ArgumentParser(prog="plumbline", description=__doc__)
    parser.add_argument("csv", help="the delivered snapshot, a file or a folder of files")
    parser.add_argument("root", help="where the tables, histories and reports lie")
    parser.add_argument("--contract", help="contract file; the shipment contract by default")
    parser.add_argument("--expected-rows", type=int, default=daily_run.EXPECTED_ROWS)
    parser.add_argument(
        "--multiline", action="store_true", help="values may hold line breaks inside quotes"
    )
    parser.add_argument("--dry-run", action="store_true", help="write nothing")
    arguments = parser.parse_args()
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    logging.getLogger("py4j").setLevel(logging.WARNING)
    spark = SparkSession.builder.appName("plumbline").getOrCreate()
    return daily_run.run(
        spark,
        arguments.csv,
        arguments.root,
        contract=Contract.from_store(spark, arguments.contract) if arguments.contract else None,
        expected_rows=arguments.expected_rows,
        multiline=arguments.multiline,
        dry_run=arguments.dry_run,
    )


if __name__ == "__main__":
    sys.exit(main())
