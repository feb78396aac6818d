"""python -m ledgerloom LEFT.xlsx RIGHT.xlsx [--output REPORT.xlsx] [--left-map JSON] [--right-map JSON] [--rules FILE] [--legacy]"""

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .plans import reconcile, workbooks
from .sources import ingest, xlsx
from .storage import scratch, settle


def main() -> None:
    parser = argparse.ArgumentParser(description="Reconcile two ledgers held in workbooks.")
    parser.add_argument("left")
    parser.add_argument("right")
    parser.add_argument("--output", default="report.xlsx", help="a workbook, or a folder for Parquet tables")
    parser.add_argument("--left-map", default="{}", help="JSON of source column to canonical name")
    parser.add_argument("--right-map", default="{}")
    parser.add_argument("--rules", help="JSON lines of matrix rules: folder and matrix_key")
    parser.add_argument("--insurer", help="take the rules of this folder alone")
    parser.add_argument("--left-keys", default=",".join(ingest.LEFT_NAMES), help="columns that make the keys of rules")
    parser.add_argument("--right-keys", default=",".join(ingest.RIGHT_NAMES))
    parser.add_argument("--legacy", action="store_true", help="run as the older engine did")
    args = parser.parse_args()
    spark = SparkSession.builder.appName("ledgerloom").getOrCreate()
    rules = None
    if args.rules:
        items = spark.read.schema("folder string, matrix_key string").json(args.rules).withColumn("position", F.monotonically_increasing_id())
        rules = settle(ingest.matrix_list(items, args.insurer))
    # a mapping that is no JSON counts as none: the columns' own names are taken
    maps = [ingest.custom_mapping(text) for text in (args.left_map, args.right_map)]
    profile = reconcile.LEGACY if args.legacy else reconcile.MODULAR
    with scratch(spark):
        report(spark, args, maps, profile, rules)
    spark.stop()


def report(spark, args, maps, profile, rules) -> None:
    """Run and write; what the run settles is gone afterwards."""
    tables = workbooks.run(spark, args.left, args.right, *maps, profile, rules, (args.left_keys.split(","), args.right_keys.split(",")))
    if args.output.endswith(".xlsx"):
        xlsx.write_workbook(tables, args.output)
    else:
        xlsx.write_tables(tables, args.output)


if __name__ == "__main__":
    main()
