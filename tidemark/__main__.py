"""Command line: ``python -m tidemark clean|train|query|export|audit ...``"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame

from tidemark.ml.candidates import Settings
from tidemark.plans import library
from tidemark.session import build_session
from tidemark.sources import publish


def print_all(report: DataFrame) -> None:
    """Every row, tab-separated, a partition at a time."""
    print("\t".join(report.columns))
    for row in report.toLocalIterator():
        print("\t".join("" if v is None else str(v) for v in row))


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tidemark")
    steps = parser.add_subparsers(dest="step", required=True)
    clean = steps.add_parser("clean", help="load CSV, clean, publish Parquet")
    clean.add_argument("raw")
    clean.add_argument("out")
    train = steps.add_parser("train", help="train, score and publish predictions")
    train.add_argument("folder")
    train.add_argument("--selection", choices=("test", "validation"), default="test")
    query = steps.add_parser("query", help="show a named business query")
    query.add_argument("folder")
    query.add_argument("name", choices=sorted(library.LIBRARY))
    query.add_argument("--out", help="write all rows there as CSV instead of printing them")
    export = steps.add_parser("export", help="write tables and views as CSV for BI tools")
    export.add_argument("folder")
    export.add_argument("out")
    audit = steps.add_parser("audit", help="compare published columns with the expected ones")
    audit.add_argument("folder")
    args = parser.parse_args(argv)
    spark = build_session("tidemark")
    if args.step == "clean":
        library.clean_and_publish(spark, args.raw, args.out)
    elif args.step == "train":
        out = library.train(spark, args.folder, Settings(), args.selection)
        out["comparison"].show(truncate=False)
        out["report"].show(truncate=False)
    elif args.step == "query":
        scored = args.name in ("at_risk_list", "top_drivers", "risk_tier_revenue")
        library.open_tables(spark, args.folder, scored)
        report = library.LIBRARY[args.name](spark)
        if args.out:
            report.write.mode("overwrite").option("header", True).csv(args.out)
        else:
            print_all(report)
    elif args.step == "export":
        library.open_tables(spark, args.folder, scored=True)
        publish.export_csv(spark, args.out)
    else:
        tables = library.open_tables(spark, args.folder, scored=True)
        print_all(publish.audit_columns(spark, tables))


if __name__ == "__main__":
    main()
