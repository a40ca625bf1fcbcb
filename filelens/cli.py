"""Command line: catalogue a tree, report it, or join labels to it.

    python -m filelens.cli catalogue ROOT OUT [--rule subdirs] [--format json|parquet] [--complete | --spark-listing]
    python -m filelens.cli report ROOT [--rule subdirs] [--buckets a1|a2|a3]
    python -m filelens.cli labels ROOT LABELS OUT [--rule one_level] [--report a3]

The session comes from ``SparkSession.builder.getOrCreate()`` - use
``spark-submit`` options (master, ``spark.checkpoint.dir``, memory) to
configure it.  Outputs are written by the executors; only the small report
is shown on the driver.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from filelens.operators import stats
from filelens.operators.catalogue import catalogue_files, label_catalogue
from filelens.sinks.tables import write_json, write_parquet
from filelens.sources.files import RULES
from filelens.sources.labels import read_labels

BUCKETS = {"a1": stats.BUCKETS_A1, "a2": stats.BUCKETS_A2, "a3": stats.BUCKETS_A3}


def _write(df, out: str, fmt: str) -> None:
    if fmt == "json":
        write_json(df, out)
    else:
        write_parquet(df, out)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="filelens")
    sub = ap.add_subparsers(dest="cmd", required=True)
    cat = sub.add_parser("catalogue", help="write the file catalogue of ROOT")
    cat.add_argument("root")
    cat.add_argument("out")
    rep = sub.add_parser("report", help="print counts and bytes by file type")
    rep.add_argument("root")
    rep.add_argument("--buckets", choices=sorted(BUCKETS), default="a2")
    lab = sub.add_parser("labels", help="join label JSON files to the catalogue and write the table")
    lab.add_argument("root")
    lab.add_argument("labels")
    lab.add_argument("out")
    for p in (cat, rep, lab):
        p.add_argument("--rule", choices=RULES, default="subdirs")
        how = p.add_mutually_exclusive_group()
        how.add_argument("--complete", dest="complete", action="store_const", const=True, default=None,
                         help="walk on executors, hidden and empty files too (the default for plain paths)")
        how.add_argument("--spark-listing", dest="complete", action="store_const", const=False,
                         help="list with Spark's file source, which leaves hidden and empty files out")
    for p in (cat, lab):
        p.add_argument("--format", choices=("json", "parquet"), default="parquet")
    lab.add_argument("--report", choices=sorted(BUCKETS), default=None,
                     help="also print counts and bytes of the joined table")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName("filelens").getOrCreate()
    files = catalogue_files(spark, args.root, rule=args.rule, complete=args.complete)
    if args.cmd == "catalogue":
        _write(files, args.out, args.format)
    elif args.cmd == "report":
        stats.type_counts(files, BUCKETS[args.buckets], size="file_size").show(truncate=False)
    else:
        table = label_catalogue(files, read_labels(spark, args.labels, pattern="*.json", recursive=True))
        _write(table, args.out, args.format)
        if args.report:
            # report on the written table, so the join is not computed twice
            written = spark.read.json(args.out) if args.format == "json" else spark.read.parquet(args.out)
            stats.type_counts(written, BUCKETS[args.report], size="file_size").show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
