"""python -m kinweave run|pilot|split|validate ...: whole runs, splits and checks of files from a shell."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .operators import sampling, validate
from .plans import runs
from .sources import tables


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="kinweave", description=__doc__)
    sub = top.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="candidates of all queries of a folder, with recall in mode eval")
    run.add_argument("--mode", choices=("eval", "test"), default="eval")
    run.add_argument("--ids", help="a text file with the queries' ids")
    run.add_argument("--limit", type=int)
    pilot = sub.add_parser("pilot", help="the union engine over samples")
    pilot.add_argument("--ids", required=True)
    pilot.add_argument("--scan-rows", type=int, default=250_000)
    split = sub.add_parser("split", help="write train, calibration and validation ids")
    split.add_argument("--ratios", type=float, nargs=3, default=(0.70, 0.15, 0.15))
    split.add_argument("--seed", type=int, default=42)
    for x in (run, pilot, split):
        x.add_argument("folder")
        x.add_argument("out")
    check = sub.add_parser("validate", help="check a file of lists against the queries of a folder")
    check.add_argument("folder")
    check.add_argument("file")
    check.add_argument("--column", default="matched_entity_ids")
    check.add_argument("--candidates", help="a file of candidates that the lists must be part of")
    return top


def main(args: list[str], spark: SparkSession | None = None) -> int:
    how = parser().parse_args(args)
    spark = spark or SparkSession.builder.appName("kinweave").getOrCreate()
    if how.command == "split":
        ids = tables.read_source(spark, f"{how.folder}/source1.tsv", "source1")
        tables.write_splits(sampling.entity_splits(ids, tuple(how.ratios), how.seed), how.out)
        return 0
    if how.command == "validate":
        expected = tables.read_source(spark, f"{how.folder}/source1.tsv", "source1")
        ok, errors = validate.validate_file(spark, how.file, expected, how.column, how.candidates)
        print("\n".join(errors or ["ok"]))
        return int(not ok)
    ids = tables.read_ids(spark, how.ids) if how.ids else None
    if how.command == "pilot":
        ok, errors = runs.pilot(spark, how.folder, how.out, ids, how.scan_rows)
        print("\n".join(errors or ["ok"]))
        return int(not ok)
    _, report = runs.run(spark, how.folder, how.out, how.mode, ids, limit=how.limit)
    if report is not None:
        report.show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
