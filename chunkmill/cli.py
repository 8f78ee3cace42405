"""Command line: process, migrate, status, validate."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .config import Settings
from .plans import pipeline


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """0 if all went well; 1 on a bad setting, an error, a failed document or an inconsistent store."""
    parser = argparse.ArgumentParser(prog="chunkmill")
    sub = parser.add_subparsers(dest="command", required=True)
    run = sub.add_parser("process")
    run.add_argument("--force", action="store_true", default=None)
    for name, kind in (("data-dir", str), ("dataset-filter", str), ("chunk-max-tokens", int), ("embedding-model", str), ("embedding-cache", str), ("storage", str), ("limit", int)):
        run.add_argument(f"--{name}", type=kind)
    move = sub.add_parser("migrate")
    move.add_argument("--source", required=True)
    move.add_argument("--target", required=True)
    move.add_argument("--source-path")
    move.add_argument("--target-path")
    move.add_argument("--batch-size", type=int)
    check = sub.add_parser("validate")
    check.add_argument("--storage", dest="layout", choices=("store", "jsonl", "flat"), default="store")
    check.add_argument("--store-path")
    for command in (move, sub.add_parser("status"), check):
        command.add_argument("--data-dir", default="./data")
    args = vars(parser.parse_args(argv))
    command = args.pop("command")
    spark = spark or SparkSession.builder.appName("chunkmill").getOrCreate()
    try:
        if command == "process":
            result = pipeline.process(spark, Settings.load(args), progress=pipeline.Printed())
            print(f"processed {result.processed}, failed {result.failed}, removed {result.removed}")
            return int(result.failed > 0)
        if command == "migrate":
            print(f"migrated {pipeline.migrate(spark, **args, progress=pipeline.Printed())}")
            return 0
        if command == "status":
            row = pipeline.status(spark, **args).first()
            print(f"processed {row['processed']}, failed {row['failed']}")
            return 0
        report, differences = pipeline.validate(spark, **args)
        row = report.first()
        print(", ".join(f"{k}: {row[k]}" for k in report.columns))
        for side in ("missing", "orphan"):
            for r in differences.where(differences.side == side).orderBy("doc_id").limit(10).collect():
                print(f"  {side}: {r['doc_id']}")
        return int(not row["is_consistent"])
    except (RuntimeError, ValueError) as error:
        print(f"error: {error}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
