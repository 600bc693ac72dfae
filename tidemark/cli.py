"""Validation from the command line: python -m tidemark.cli --test row_count --source DIR --target DIR ...

Exits with 0 if the verdict is good and with 1 if it is not, or if arguments are missing.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import functions as F

from tidemark.operators import monitor, validate
from tidemark.session import get_spark

TESTS = ("row_count", "checksum", "sample", "replication_lag", "combined_lag", "connector_status", "table_health", "suite")
NEEDS = {
    "row_count": ("source", "target"),
    "checksum": ("source", "target", "columns"),
    "sample": ("source", "target"),
    "replication_lag": ("documents",),
    "combined_lag": ("source", "target", "time_column", "load_column"),
    "connector_status": ("documents",),
    "table_health": ("target", "snapshots"),
    "suite": ("source", "target"),
}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidemark", description="Validate a target table against its source.")
    p.add_argument("--test", required=True, choices=TESTS)
    p.add_argument("--source", help="Parquet folder of the source's copy")
    p.add_argument("--target", help="Parquet folder of the target's copy")
    p.add_argument("--columns", help="columns of the checksum, separated by commas")
    p.add_argument("--key", help="the column that tells rows apart; the first one unless given")
    p.add_argument("--sample-size", type=int, default=1000)
    p.add_argument("--time-column")
    p.add_argument("--load-column", default="processing_time")
    p.add_argument("--documents", help="JSON-lines file: connector, status, state, metrics")
    p.add_argument("--snapshots", help="Parquet folder with made_current_at")
    p.add_argument("--partitions", default="year,month")
    p.add_argument("--output", help="folder for the result as JSON")
    return p


def run(args: argparse.Namespace) -> dict:
    spark = get_spark("tidemark-validate")
    read = spark.read.parquet
    match args.test:
        case "row_count":
            return validate.as_result(lambda: validate.row_count(read(args.source), read(args.target)), "row_count")
        case "checksum":
            return validate.as_result(lambda: validate.checksum_match(read(args.source), read(args.target), args.columns.split(",")), "checksum")
        case "sample":
            args.key = validate.default_key(read(args.source), args.key)
            out = validate.as_result(lambda: validate.sample_match(read(args.source), read(args.target), args.key, args.sample_size), "sample")
            if "error" not in out:
                out["mismatch_examples"] = [r.asDict() for r in validate.sample_mismatches(read(args.source), read(args.target), args.key, args.sample_size).collect()]
            return out
        case "combined_lag":
            return validate.as_result(lambda: validate.combined_lag(read(args.source), read(args.target), args.time_column, args.load_column), "combined_lag", "is_acceptable")
        case "replication_lag":
            return validate.as_result(lambda: monitor.replication_lag(spark.read.schema("connector string, state string, metrics string").json(args.documents)).agg(F.every("is_acceptable").alias("is_acceptable"), F.max("lag_millis").alias("lag_millis")), "replication_lag", "is_acceptable")
        case "connector_status":
            return validate.as_result(lambda: monitor.all_running(monitor.connector_status(spark.read.schema("connector string, status string").json(args.documents))), "connector_status", "all_running")
        case "table_health":
            snapshots = read(args.snapshots)
            out = validate.as_result(lambda: validate.table_health(snapshots, snapshots, validate.partition_balance(read(args.target), args.partitions.split(",")), F.current_timestamp()), "table_health", "healthy")
            return {"healthy": out.get("health_score", 0) >= validate.HEALTH_WARNING, **out}
        case _:
            return validate.run_suite(spark, read(args.source), read(args.target), args.key, args.time_column, read(args.snapshots) if args.snapshots else None, None, args.partitions.split(","), args.sample_size)


def verdict(result: dict) -> bool:
    if "summary" in result:
        return result["summary"]["level"] != "Poor"
    return bool(next((result[k] for k in ("is_valid", "is_acceptable", "all_running", "healthy") if k in result), False))


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    if missing := [n for n in NEEDS[args.test] if getattr(args, n) is None]:
        print(f"--test {args.test} needs " + ", ".join("--" + n.replace("_", "-") for n in missing), file=sys.stderr)
        return 1
    result = run(args)
    print(json.dumps(result, indent=2, default=str))
    if args.output:
        validate.save_results(get_spark("tidemark-validate"), result, args.output, args.test)
    return 0 if verdict(result) else 1


if __name__ == "__main__":
    sys.exit(main())
