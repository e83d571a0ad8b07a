"""Command line: ``python -m waveband.plans build|bucket|publish|sweep ...`` (or via spark-submit).

    build   --tables ROOT --out ROOT [--bucketed] [--control PATH] [--backfill [--step N]] [--no-register] [--strict]
    bucket  --tables ROOT --out ROOT --buckets N [--files-per-bucket N]
    publish --src ROOT --dst ROOT [--table NAME ...]
    sweep   --root ROOT [--keep N] [--grace-hours H]

The session comes from the launcher (master, resources, ``spark.checkpoint.dir``);
only the job's own SQL settings are applied.
"""

from __future__ import annotations

import argparse
import json
import sys

from waveband.plans.build import backfill, build, publish_outputs, read_control
from waveband.session import get_session
from waveband.sources.bucketed import read_bucketed_tables, write_bucketed_tables
from waveband.sources.releases import sweep
from waveband.sources.stored import sweep_handovers
from waveband.sources.tables import read_survey_tables


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="waveband.plans")
    sub = parser.add_subparsers(dest="command", required=True)
    b = sub.add_parser("build", help="quarterly build")
    b.add_argument("--tables", required=True, help="root of the survey tables")
    b.add_argument("--out", required=True, help="root of the output tables")
    b.add_argument("--bucketed", action="store_true", help="the tables are those that the bucket command wrote")
    b.add_argument("--control", help="control table path (default OUT/quarters, else TABLES/quarters)")
    b.add_argument("--backfill", action="store_true", help="reload every quarter that is not pending")
    b.add_argument("--step", type=int, help="with --backfill: so many quarters at a time, each with its release; a failed run goes on where it was")
    b.add_argument("--no-register", action="store_true", help="do not register a new quarter")
    b.add_argument("--strict", action="store_true", help="fail when more than one quarter is loaded")
    k = sub.add_parser("bucket", help="store the survey tables in buckets by respondent")
    k.add_argument("--tables", required=True, help="root of the survey tables")
    k.add_argument("--out", required=True, help="root of the bucketed tables")
    k.add_argument("--buckets", type=int, required=True)
    k.add_argument("--files-per-bucket", type=int, default=1, help="files that a bucket of one quarter is written to at most")
    p = sub.add_parser("publish", help="release-day copy to the reporting area")
    p.add_argument("--src", required=True)
    p.add_argument("--dst", required=True)
    p.add_argument("--table", action="append", help="table to copy (default: the three published ones)")
    w = sub.add_parser("sweep", help="remove files that none of the last releases names, and what dead jobs handed over")
    w.add_argument("--root", required=True)
    w.add_argument("--keep", type=int, default=2, help="releases to keep")
    w.add_argument("--grace-hours", type=float, default=24.0, help="nothing younger goes")
    args = parser.parse_args(argv)

    spark = get_session(app_name=f"waveband-{args.command}")
    if args.command == "build":
        tables = (read_bucketed_tables if args.bucketed else read_survey_tables)(spark, args.tables)
        control_path = args.control or f"{args.out}/quarters"
        control = read_control(spark, control_path)
        if control is not None:
            tables = tables.replace(quarters=control)
        if args.backfill and args.step:
            print(json.dumps(backfill(spark, tables, args.out, args.step, control_path=control_path).__dict__))
            return 0
        result = build(spark, tables, args.out, mode="not_pending" if args.backfill else "pending",
                       register=not args.no_register, strict=args.strict, control_path=control_path)
        print(json.dumps(result.__dict__))
    elif args.command == "bucket":
        write_bucketed_tables(read_survey_tables(spark, args.tables), args.out, args.buckets, args.files_per_bucket)
    elif args.command == "sweep":
        print(json.dumps({"files": sweep(spark, args.root, args.keep, args.grace_hours), "handovers": sweep_handovers(spark, args.grace_hours)}))
    else:
        print(json.dumps(publish_outputs(spark, args.src, args.dst, args.table)))
    return 0


if __name__ == "__main__":
    sys.exit(main())
