"""Command line for the batch entry points.

python -m touchline init   --raw RAW --root ROOT [--run-date YYYY-MM-DD]
python -m touchline update --raw RAW --root ROOT [--run-date YYYY-MM-DD]
python -m touchline update-day --raw RAW --root ROOT --day YYYYMMDD
python -m touchline vacuum --root ROOT [--keep-versions N]

Runs on the session the environment provides (spark-submit / master from
the Spark configuration); the run date defaults to today (UTC).
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from touchline.functions.dates import LOOKBACK_SECONDS
from touchline.operators.events import LARGE_GROUP
from touchline.operators.traffic import LARGE_USER
from touchline.plans.reporting import init, update, update_day
from touchline.session import RECOMMENDED_CONF
from touchline.sources.sinks import vacuum


def main(argv=None) -> int:
    parser = argparse.ArgumentParser(prog="touchline")
    parser.add_argument("command", choices=["init", "update", "update-day", "vacuum"])
    parser.add_argument("--raw", default=None, help="root of the day-partitioned raw export")
    parser.add_argument("--root", required=True, help="folder of the four reporting tables")
    parser.add_argument("--run-date", default=None)
    parser.add_argument("--day", default=None, help="shard to load (update-day)")
    parser.add_argument("--lookback-seconds", type=int, default=LOOKBACK_SECONDS)
    parser.add_argument("--strict", action="store_true", help="fail on a param key that an event has twice")
    parser.add_argument("--extra-param", action="append", default=[], metavar="NAME:KIND",
                        help="further event param for the events table; KIND is string, int or float")
    parser.add_argument("--large-group", type=int, default=LARGE_GROUP,
                        help="(user, session) groups of more events than this are split")
    parser.add_argument("--large-user", type=int, default=LARGE_USER,
                        help="users of more sessions than this are split for the lookback")
    parser.add_argument("--layout", choices=["auto", "partition", "suffix"], default="auto",
                        help="event_date=YYYYMMDD or events_YYYYMMDD folders")
    parser.add_argument("--fail-on-bad-input", action="store_true",
                        help="publish nothing if timestamps are missing or dates differ from their shard")
    parser.add_argument("--keep-versions", type=int, default=2, help="versions that vacuum leaves")
    args = parser.parse_args(argv)
    if args.command != "vacuum" and not args.raw:
        parser.error(f"{args.command} needs --raw")

    builder = SparkSession.builder.appName(f"touchline-{args.command}")
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    options = {"strict": args.strict, "extra_params": dict(p.rsplit(":", 1) for p in args.extra_param),
               "large_group": args.large_group, "large_user": args.large_user, "layout": args.layout,
               "fail_on_bad_input": args.fail_on_bad_input}
    if args.command == "vacuum":
        vacuum(spark, args.root, args.keep_versions)
        return 0
    if args.command == "init":
        paths = init(spark, args.raw, args.root, args.run_date, args.lookback_seconds, **options)
    elif args.command == "update":
        paths = update(spark, args.raw, args.root, args.run_date, args.lookback_seconds, **options)
    else:
        if not args.day:
            parser.error("update-day needs --day")
        paths = update_day(spark, args.raw, args.root, args.day, lookback_seconds=args.lookback_seconds, **options)
    print(json.dumps(paths.checks))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
