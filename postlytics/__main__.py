"""Command line for the three jobs.

    spark-submit postlytics/__main__.py ingest    --pages P --raw R --state S --quarantine Q
    spark-submit postlytics/__main__.py transform --landing L --silver S --processed P [--author A] [--nb-model M]
    spark-submit postlytics/__main__.py report    --silver S [--days 15,14,13,12,11,10,9] [--latest 20]

(with the package shipped, e.g. `--py-files postlytics.zip`; locally `python -m
postlytics ...` works too).  The session comes from `spark-submit` (master,
executors, `spark.checkpoint.dir`); nothing here sets a master.  `report` shows
the daily series and the latest posts.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from postlytics import config as C
from postlytics.operators import sentiment
from postlytics.plans import jobs


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="postlytics")
    sub = ap.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("ingest", help="landed API pages -> raw table, quarantine and pull state")
    a.add_argument("--pages", required=True)
    a.add_argument("--raw", required=True)
    a.add_argument("--state", required=True)
    a.add_argument("--quarantine", required=True)
    t = sub.add_parser("transform", help="new landed files -> enriched table (+ processed-file log)")
    t.add_argument("--landing", required=True)
    t.add_argument("--silver", required=True)
    t.add_argument("--processed", required=True)
    t.add_argument("--author", type=int, default=None)
    t.add_argument("--nb-model", default=None, help="stored naive-Bayes model (default: word weights)")
    r = sub.add_parser("report", help="daily counts and scores, latest posts")
    r.add_argument("--silver", required=True)
    r.add_argument("--days", default=",".join(str(d) for d in C.REPORT_DAYS))
    r.add_argument("--latest", type=int, default=C.LATEST_POSTS_LIMIT)
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName(f"postlytics-{args.cmd}").getOrCreate()
    if args.cmd == "ingest":
        jobs.ingest_pages(spark, args.pages, args.raw, args.state, args.quarantine)
    elif args.cmd == "transform":
        scorer = sentiment.naive_bayes_scorer(spark, args.nb_model) if args.nb_model else None
        print(json.dumps(jobs.transform(spark, args.landing, args.silver, args.processed,
                                        scorer=scorer, author=args.author)))
    else:
        days = [int(d) for d in args.days.split(",") if d]
        jobs.daily_report(spark, args.silver, days).show(len(days), truncate=False)
        jobs.latest_report(spark, args.silver, args.latest).show(args.latest, truncate=80)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
