"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs to completion through the `noop` sink (nothing is collected to
the driver), twice; the faster run is reported (the first run of each also pays
for JIT warm-up and file listing).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from postlytics.registry import QUERIES  # noqa: E402
from postlytics.session import local_session  # noqa: E402

HEADLINE = [
    "agg_daily_sentiment",      # flagship: posts -> clean -> lexicon -> local dates -> daily report
    "prj_clean_text",
    "sentiment_lexicon",
    "sentiment_fit_nb",
    "sentiment_model",
    "top_latest_posts",
    "agg_calendar_sentiment",
    "agg_hashtag_counts",
    "agg_clean_audit",
    "set_dedupe_posts",
    "flt_id_watermark",
    "src_flatten_timeline",
    "src_json_incremental",
    "snk_raw_append",
    "str_ingest",
    "ext_price_asof",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores=cpus, shuffle_partitions=max(8, int(cpus) * 2) if cpus.isdigit() else 16)
    times, cold = {}, {}
    for name in names:
        runs = []
        for _ in range(2):
            t0 = time.perf_counter()
            run(QUERIES[name](spark, sf_dir))
            runs.append(time.perf_counter() - t0)
        cold[name] = round(runs[0], 3)
        times[name] = round(min(runs), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "cold": cold,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
