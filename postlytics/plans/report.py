"""Plan shape of every registered query, from its executed (AQE final) plan.

    python -m postlytics.plans.report /root/testdata/sf0.01 > PLANS.md

Counts per query: shuffles (hash / range / single-partition exchanges), reused
exchanges, broadcast and sort-merge joins, partial aggregates, Python evaluation
nodes, top-k nodes, and whether filters reached a parquet scan.
"""

from __future__ import annotations

import re
import sys

from postlytics.plans.inspect import python_eval_nodes


def final_plan_text(df) -> str:
    """Run the query to the noop sink, then read AQE's final physical plan."""
    df.write.format("noop").mode("overwrite").save()
    qe = df._jdf.queryExecution()  # noqa: SLF001
    return qe.executedPlan().toString()


def shape(plan: str) -> dict[str, int | str]:
    return {
        "hash_shuffles": len(re.findall(r"Exchange hashpartitioning", plan)) - plan.count("ReusedExchange"),
        "range_shuffles": plan.count("Exchange rangepartitioning"),
        "single_partition": plan.count("Exchange SinglePartition"),
        "reused": plan.count("ReusedExchange"),
        "bhj": plan.count("BroadcastHashJoin"),
        "smj": plan.count("SortMergeJoin"),
        "partial_agg": len(re.findall(r"Aggregate\(keys=\[[^\]]*\], functions=\[partial_", plan)),
        "top_k": plan.count("TakeOrderedAndProject"),
        "pushed": "yes" if re.search(r"PushedFilters: \[[^\]]+\]", plan) else "",
    }


def main(sf_dir: str) -> None:
    from postlytics.registry import QUERIES
    from postlytics.session import local_session

    spark = local_session()
    spark.conf.set("spark.sql.adaptive.enabled", "false")   # a stable, complete plan tree to read
    cols = ["hash_shuffles", "range_shuffles", "single_partition", "reused", "bhj", "smj",
            "partial_agg", "top_k", "python", "pushed"]
    print("# Plan shapes\n")
    print(f"Generated by `python -m postlytics.plans.report {sf_dir}` (AQE off so the whole tree "
          "is visible; with AQE on, small shuffled joins become broadcasts at run time).\n")
    print("| query | " + " | ".join(cols) + " |")
    print("|---|" + "---:|" * len(cols))
    for name in sorted(QUERIES):
        df = QUERIES[name](spark, sf_dir)
        s = shape(final_plan_text(df))
        s["python"] = python_eval_nodes(df)
        print(f"| {name} | " + " | ".join(str(s[c]) for c in cols) + " |", flush=True)


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
