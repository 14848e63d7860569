"""Plan inspection: the formatted physical plan and simple structural checks."""

from __future__ import annotations

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    return df._jdf.queryExecution().explainString(  # noqa: SLF001 - same text as df.explain
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode))


def python_eval_nodes(df: DataFrame) -> int:
    text = plan_text(df, "simple")
    return sum(text.count(node) for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas",
                                              "FlatMapGroupsInPandas"))


def shuffle_count(df: DataFrame) -> int:
    return plan_text(df, "simple").count("Exchange hashpartitioning")
