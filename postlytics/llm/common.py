"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
import sys
import types
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlytics.session import scratch_path

WORKER_CACHE = "_postlytics_worker_cache"


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, found by exact name and position.

    Other columns are left out, so one that is named like an output, or differs from a
    wanted one in case only, cannot clash.  A missing name raises ValueError.
    """
    at: dict[str, int] = {}
    for i, c in enumerate(df.columns):
        at.setdefault(c, i)
    missing = [n for n in names if n not in at]
    if missing:
        raise ValueError(f"missing columns {missing}; there are {df.columns}")
    safe = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return safe.select(*[F.col(f"c{at[n]}").alias(n) for n in names])


def numbered(df: DataFrame, *names: str) -> tuple[DataFrame, dict[str, str]]:
    """df with its columns named __0, __1, ... by position, and the new name of each wanted one.

    Found as by `pick`, so a stage can carry all columns of a table, whatever they are called,
    beside helpers of its own; `restored` names them as before.
    """
    pick(df, *names)
    at = {n: f"__{df.columns.index(n)}" for n in names}
    return df.toDF(*[f"__{i}" for i in range(len(df.columns))]), at


def restored(df: DataFrame, like: DataFrame) -> DataFrame:
    """The columns __0, __1, ... of df under the names and in the order of `like`."""
    return df.select(*[f"__{i}" for i in range(len(like.columns))]).toDF(*like.columns)


BLANK = re.compile(r"\s")


def chunks(text: str, size: int) -> Iterator[str]:
    """The text in parts of some `size` characters that end with white space."""
    i = 0
    while i < len(text):
        end = BLANK.search(text, i + size)
        j = end.end() if end else len(text)
        yield text[i:j]
        i = j


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows written as Parquet in the shared folder and read again: lineage ends there.

    A lost executor costs at most the tasks that run, never what is already written.  The
    shuffle files behind the rows are removed as the write ends, so disk holds one step's.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def worker_cache() -> dict:
    """A dict that lives as long as the Python worker process, shared by the tasks it runs.

    The package's functions travel to the workers by value, so their own module globals
    are fresh in each task; a loaded tokenizer is kept here instead.
    """
    module = sys.modules.get(WORKER_CACHE)
    if module is None:
        module = sys.modules[WORKER_CACHE] = types.ModuleType(WORKER_CACHE)
        module.cache = {}
    return module.cache
