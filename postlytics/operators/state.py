"""High-water marks and duplicate removal, as table jobs.

Latest-per-key uses `max_by`, an aggregate with a map-side partial step, rather
than a `row_number` window: a key holding a third of all rows costs one partial
row per task instead of one sorted partition in a single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlytics import config as C


def latest_per_key(log: DataFrame, key: str | list[str], order_col: str,
                   value_cols: list[str]) -> DataFrame:
    """For each key, the values of the row with the largest `order_col`.

    Ties on `order_col` resolve to the larger values (the struct compares them in order).
    """
    keys = [key] if isinstance(key, str) else list(key)
    best = F.max(F.struct(F.col(order_col).alias("_o"), *[F.col(c) for c in value_cols]))
    return (log.groupBy(*keys).agg(best.alias("_b"))
            .select(*keys, F.col(f"_b._o").alias(order_col), *[F.col(f"_b.{c}").alias(c) for c in value_cols]))


def state_with_default(authors: DataFrame, latest: DataFrame, value_col: str, default,
                       key: str = "author_id") -> DataFrame:
    """Every author with its stored value, or the default when it has none."""
    a = authors.select(key).distinct()
    return a.join(latest.select(key, value_col), key, "left") \
        .select(key, F.coalesce(F.col(value_col), F.lit(default)).alias(value_col))


def pull_state(authors: DataFrame, pulled: DataFrame) -> DataFrame:
    """Last pulled id per author (max id of what was pulled); 1 when nothing was."""
    latest = pulled.groupBy("author_id").agg(F.max("tweet_id").alias("last_id"))
    return state_with_default(authors, latest, "last_id", C.PULL_STATE_DEFAULT)


def raw_state(authors: DataFrame, insert_log: DataFrame) -> DataFrame:
    """Id of the newest insert-log row per author; 0 when the author has none."""
    latest = latest_per_key(insert_log, "author_id", "date_time", ["id"]).withColumnRenamed("id", "last_id")
    return state_with_default(authors, latest, "last_id", C.RAW_STATE_DEFAULT)


def processed_state(authors: DataFrame, processed_log: DataFrame) -> DataFrame:
    """File time of the newest processed-log row per author; the epoch when none."""
    latest = latest_per_key(processed_log, "author_id", "date_time", ["file_modified_date"])
    return state_with_default(authors, latest, "file_modified_date",
                              F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


STATE_KINDS = ("pull", "raw", "processed")


def state_of(kind: str, authors: DataFrame, log: DataFrame) -> DataFrame:
    """Dispatch by state table; an unknown table name is an error (not a silent '0')."""
    if kind == "pull":
        return pull_state(authors, log)
    if kind == "raw":
        return raw_state(authors, log)
    if kind == "processed":
        return processed_state(authors, log)
    raise ValueError(f"unknown state table {kind!r}; expected one of {STATE_KINDS}")


def max_id_per_author(df: DataFrame) -> DataFrame:
    return df.groupBy("author_id").agg(F.max("tweet_id").alias("max_id"))


def lookup_state(df: DataFrame, state: DataFrame, value_col: str = "last_id", default=0,
                 key: str = "author_id") -> DataFrame:
    """Attach each row's stored watermark (left join; missing -> default)."""
    return df.join(state.select(key, F.col(value_col).alias("_v")), key, "left") \
        .withColumn(value_col, F.coalesce(F.col("_v"), F.lit(default))).drop("_v")


def above_watermark(df: DataFrame, state: DataFrame, value_col: str = "last_id",
                    key: str = "author_id", id_col: str = "tweet_id") -> DataFrame:
    """Rows whose id is above their author's stored id (checked per row, not only for
    the first row of a batch).  An author without a stored id has no watermark: all
    of its rows are new."""
    j = df.join(state.select(key, F.col(value_col).alias("_v")), key, "left")
    return j.where(F.col("_v").isNull() | (F.col(id_col) > F.col("_v"))).drop("_v")


def not_loaded(incoming: DataFrame, loaded: DataFrame, key: str = "tweet_id") -> DataFrame:
    """Anti-join: rows whose key is not in the loaded table yet."""
    return incoming.join(loaded.select(key), key, "left_anti")


def dedupe_latest(df: DataFrame, key: str = "tweet_id", order_col: str = "load_ts") -> DataFrame:
    """One row per key: the copy with the newest `order_col` (ties: larger values)."""
    others = [c for c in df.columns if c not in (key, order_col)]
    return latest_per_key(df, key, order_col, others).select(*df.columns)
