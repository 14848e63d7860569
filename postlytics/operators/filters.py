"""Row filters.  Plain predicates so Catalyst can push them into the scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlytics import config as C
from postlytics.functions.text import has_hashtag


def by_author(df: DataFrame, authors, col: str = "author_id") -> DataFrame:
    """One author id, a list of ids, or a table of ids (semi-join)."""
    if isinstance(authors, DataFrame):
        return df.join(authors.select(F.col(authors.columns[0]).alias(col)).distinct(), col, "left_semi")
    if isinstance(authors, (list, tuple, set)):
        return df.where(F.col(col).isin(list(authors)))
    return df.where(F.col(col) == F.lit(authors))


def _value(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def since_id(df: DataFrame, since: int | Column, col: str = "tweet_id") -> DataFrame:
    """Rows with a larger id; `since` may be a scalar subquery."""
    return df.where(F.col(col) > _value(since))


def time_range(df: DataFrame, start, end, col: str) -> DataFrame:
    """Half-open [start, end)."""
    c = F.col(col)
    return df.where((c >= _value(start)) & (c < _value(end)))


def hashtag(df: DataFrame, tag: str, text_col: str = "text") -> DataFrame:
    return df.where(has_hashtag(text_col, tag))


def day_in(df: DataFrame, days: list[int] | None = None, col: str = "dayofmonth") -> DataFrame:
    return df.where(F.col(col).isin(C.REPORT_DAYS if days is None else days))
