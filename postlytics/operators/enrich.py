"""The transform: clean text, sentiment label and score, local calendar columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from postlytics import config as C
from postlytics.functions.text import clean_text
from postlytics.functions.timeparts import date_part_columns


def add_clean_text(df: DataFrame, text_col: str = "text", out: str = "cleaned_tweet_text") -> DataFrame:
    return df.withColumn(out, clean_text(text_col))


def add_date_parts(df: DataFrame, created_col: str = "created_at",
                   zone: str = C.LOCAL_TIME_ZONE, drop_source: bool = True) -> DataFrame:
    """created_at (text of epoch ms) -> created_at_date (local NTZ), year, month, dayofmonth."""
    out = df.withColumns(date_part_columns(created_col, zone))
    return out.drop(created_col) if drop_source else out


def enrich(posts: DataFrame, scorer: Callable[[DataFrame], DataFrame] | None = None,
           zone: str = C.LOCAL_TIME_ZONE) -> DataFrame:
    """posts -> enriched posts (the reference's transform, session-zone free)."""
    from postlytics.operators.sentiment import score_lexicon

    scorer = scorer or score_lexicon
    return add_date_parts(scorer(add_clean_text(posts)), zone=zone)
