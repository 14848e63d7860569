"""Text column functions: cleaning rules, token and tag extraction.

All of them are `Column -> Column` built from native regular expressions, so
they stay inside whole-stage code generation and collapse into one projection.
Null in gives null out.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlytics import config as C


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def remove_links(text: Column | str) -> Column:
    """Drop `http` plus every following non-blank character (case-sensitive)."""
    return F.regexp_replace(_col(text), C.LINK_PATTERN, "")


def remove_users(text: Column | str) -> Column:
    """Drop 'RT @handle' first, then any remaining '@handle'."""
    once = F.regexp_replace(_col(text), C.RETWEET_PATTERN, "")
    return F.regexp_replace(once, C.HANDLE_PATTERN, "")


def remove_punctuation(text: Column | str) -> Column:
    """Replace each run of the punctuation set with one blank."""
    return F.regexp_replace(_col(text), C.PUNCTUATION_PATTERN, " ")


def remove_hashtags(text: Column | str) -> Column:
    return F.regexp_replace(_col(text), C.HASHTAG_PATTERN, "")


def clean_text(text: Column | str) -> Column:
    """The cleaning chain in its fixed order: links, users, punctuation, hashtags."""
    return remove_hashtags(remove_punctuation(remove_users(remove_links(text))))


def extract_hashtags(text: Column | str) -> Column:
    """All hashtags of the raw text, in order, as array<string>."""
    return F.regexp_extract_all(_col(text), F.lit(C.HASHTAG_PATTERN), F.lit(0))


def extract_mentions(text: Column | str) -> Column:
    return F.regexp_extract_all(_col(text), F.lit(C.HANDLE_PATTERN), F.lit(0))


def extract_tickers(text: Column | str) -> Column:
    """Ticker symbols (without '$') of the raw text; cleaning deletes the '$'."""
    return F.regexp_extract_all(_col(text), F.lit(C.TICKER_PATTERN), F.lit(1))


def count_matches(text: Column | str, pattern: str) -> Column:
    return F.regexp_count(_col(text), F.lit(pattern))


def tokens(text: Column | str) -> Column:
    """Lower-case letter tokens: non-letters become one blank, split on one blank.

    Empty strings (from leading or trailing blanks) are kept, as a plain split
    would; they never match a word weight.
    """
    return F.split(F.lower(F.regexp_replace(_col(text), C.TOKEN_NON_LETTERS, " ")), " ")


def letter_runs(text: Column | str) -> Column:
    """The maximal runs of ASCII letters, in order (the non-empty tokens, not yet lower-cased)."""
    return F.regexp_extract_all(_col(text), F.lit("[A-Za-z]+"), F.lit(0))


def has_hashtag(text: Column | str, tag: str) -> Column:
    """True when the raw text carries exactly this hashtag (case-sensitive)."""
    return F.array_contains(extract_hashtags(text), F.lit(tag))
