"""Filters: author (one id, a list, a table), since id, half-open time range, hashtag, days."""

import datetime as dt

from postlytics.operators import filters, reports

T = dt.datetime


def _posts(spark):
    return spark.createDataFrame(
        [(1, 10, "a #tag_x", T(2024, 1, 1, 0, 0), 9), (2, 11, "#tagx b", T(2024, 1, 1, 12, 0), 10),
         (3, 12, "#TAG_x", T(2024, 1, 2, 0, 0), 15), (4, 10, "none", T(2023, 12, 31, 23, 59, 59), 16)],
        "tweet_id long, author_id long, text string, ts timestamp_ntz, dayofmonth int")


def _ids(df):
    return sorted(r.tweet_id for r in df.collect())


def test_author_forms(spark):
    p = _posts(spark)
    assert _ids(filters.by_author(p, 10)) == [1, 4]
    assert _ids(filters.by_author(p, [10, 12])) == [1, 3, 4]
    table = spark.createDataFrame([(11,), (11,), (12,)], "author_id long")
    assert _ids(filters.by_author(p, table)) == [2, 3]


def test_since_and_half_open_range(spark):
    p = _posts(spark)
    assert _ids(filters.since_id(p, 2)) == [3, 4]
    got = filters.time_range(p, T(2024, 1, 1, 0, 0), T(2024, 1, 2, 0, 0), "ts")
    assert _ids(got) == [1, 2]                       # start kept, end excluded


def test_hashtag_is_exact_and_case_sensitive(spark):
    assert _ids(filters.hashtag(_posts(spark), "#tag_x")) == [1]


def test_report_days(spark):
    assert _ids(filters.day_in(_posts(spark))) == [1, 2, 3]


def test_spine_with_explicit_end(spark):
    e = spark.createDataFrame([(T(2024, 1, 3, 5), 0.5), (T(2024, 1, 3, 6), 1.0)],
                              "created_at_date timestamp_ntz, sentiment_score double")
    rows = reports.calendar_spine(e, days_back=3, end_date="2024-01-04").collect()
    assert [(r.day, r.total_count) for r in rows] == [
        (dt.date(2024, 1, 2), 0), (dt.date(2024, 1, 3), 2), (dt.date(2024, 1, 4), 0)]
    assert rows[1].avg_sentiment == 0.75
