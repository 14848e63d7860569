"""Report shapes and plans on the smoke tables."""

import datetime as dt


from postlytics.operators import reports
from postlytics.operators.enrich import enrich
from postlytics.plans.inspect import plan_text
from postlytics.sources import fixtures

from conftest import SF001


def test_flagship_daily_report(spark):
    import __spark_entry__ as E

    rows = E.entry(spark).collect()
    assert [r.dayofmonth for r in rows] == [9, 10, 11, 12, 13, 14, 15]
    assert all(r.total_count > 0 and 0 < r.avg_sentiment <= 1 for r in rows)


def test_latest_posts_is_top_k_and_numbered_after(spark):
    p = fixtures.posts(spark, SF001)
    top = reports.latest_posts_of_posts(p, enrich)
    assert "TakeOrderedAndProject" in plan_text(top, "simple")
    full = reports.latest_posts(enrich(p))
    assert [r.tweet_id for r in top.collect()] == [r.tweet_id for r in full.collect()]
    numbered = reports.numbered_latest(top).collect()
    assert [r.row_no for r in numbered] == list(range(1, 21))
    assert numbered[0].created_at_date >= numbered[-1].created_at_date


def test_spine_fills_empty_days(spark):
    e = enrich(fixtures.posts(spark, SF001))
    spine = reports.calendar_spine(e, days_back=40).collect()
    assert len(spine) == 40
    days = [r.day for r in spine]
    assert days == sorted(days) and days[-1] - days[0] == dt.timedelta(days=39)
    assert any(r.total_count == 0 and r.avg_sentiment is None for r in spine)


def test_series_is_aligned(spark):
    d = reports.daily_sentiment(enrich(fixtures.posts(spark, SF001)))
    r = reports.series(d).first()
    assert r.labels == [9, 10, 11, 12, 13, 14, 15]
    assert len(r.averages) == len(r.counts) == 7


def test_author_filter_reaches_the_scan(spark):
    from postlytics.operators.filters import by_author

    text = plan_text(by_author(fixtures.posts(spark, SF001), 7), "formatted")
    assert "EqualTo(user_id,7)" in text
