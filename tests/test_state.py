"""Watermarks, defaults and duplicate removal."""

import datetime as dt

from postlytics.operators import state

T = dt.datetime


def test_defaults_for_unknown_authors(spark):
    authors = spark.createDataFrame([(1,), (2,)], "author_id long")
    log = spark.createDataFrame([(1, 5, T(2024, 1, 2)), (1, 9, T(2024, 1, 1))],
                                "author_id long, id long, date_time timestamp_ntz")
    raw = {r.author_id: r.last_id for r in state.raw_state(authors, log).collect()}
    assert raw == {1: 5, 2: 0}                        # newest log row wins, not the largest id
    pulled = spark.createDataFrame([(1, 7)], "author_id long, tweet_id long")
    assert {r.author_id: r.last_id for r in state.pull_state(authors, pulled).collect()} == {1: 7, 2: 1}
    plog = spark.createDataFrame([(1, T(2024, 1, 3), T(2024, 1, 4))],
                                 "author_id long, file_modified_date timestamp_ntz, date_time timestamp_ntz")
    got = {r.author_id: r.file_modified_date for r in state.processed_state(authors, plog).collect()}
    assert got == {1: T(2024, 1, 3), 2: T(1970, 1, 1)}


def test_watermark_is_checked_per_row(spark):
    posts = spark.createDataFrame([(1, 4), (1, 6), (2, 1), (3, 2)], "author_id long, tweet_id long")
    st = spark.createDataFrame([(1, 5), (2, 1)], "author_id long, last_id long")
    got = sorted((r.author_id, r.tweet_id) for r in state.above_watermark(posts, st).collect())
    assert got == [(1, 6), (3, 2)]


def test_dedupe_keeps_newest_copy(spark):
    df = spark.createDataFrame([(1, 10, 1), (1, 11, 2), (2, 5, 1)], "tweet_id long, likes int, load_ts int")
    got = sorted((r.tweet_id, r.likes) for r in state.dedupe_latest(df).collect())
    assert got == [(1, 11), (2, 5)]


def test_latest_per_key_is_an_aggregate_not_a_window(spark):
    from postlytics.plans.inspect import plan_text

    df = spark.createDataFrame([(1, 1, 1)], "author_id long, id long, date_time long")
    text = plan_text(state.latest_per_key(df, "author_id", "date_time", ["id"]), "simple")
    assert "Window" not in text and "partial_max" in text


def test_unknown_state_table_raises(spark):
    import pytest

    a = spark.createDataFrame([(1,)], "author_id long")
    with pytest.raises(ValueError):
        state.state_of("insert_log_typo", a, a)


def test_marker_text_parses(spark):
    from postlytics.functions.timeparts import epoch_seconds_of_ntz, parse_timestamp_text

    df = spark.createDataFrame([("2022-10-31 16:48:57",), ("bad",)], "t string")
    rows = df.select(parse_timestamp_text("t").alias("ts")).select("ts", epoch_seconds_of_ntz("ts").alias("s")).collect()
    assert rows[0].ts == T(2022, 10, 31, 16, 48, 57) and rows[0].s == 1667234937
    assert rows[1].ts is None


def test_fixture_logs_have_the_state_schemas(spark):
    from conftest import SF001
    from postlytics.schema import ID_LOG_SCHEMA, PROCESSED_LOG_SCHEMA
    from postlytics.sources import fixtures

    p = fixtures.posts(spark, SF001)
    strip = lambda sc: [(f.name, f.dataType) for f in sc.fields]
    assert strip(fixtures.insert_log(p, "2024-01-15").schema) == strip(ID_LOG_SCHEMA)
    assert strip(fixtures.processed_log(p, "2024-01-15").schema) == strip(PROCESSED_LOG_SCHEMA)
