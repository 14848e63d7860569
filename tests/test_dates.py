"""Date parts: goldens in America/Los_Angeles, independent of the session time zone."""

import datetime as dt

import pytest

from postlytics.functions.timeparts import date_part_columns

CASES = [
    ("1665329035999", dt.datetime(2022, 10, 9, 8, 23, 55), 2022, 10, 9),
    ("1668500000000", dt.datetime(2022, 11, 15, 0, 13, 20), 2022, 11, 15),
    ("-1500", dt.datetime(1969, 12, 31, 15, 59, 59), 1969, 12, 31),
    ("abc", None, None, None, None),
    (None, None, None, None, None),
]


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Europe/Belgrade", "Asia/Tokyo"])
def test_date_parts_do_not_depend_on_session_zone(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, created_at string")
        rows = {r.i: r for r in df.select("i", *[v.alias(k) for k, v in date_part_columns("created_at").items()])
                .collect()}
        for i, (_, ts, y, m, d) in enumerate(CASES):
            r = rows[i]
            assert (r.created_at_date, r.year, r.month, r.dayofmonth) == (ts, y, m, d), (zone, CASES[i])
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_malformed_created_at_is_counted(spark):
    from postlytics.operators.reports import row_counts

    df = spark.createDataFrame([("1",), ("abc",), ("",), (None,)], "created_at string")
    r = row_counts(df).first()
    assert (r.n_rows, r.n_bad_created_at) == (4, 3)


@pytest.mark.parametrize("zone", ["UTC", "Europe/Belgrade", "America/Los_Angeles"])
def test_epoch_ms_of_wall_clock_ignores_session_zone(spark, zone):
    """Includes a wall clock that does not exist in Belgrade (DST gap 2024-03-31 02:30)."""
    from postlytics.functions.timeparts import epoch_ms_of_ntz, epoch_seconds_of_ntz

    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        vals = [dt.datetime(2024, 1, 15, 12, 0, 0, 123456), dt.datetime(2024, 3, 31, 2, 30),
                dt.datetime(2024, 7, 15, 12, 0), dt.datetime(1969, 12, 31, 23, 59, 59, 500000)]
        df = spark.createDataFrame([(v,) for v in vals], "ts timestamp_ntz")
        got = [(r.ms, r.s) for r in df.select(epoch_ms_of_ntz("ts").alias("ms"),
                                              epoch_seconds_of_ntz("ts").alias("s")).collect()]
        epoch = dt.datetime(1970, 1, 1)
        want = [((v - epoch) // dt.timedelta(milliseconds=1), (v - epoch) // dt.timedelta(seconds=1)) for v in vals]
        assert got == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
