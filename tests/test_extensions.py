"""As-of join against brute force, ticker mentions carrying their columns."""

import datetime as dt
import random

import pytest

from postlytics.operators import extensions

D, T = dt.date, dt.datetime


def test_price_asof_equals_brute_force(spark):
    rng = random.Random(3)
    days = [D(2024, 1, 1) + dt.timedelta(days=i) for i in range(40)]
    prices = [(s, d, float(rng.randint(1, 99))) for s in ("A", "B") for d in days if rng.random() < 0.35]
    events = [(i, rng.choice("ABC"), T(2023, 12, 30) + dt.timedelta(hours=rng.randint(0, 24 * 45)))
              for i in range(300)]
    events += [(1000, "A", T.combine(prices[0][1], dt.time())), (1001, "B", T(2024, 2, 9, 23, 59))]
    ev = spark.createDataFrame(events, "id long, symbol string, ts timestamp_ntz")
    px = spark.createDataFrame(prices, "symbol string, price_date date, price double")
    got = {r.id: (r.price_time, r.price) for r in extensions.price_asof(ev, px).collect()}
    for i, sym, ts in events:
        earlier = [(T.combine(d, dt.time()), p) for s, d, p in prices if s == sym and T.combine(d, dt.time()) <= ts]
        want = max(earlier) if earlier else (None, None)
        assert got[i] == want, (i, sym, ts)
    assert len(got) == len(events)                       # left semantics: every event kept once


def test_mentions_carry_columns(spark):
    posts = spark.createDataFrame([(1, 7, "buy $P1 and $P2 $P1", 0.5), (2, 8, "no ticker", 0.1)],
                                  "tweet_id long, author_id long, text string, polarity double")
    aliases = spark.createDataFrame([("P1", 1), ("P2", 2)], "symbol string, asset_id int")
    got = sorted(tuple(r) for r in extensions.ticker_mentions(posts, aliases, keep=("polarity",))
                 .select("tweet_id", "symbol", "asset_id", "polarity").collect())
    assert got == [(1, "P1", 1, 0.5), (1, "P2", 2, 0.5)]


@pytest.mark.parametrize("bucket_seconds, slot_rows", [(3600, 1 << 18), (60, 3), (1_000_000_000, 5)])
def test_price_asof_ticks_equals_brute_force(spark, bucket_seconds, slot_rows):
    """Ties, empty buckets, a hot symbol, nulls on both sides; the same for any bucket and slot."""
    rng = random.Random(7)
    start = T(2024, 1, 1)
    at = lambda: start + dt.timedelta(seconds=rng.choice([rng.randint(0, 50), rng.randint(0, 200_000)]))
    ticks = [(rng.choice("AAAAB"), at(), float(rng.randint(1, 99))) for _ in range(200)]
    ticks += [("A", ticks[0][1], 100.0), (None, at(), 1.0), ("A", None, 1.0), ("B", at(), None)]
    events = [(i, rng.choice("AAAABC"), at()) for i in range(300)] + [(900, None, at()), (901, "A", None), (902, "A", ticks[0][1]),
                                                                     (902, "A", ticks[0][1]), (903, "A", start - dt.timedelta(days=400))]
    ev = spark.createDataFrame(events, "id long, symbol string, ts timestamp_ntz")
    px = spark.createDataFrame(ticks, "symbol string, price_time timestamp_ntz, price double")
    got = extensions.price_asof_ticks(ev, px, bucket_seconds=bucket_seconds, slot_rows=slot_rows)
    assert got.columns == ["id", "symbol", "ts", "price_time", "price"]
    want = []
    for i, sym, ts in events:
        earlier = [(t, p) for s, t, p in ticks if None not in (s, t, p, sym, ts) and s == sym and t <= ts]
        want.append((i, sym, ts, *(max(earlier) if earlier else (None, None))))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_price_asof_ticks_makes_no_pairs(spark):
    """Joins are on (symbol, bucket) with one row a bucket; ticks and events meet in a union."""
    ev = spark.range(100).selectExpr("id", "'A' symbol", "timestamp_ntz'2024-01-01 00:00:00' ts")
    px = spark.range(100).selectExpr("'A' symbol", "timestamp_ntz'2024-01-01 00:00:00' price_time", "double(id) price")
    out = extensions.price_asof_ticks(ev, px)
    assert [r.price for r in out.select("price").distinct().collect()] == [99.0] and out.count() == 100
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in plan and "Cartesian" not in plan and plan.count("Join Inner") == 2


def test_price_asof_ticks_on_empty_tables(spark):
    ev = spark.createDataFrame([(1, "A", T(2024, 1, 1))], "id long, symbol string, ts timestamp_ntz")
    px = spark.createDataFrame([], "symbol string, price_time timestamp_ntz, price double")
    assert [tuple(r) for r in extensions.price_asof_ticks(ev, px).collect()] == [(1, "A", T(2024, 1, 1), None, None)]
    assert extensions.price_asof_ticks(ev.limit(0), px).count() == 0
