"""Goals of the reference that have no code there: many authors, tickers, prices.

`price_asof` is for daily prices, `price_asof_ticks` for ticks of any rate.  The first avoids a range join and a window over all posts of a symbol: the
(small) price series is turned into validity intervals with one window per
symbol over the *prices*, the intervals are cut into day buckets, and posts are
equi-joined on (symbol, day) before a range check.  Every post stays in its own
partition; a hot symbol spreads over its days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlytics import config as C
from postlytics.functions.text import extract_tickers
from postlytics.functions.timeparts import epoch_seconds_of_ntz
from postlytics.operators.reports import polarity  # noqa: F401  (signed score, used with mentions)


def ticker_mentions(post_rows: DataFrame, aliases: DataFrame, text_col: str = "text",
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per (post, mentioned asset): `$SYMBOL` in the raw text, resolved by alias.

    `keep` carries further post columns along, so callers never join the mentions
    back to the posts they came from.  Posts without a symbol go first, so that what the caller
    computes for `keep` is computed for the others alone.
    """
    post_rows = post_rows.where(F.regexp_like(F.col(text_col), F.lit(C.TICKER_PATTERN)))
    m = post_rows.select("tweet_id", "author_id", *keep,
                         F.explode(F.array_distinct(extract_tickers(text_col))).alias("symbol"))
    return m.join(aliases.select("symbol", "asset_id"), "symbol", "inner")


def price_asof(events: DataFrame, prices: DataFrame, ts_col: str = "ts",
               price_ts_col: str = "price_date", key: str = "symbol") -> DataFrame:
    """For each event row, the last price of its symbol at or before its time.

    Rows without an earlier price get null (left semantics).  `prices` is one row
    per (symbol, price time).
    """
    w = Window.partitionBy(key).orderBy("_from")
    intervals = (prices.select(key, F.col(price_ts_col).cast("timestamp_ntz").alias("_from"), "price")
                 .withColumn("_to", F.lead("_from").over(w)))
    # one bucket per day a closed interval touches; the newest interval of a symbol is open-ended
    # and is one row per symbol, so the events are read once and no newest day is needed
    closed = intervals.where(F.col("_to").isNotNull())
    buckets = closed.withColumn("_day", F.explode(F.sequence(F.to_date("_from"), F.to_date("_to"))))
    newest = intervals.where(F.col("_to").isNull()).select(
        F.col(key).alias("_symbol"), F.col("_from").alias("_open_from"), F.col("price").alias("_open_price"))
    ev = events.withColumn("_ts", F.col(ts_col).cast("timestamp_ntz")).withColumn("_day", F.to_date("_ts"))
    cond = [ev[key] == buckets[key], ev["_day"] == buckets["_day"],
            ev["_ts"] >= buckets["_from"], ev["_ts"] < buckets["_to"]]
    out = ev.join(buckets, cond, "left").join(newest, ev[key] == newest["_symbol"], "left")
    is_open = F.col("_open_from") <= ev["_ts"]
    return out.select(*[ev[c] for c in events.columns],
                      F.when(is_open, F.col("_open_from")).otherwise(buckets["_from"]).alias("price_time"),
                      F.when(is_open, F.col("_open_price")).otherwise(buckets["price"]).alias("price"))


def _bucket(ts, seconds: int):
    return F.floor(epoch_seconds_of_ntz(ts) / F.lit(seconds)).cast("bigint")


def price_asof_ticks(events: DataFrame, ticks: DataFrame, ts_col: str = "ts", price_ts_col: str = "price_time",
                     key: str = "symbol", bucket_seconds: int = 3600, slot_rows: int = 1 << 18) -> DataFrame:
    """For each event row, the last tick of its symbol at or before its time: `price_time`, `price`.

    An as-of merge: events and ticks lie in one ordered union per (symbol, time bucket), where a
    running last value gives each event the newest tick of its bucket; the last tick of each
    bucket is carried to later ones by a window over one row a bucket.  No pair of an event and a
    tick is ever made, and a hot symbol is spread over its buckets.  A bucket with more than
    `slot_rows` events is dealt over slots, each with all ticks of the bucket; any width and any
    `slot_rows` give the same result.

    Events without an earlier tick, a symbol or a time get nulls and stay.  Ticks without a
    symbol, time or price are no ticks; of ticks at one time the largest price counts.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in events.columns])
    ev = events.select(row.alias("row"), F.col(key).alias("k"), F.col(ts_col).cast("timestamp_ntz").alias("ts"))
    px = (ticks.select(F.col(key).alias("k"), F.col(price_ts_col).cast("timestamp_ntz").alias("ts"), F.col("price").alias("p"))
          .where("k is not null and ts is not null and p is not null"))
    timed, bare = ev.where("k is not null and ts is not null"), ev.where("k is null or ts is null")
    timed, px = (d.withColumn("b", _bucket(F.col("ts"), bucket_seconds)) for d in (timed, px))
    # one row a bucket: its last tick, how many slots its events need, and the last tick before it
    per = (timed.groupBy("k", "b").agg(F.count(F.lit(1)).alias("n")).withColumn("last", F.lit(None).cast(
               f"struct<ts:timestamp_ntz,p:{dict(px.dtypes)['p']}>"))
           .unionByName(px.groupBy("k", "b").agg(F.max(F.struct("ts", "p")).alias("last")).withColumn("n", F.lit(0).cast("long")))
           .groupBy("k", "b").agg(F.sum("n").alias("n"), F.max("last").alias("last")))
    earlier = Window.partitionBy("k").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("k", "b", F.last("last", ignorenulls=True).over(earlier).alias("carried"),
                     F.ceil(F.col("n") / F.lit(slot_rows)).cast("int").alias("slots"))
    per = per.where("slots > 0")                           # buckets with events
    timed = timed.join(per, ["k", "b"]).withColumn("slot", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("slots")).cast("int"))
    dealt = px.join(per.select("k", "b", "slots"), ["k", "b"]) \
        .withColumn("slot", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)))
    both = timed.select("k", "b", "slot", "ts", "row", "carried", F.lit(None).cast(dict(px.dtypes)["p"]).alias("p"), F.lit(1).alias("side")) \
        .unionByName(dealt.select("k", "b", "slot", "ts", "p", F.lit(0).alias("side")), allowMissingColumns=True)
    upto = Window.partitionBy("k", "b", "slot").orderBy("ts", "side", "p").rowsBetween(Window.unboundedPreceding, 0)
    tick = F.when(F.col("side") == 0, F.struct("ts", "p"))
    merged = both.withColumn("seen", F.last(tick, ignorenulls=True).over(upto)).where("side = 1")
    found = F.coalesce("seen", "carried")
    out = merged.select("row.*", found["ts"].alias("price_time"), found["p"].alias("price"))
    return out.unionByName(bare.select("row.*", F.lit(None).cast("timestamp_ntz").alias("price_time"),
                                       F.lit(None).cast(dict(px.dtypes)["p"]).alias("price")))


def sentiment_price_corr(enriched_mentions: DataFrame, prices: DataFrame) -> DataFrame:
    """Per symbol: Pearson correlation of daily mean polarity and daily price.

    `enriched_mentions`: symbol, created_at_date, polarity.  Days are local days.
    """
    daily = (enriched_mentions.groupBy("symbol", F.to_date("created_at_date").alias("day"))
             .agg(F.avg("polarity").alias("polarity"), F.count(F.lit(1)).alias("posts")))
    px = prices.select("symbol", F.col("price_date").alias("day"), "price")
    j = daily.join(px, ["symbol", "day"], "inner")
    return j.groupBy("symbol").agg(F.corr("polarity", "price").alias("corr"),
                                   F.count(F.lit(1)).alias("days"))

