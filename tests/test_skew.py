"""One key holding a third of all rows: results stay exact, hot groups are pre-aggregated or split."""

import pytest
from pyspark.sql import functions as F

from postlytics.operators import reports, state
from postlytics.plans.inspect import plan_text

N = 30_000


@pytest.fixture()
def skewed_conf(spark):
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    }
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _posts(spark):
    # author 7 writes a third of all posts; the rest spread over 300 authors
    return spark.range(N).select(
        F.col("id").alias("tweet_id"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 300 + 1000).alias("author_id"),
        F.when(F.col("id") % 3 == 0, F.lit("#hot #xy")).otherwise(F.lit("#cold")).alias("text"))


def test_hot_author_watermark_and_lookup(spark, skewed_conf):
    p = _posts(spark)
    st = p.groupBy("author_id").agg((F.max("tweet_id") - 300).alias("last_id"))
    got = state.above_watermark(p, st)
    want = p.join(st, "author_id").where(F.col("tweet_id") > F.col("last_id")).count()
    assert got.count() == want
    hot = got.where(F.col("author_id") == 7).count()
    assert hot == 100                                        # every 3rd id in the last 300 of author 7


def test_hot_key_copies_dedupe(spark, skewed_conf):
    # a third of the rows are copies of one tweet id, each with its own load time
    rows = spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("tweet_id"),
        F.col("id").alias("load_ts"), (F.col("id") * 2).alias("likes"))
    out = state.dedupe_latest(rows, "tweet_id", "load_ts")
    text = plan_text(out, "simple")
    assert "partial_max" in text                             # copies collapse map-side
    got = {r.tweet_id: (r.load_ts, r.likes) for r in out.collect()}
    assert len(got) == N - N // 3                           # the ids not divisible by 3 (1 among them)
    assert got[1] == (N - 3, 2 * (N - 3))


def test_hot_tag_counts(spark, skewed_conf):
    out = {r.hashtag: r.n for r in reports.hashtag_counts(_posts(spark)).collect()}
    assert out == {"#hot": N // 3, "#xy": N // 3, "#cold": N - N // 3}
