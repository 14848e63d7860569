"""Streams: complete mode equals the batch report; append mode emits the closed days, equal to batch."""

from pyspark.sql import functions as F

from postlytics.operators.enrich import enrich
from postlytics.registry import _land_batches
from postlytics.session import scratch_path
from postlytics.sources import fixtures
from postlytics.streaming import jobs

from conftest import SF001


def _batch_daily(spark):
    e = enrich(fixtures.posts(spark, SF001))
    return {r.day: (r.n, round(r.a, 9)) for r in
            e.groupBy(F.to_date("created_at_date").alias("day"))
             .agg(F.count(F.lit(1)).alias("n"), F.avg("sentiment_score").alias("a")).collect()}


def test_complete_mode_equals_batch(spark):
    root = _land_batches(spark, SF001, overlapping=False)
    target, ckpt = scratch_path(spark, "t_daily"), scratch_path(spark, "t_ckpt")
    jobs.daily_sentiment_stream(spark, root, target, ckpt, mode="complete", max_files_per_trigger=50)
    got = {r.day: (r.total_count, round(r.avg_sentiment, 9)) for r in spark.read.parquet(target).collect()}
    assert got == _batch_daily(spark)


def test_append_mode_emits_closed_days_equal_to_batch(spark):
    root = _land_batches(spark, SF001, overlapping=False)
    target, ckpt = scratch_path(spark, "t_daily"), scratch_path(spark, "t_ckpt")
    jobs.daily_sentiment_stream(spark, root, target, ckpt, mode="append", watermark="2 days",
                                max_files_per_trigger=50)
    got = {r.day: (r.total_count, round(r.avg_sentiment, 9)) for r in spark.read.parquet(target).collect()}
    batch = _batch_daily(spark)
    assert got and set(got) < set(batch)
    assert all(batch[d] == v for d, v in got.items())
    newest = max(batch)
    assert all((newest - d).days >= 2 for d in got)     # only days the watermark has closed


def test_ingest_stream_rerun_is_idempotent(spark):
    root = _land_batches(spark, SF001)
    target, ckpt = scratch_path(spark, "t_raw"), scratch_path(spark, "t_ckpt")
    jobs.ingest_stream(spark, root, target, ckpt, max_files_per_trigger=40)
    first = spark.read.parquet(target).count()
    jobs.ingest_stream(spark, root, target, ckpt)                    # nothing new
    jobs.ingest_stream(spark, root, target, scratch_path(spark, "t_ckpt2"))   # checkpoint lost: replays all
    df = spark.read.parquet(target)
    assert df.count() == first == df.select("tweet_id").distinct().count()
    assert first == fixtures.posts(spark, SF001).count()


def test_stream_days_do_not_depend_on_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Belgrade")
    try:
        root = _land_batches(spark, SF001, overlapping=False)
        target, ckpt = scratch_path(spark, "t_daily"), scratch_path(spark, "t_ckpt")
        jobs.daily_sentiment_stream(spark, root, target, ckpt, mode="complete")
        got = {r.day: (r.total_count, round(r.avg_sentiment, 9)) for r in spark.read.parquet(target).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == _batch_daily(spark)


def test_posts_without_an_id_are_copies_only_if_equal(spark, workdir):
    posts = fixtures.posts(spark, SF001).limit(1)
    rows = [r.asDict(True) | {"tweet_id": None, "text": t} for r in posts.collect() for t in ("good one", "bad one", "good one")]
    for batch in (1, 2):  # landed by two pulls
        spark.createDataFrame(rows, posts.schema).write.json(f"{workdir}/in/batch={batch}/author_bucket=0")
    for mode in ("complete", "append"):
        target, ckpt = scratch_path(spark, "t_daily"), scratch_path(spark, "t_ckpt")
        if mode == "append":  # a later post closes the day
            late = rows[0] | {"tweet_id": 1, "created_at": str(int(rows[0]["created_at"]) + 10 * 86_400_000)}
            spark.createDataFrame([late], posts.schema).write.json(f"{workdir}/in/batch=3/author_bucket=0")
        jobs.daily_sentiment_stream(spark, f"{workdir}/in", target, ckpt, mode=mode)
        got = [r.total_count for r in spark.read.parquet(target).collect()]
        assert got == [2]
