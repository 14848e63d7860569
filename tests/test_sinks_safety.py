"""Sinks and jobs on empty batches, rows without keys, null partitions and late posts."""

import json
import os

import pytest
from pyspark.sql import functions as F

from postlytics import sinks
from postlytics.plans import jobs
from postlytics.schema import POST_SCHEMA
from postlytics.sources import files
from postlytics.streaming import jobs as streams


def _posts(spark, rows):
    base = {f.name: None for f in POST_SCHEMA.fields}
    return spark.createDataFrame([tuple({**base, **r}[f.name] for f in POST_SCHEMA.fields) for r in rows], POST_SCHEMA)


def _post(i, author=1, created="1705300000000", text="the good day"):
    return {"tweet_id": i, "author_id": author, "created_at": created, "text": text}


def _land(spark, root, batch, rows):
    os.makedirs(f"{root}/batch={batch}/author_id=1", exist_ok=True)
    with open(f"{root}/batch={batch}/author_id=1/part-{batch}.json", "w") as fh:
        fh.writelines((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in rows)


def _json(i, created="1705300000000", text="the good day"):
    return {"tweet_id": i, "created_at": created, "text": text}


def test_empty_first_batch_then_data(spark, workdir):
    for kind, append in (("raw", sinks.append_raw), ("new", sinks.append_new)):
        target = f"{workdir}/{kind}"
        append(_posts(spark, []), target)
        append(_posts(spark, [_post(1), _post(2)]), target)
        append(_posts(spark, [_post(2), _post(3)]), target)
        assert sorted(r.tweet_id for r in spark.read.parquet(target).collect()) == [1, 2, 3]


def test_null_keys_are_quarantined_once_and_null_partitions_match(spark, workdir):
    target = f"{workdir}/t"
    batch = _posts(spark, [_post(1), _post(None, text="a"), _post(None, text="b"), _post(3, created="bad")]).withColumn(
        "year", F.when(F.col("created_at") != "bad", 2024)).withColumn("month", F.lit(1))
    for _ in range(3):
        sinks.append_new(batch, target, partition_by=("year", "month"))
    assert sorted(r.tweet_id for r in spark.read.parquet(target).collect()) == [1, 3]
    assert spark.read.parquet(target + "_no_key").count() == 2


def test_transform_is_idempotent_and_scores_copies_once(spark, workdir):
    root, silver, log = (f"{workdir}/{x}" for x in ("my landing", "silver", "log"))
    _land(spark, root, 0, [])
    with open(f"{root}/batch=0/author_id=1/part-0.json", "w") as fh:
        fh.write("\n")
    jobs.transform(spark, root, silver, log)
    _land(spark, root, 1, [_json(1), _json(2, created="bad"), _json(None), "{broken"])
    seen = jobs.transform(spark, root, silver, log)
    assert seen["corrupt_records"] == 1 and seen["bad_created_at"] == 1 and seen["rows_read"] == 4
    _land(spark, root, 2, [_json(1), _json(1), _json(2, created="bad"), _json(5)])
    jobs.transform(spark, root, silver, log)
    assert jobs.transform(spark, root, silver, log)["rows_read"] == 0    # the path has a blank
    got = spark.read.parquet(silver)
    assert sorted(r.tweet_id for r in got.collect()) == [1, 2, 5]
    assert got.select("sentiment_score").distinct().count() == 1
    assert spark.read.parquet(silver + "_corrupt").count() == 1


def test_processed_files_match_in_a_path_with_encoded_characters(spark, workdir):
    root = f"{workdir}/my +landing é%20"
    _land(spark, root, 1, [_json(6)])
    done = files.list_files(spark, root).select("_file_path")
    done = spark.createDataFrame(done.collect(), done.schema)
    _land(spark, root, 2, [_json(5)])
    got = files.read_landed(spark, root, processed_files=done)
    assert [r.tweet_id for r in got.collect()] == [5]


def test_late_posts_are_not_lost_and_state_keeps_the_maximum(spark, workdir):
    def page(name, ids):
        os.makedirs(f"{workdir}/{name}", exist_ok=True)
        with open(f"{workdir}/{name}/p.json", "w") as fh:
            fh.write(json.dumps({"data": [{"id": i, "author_id": 1, "text": "t", "created_at": "1705300000000"} for i in ids],
                                 "includes": {"users": [{"id": 1, "username": "u"}]}}))
        return f"{workdir}/{name}"

    raw, state, quarantine, log = (f"{workdir}/{x}" for x in ("raw", "state", "q", "log"))
    run = lambda p, **kw: jobs.ingest_pages(spark, p, raw, state, quarantine, log, **kw)
    run(page("none", []))
    run(page("a", [10, 11]))
    run(page("late", [5, 11]))
    run(page("window", [20, 30]), since_id=25, end_ms=1705300000001, start_ms=1705300000000)
    assert sorted(r.tweet_id for r in spark.read.parquet(raw).collect()) == [5, 10, 11, 30]
    assert [(r.author_id, r.last_id) for r in spark.read.parquet(state).collect()] == [(1, 30)]
    assert sorted(r.id for r in spark.read.parquet(log).collect()) == [11, 11, 30]


@pytest.mark.parametrize("mode", ["complete", "append"])
def test_daily_stream_counts_overlaps_once(spark, workdir, mode):
    root, target, ckpt = (f"{workdir}/{x}" for x in ("land", "out", "ckpt"))
    day = lambda d: str(1705300000000 + d * 86_400_000)
    _land(spark, root, 1, [_json(1, day(0)), _json(2, day(0))])
    _land(spark, root, 2, [_json(2, day(0)), _json(3, day(0)), _json(4, day(9))])
    streams.daily_sentiment_stream(spark, root, target, ckpt, mode=mode, max_files_per_trigger=1)
    _land(spark, root, 3, [_json(5, day(20))])
    streams.daily_sentiment_stream(spark, root, target, ckpt, mode=mode)
    got = {str(r.day): r.total_count for r in spark.read.parquet(target).collect()}
    assert min(got.items())[1] == 3


def test_tickers_of_any_length():
    import re

    from postlytics import config as C
    assert re.findall(C.TICKER_PATTERN, "$TSLA $LONGNAM $BTCUSDT $BRK.B. $a $A1x") == ["TSLA", "LONGNAM", "BTCUSDT", "BRK.B"]


def test_author_files_with_arrays_batch_and_stream(spark, workdir):
    root = f"{workdir}/tweet"
    os.makedirs(root)
    for author, name in ((1, "id_1_20240115.json"), (12, "id_12_20240115.json")):
        with open(f"{root}/{name}", "w") as fh:
            json.dump([{**_json(author * 10 + k), "author_id": author} for k in range(3)], fh)
    with open(f"{root}/other.json", "w") as fh:
        fh.write("[{]")
    got = files.read_author_files(spark, root, 1)
    assert sorted((r.author_id, r.tweet_id) for r in got.collect()) == [(1, 10), (1, 11), (1, 12)]
    assert files.read_author_files(spark, root).count() == 6
    target, ckpt = f"{workdir}/raw", f"{workdir}/ckpt"
    for _ in range(2):
        streams.ingest_stream(spark, root, target, ckpt, multi_line=True, glob="id_*_*.json")
    assert sorted(r.tweet_id for r in spark.read.parquet(target).collect()) == [10, 11, 12, 120, 121, 122]


def test_landing_folders_do_not_grow_with_authors_and_appends_read_their_blocks_only(spark, workdir):
    posts = _posts(spark, [_post(i, author=i, created=str(1705300000000 + i % 5 * 86_400_000)) for i in range(300)])
    files.land_json(posts, f"{workdir}/land", 1)
    assert len([d for d in os.listdir(f"{workdir}/land/batch=1") if d.startswith("author_bucket=")]) <= 16
    rows = files.read_landed(spark, f"{workdir}/land", author=7)
    assert [r.tweet_id for r in rows.collect()] == [7]
    assert "author_bucket" in str(rows._jdf.queryExecution().executedPlan()).split("PartitionFilters: [")[1].split("]")[0]
    target = f"{workdir}/raw"
    sinks.append_raw(posts, target)
    batch = posts.where("tweet_id % 5 = 0").withColumn("post_date", sinks.post_date())
    new = sinks.new_rows(batch, target, partition_by=sinks.RAW_PARTITIONS)
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "id_block" in plan.split("PartitionFilters: [")[1].split("]")[0] and new.count() == 0
