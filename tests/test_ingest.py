"""Ingest cases: landed files, incremental reads, pages flattening, idempotent appends."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from postlytics import sinks
from postlytics.sources import files, pages


def _post(i, author=1, text="hello"):
    return {"author_id": author, "username": f"user_{author}", "tweet_id": i, "text": text,
            "created_at": str(1704067200000 + i * 1000), "retweets": 0, "replies": 0, "likes": i,
            "quote_count": 0, "conversation_id": i, "attach_list": {"media_keys": ["3_1", "3_2"]},
            "referenced_tweets_list": [{"data": {"type": "replied_to", "id": "7"}}]}


def _land(root, batch, author, posts, name="part-0.json", as_array=False):
    d = os.path.join(root, f"batch={batch}", f"author_id={author}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as fh:
        if as_array:
            json.dump([{k: v for k, v in p.items() if k != "author_id"} for p in posts], fh)
        else:
            for p in posts:
                fh.write(json.dumps({k: v for k, v in p.items() if k != "author_id"}) + "\n")
    return d


def test_same_file_twice_each_id_once(spark, workdir):
    root, target = os.path.join(workdir, "land"), os.path.join(workdir, "raw")
    _land(root, 1, 1, [_post(1), _post(2)])
    for _ in range(2):
        batch = files.read_landed(spark, root).drop(*files.FILE_COLUMNS, "batch")
        sinks.append_new(batch, target)
    assert sorted(r.tweet_id for r in spark.read.parquet(target).collect()) == [1, 2]


def test_overlapping_second_file(spark, workdir):
    root, target = os.path.join(workdir, "land"), os.path.join(workdir, "raw")
    _land(root, 1, 1, [_post(2), _post(1)])
    _land(root, 2, 1, [_post(3), _post(2)])
    for b in (1, 2):
        batch = files.read_landed(spark, root).where(F.col("batch") == b).drop(*files.FILE_COLUMNS, "batch")
        sinks.append_new(batch, target)
    assert sorted(r.tweet_id for r in spark.read.parquet(target).collect()) == [1, 2, 3]


def test_author_filter_is_exact(spark, workdir):
    root = os.path.join(workdir, "land")
    _land(root, 1, 1, [_post(1, 1)])
    _land(root, 1, 12, [_post(2, 12)])
    _land(root, 1, 123, [_post(3, 123)])
    rows = files.read_landed(spark, root, author=1).collect()
    assert [(r.author_id, r.tweet_id) for r in rows] == [(1, 1)]
    plan = files.read_landed(spark, root, author=1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "author_id" in plan


def test_empty_file_gives_no_rows_and_no_error(spark, workdir):
    root = os.path.join(workdir, "land")
    d = os.path.join(root, "batch=1", "author_id=1")
    os.makedirs(d)
    open(os.path.join(d, "empty.json"), "w").close()
    assert files.read_landed(spark, root).count() == 0
    _land(root, 2, 1, [_post(5)])
    assert [r.tweet_id for r in files.read_landed(spark, root).collect()] == [5]


def test_long_author_id_kept(spark, workdir):
    root = os.path.join(workdir, "land")
    _land(root, 1, 2147483648, [_post(1, 2147483648)])
    assert [r.author_id for r in files.read_landed(spark, root).collect()] == [2147483648]


def test_json_array_files_and_media_keys_as_array(spark, workdir):
    root = os.path.join(workdir, "land")
    _land(root, 1, 1, [_post(1), _post(2)], as_array=True)
    rows = files.read_landed(spark, root, multi_line=True).orderBy("tweet_id").collect()
    assert [r.tweet_id for r in rows] == [1, 2]
    assert rows[0].attach_list.media_keys == ["3_1", "3_2"]
    assert rows[0].referenced_tweets_list[0].data.type == "replied_to"


def test_marker_fixed_for_the_read(spark, workdir):
    """Files modified after the marker are all taken, whatever order they are listed in."""
    root = os.path.join(workdir, "land")
    _land(root, 1, 1, [_post(1)])
    marker = files.list_files(spark, root).select(F.max("_file_mtime")).first()[0]
    time.sleep(0.05)
    _land(root, 2, 1, [_post(3)], name="b.json")
    _land(root, 2, 2, [_post(2, 2)], name="a.json")
    got = sorted(r.tweet_id for r in files.read_landed(spark, root, modified_after=marker).collect())
    assert got == [2, 3]


def test_latest_batch_per_author(spark, workdir):
    root = os.path.join(workdir, "land")
    _land(root, 1, 1, [_post(1), _post(2)])
    _land(root, 1, 2, [_post(10, 2)])
    time.sleep(0.05)
    _land(root, 2, 1, [_post(3)])
    got = sorted((r.author_id, r.tweet_id) for r in files.latest_batch_rows(spark, root).collect())
    assert got == [(1, 3), (2, 10)]


def _page(no, tweets, users):
    return {"page_no": no,
            "data": [{"id": t, "author_id": a, "text": f"t{t}", "created_at": "0",
                      "public_metrics": {"retweet_count": 1, "reply_count": 2, "like_count": 3, "quote_count": 4}}
                     for t, a in tweets],
            "includes": {"users": [{"id": u, "username": f"u{u}", "description": None, "location": None,
                                    "public_metrics": {"followers_count": f, "tweet_count": 0}} for u, f in users]}}


def test_pages_orphans_quarantined_and_latest_user_wins(spark, workdir):
    path = os.path.join(workdir, "pages")
    os.makedirs(path)
    with open(os.path.join(path, "p.json"), "w") as fh:
        fh.write(json.dumps(_page(1, [(1, 10), (2, 99)], [(10, 5)])) + "\n")
        fh.write(json.dumps(_page(2, [(3, 10), (4, 11)], [(10, 7), (11, 1)])) + "\n")
        fh.write(json.dumps(_page(0, [(5, 11)], [])) + "\n")
    pg = pages.read_pages(spark, path)
    flat = {r.tweet_id: r for r in pages.flatten_pages(pg).collect()}
    assert sorted(flat) == [1, 3, 4, 5]               # 5 resolves through a later page
    assert flat[1].author_followers == 7              # record of the highest page wins
    assert flat[1].likes == 3 and flat[1].retweets == 1
    assert [r.tweet_id for r in pages.orphan_posts(pg).collect()] == [2]
    with pytest.raises(Exception):
        pages.flatten_pages(pg, on_orphan="raise").collect()


def test_old_files_are_not_opened(spark, workdir):
    """A corrupt file older than the marker (or already processed) is pruned, not read."""
    root = os.path.join(workdir, "land")
    d = os.path.join(root, "batch=1", "author_id=1")
    os.makedirs(d)
    with open(os.path.join(d, "old.json"), "w") as fh:
        fh.write("{not json\n")
    old = files.list_files(spark, root).select("_file_path")
    marker = files.list_files(spark, root).select(F.max("_file_mtime")).first()[0]
    time.sleep(0.05)
    _land(root, 2, 1, [_post(9)])
    # if the old file were read, its corrupt line would show up as an all-null row
    for df in (files.read_landed(spark, root, modified_after=marker),
               files.read_landed(spark, root, processed_files=old)):
        assert [r.tweet_id for r in df.collect()] == [9]


def test_partitioned_append_reads_only_touched_blocks(spark, workdir):
    from postlytics.operators.enrich import enrich
    from postlytics.sources import fixtures

    from conftest import SF001

    e = enrich(fixtures.posts(spark, SF001))
    target = os.path.join(workdir, "silver")
    sinks.append_new(e.where(F.col("month") == 12), target, partition_by=("year", "month"))
    rest = sinks.new_rows(e.where(F.col("month") == 1), target, partition_by=("year", "month"))
    rest.write.format("noop").mode("overwrite").save()
    plan = rest._jdf.queryExecution().executedPlan().toString()     # by block of ids, whatever the month
    assert any("id_block" in x.split("]")[0] for x in plan.split("PartitionFilters: [")[1:])
    sinks.append_new(e, target, partition_by=("year", "month"))
    stored = spark.read.parquet(target)
    assert stored.count() == stored.select("tweet_id").distinct().count() == e.count()
