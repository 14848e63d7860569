"""Tables over all history: keys whatever their date, replays and crashes, newest months, stored sums,
bounded and stored stream state."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from postlytics import config as C
from postlytics import sinks
from postlytics.operators import reports
from postlytics.operators.enrich import enrich
from postlytics.plans import jobs
from postlytics.streaming import jobs as streams
from test_sinks_safety import _json, _land, _post, _posts

DAY_MS = 86_400_000
NOON = 1705348800000        # 2024-01-15 12:00 local


def at(days, ms=0):
    return str(NOON + days * DAY_MS + ms)


def files_read(df):
    """Files that the scans of a query open (df must not have run yet)."""
    df.collect()
    plan, out = df._jdf.queryExecution().executedPlan(), 0
    todo = [plan]
    while todo:
        p = todo.pop()
        if p.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(p.executedPlan())
            continue
        if p.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(p.plan())
            continue
        if p.metrics().contains("numFiles"):
            out += p.metrics().apply("numFiles").value()
        kids = p.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return out


def test_a_key_is_stored_once_whatever_its_date(spark, workdir):
    raw, silver = f"{workdir}/raw", f"{workdir}/silver"
    for created in (at(0), at(40), at(-400), "no time", None):
        sinks.append_raw(_posts(spark, [_post(9, created=created), _post(10, created=created)]), raw)
        sinks.append_new(enrich(_posts(spark, [_post(9, created=created)])), silver, partition_by=jobs.SILVER_PARTITIONS)
    assert sorted(r.tweet_id for r in sinks.read_table(spark, raw).collect()) == [9, 10]
    assert spark.read.parquet(silver).count() == 1
    root, log = f"{workdir}/land", f"{workdir}/log"
    for k, created in enumerate((at(0), at(-90))):
        _land(spark, root, k, [_json(30, created)])
        jobs.transform(spark, root, silver, log)
    assert spark.read.parquet(silver).where("tweet_id = 30").count() == 1


def test_a_key_lookup_skips_the_files_of_other_blocks(spark, workdir, monkeypatch):
    block = 1 << C.ID_BLOCK_BITS
    target = f"{workdir}/raw"
    sinks.append_raw(_posts(spark, [_post(k * block + j, created=at(j)) for k in range(-2, 10) for j in range(3)]), target)
    every = len(glob.glob(f"{target}/**/*.parquet", recursive=True))
    batch = _posts(spark, [_post(3 * block + 1, created=at(-500)), _post(3 * block + 7), _post(8 * block), _post(-2 * block)])
    known = sinks.known_keys(batch, target)
    assert sorted(r._key for r in known.collect()) == sorted(k * block + j for k in (-2, 3, 8) for j in range(3))
    assert files_read(sinks.known_keys(batch, target)) == every // 4
    assert [r.tweet_id for r in sinks.new_rows(batch, target).collect()] == [3 * block + 7]
    monkeypatch.setattr(C, "ID_BLOCKS_NAMED", 1)            # too many blocks to name: their range
    batch = _posts(spark, [_post(3 * block + 1), _post(4 * block + 7)])
    assert files_read(sinks.known_keys(batch, target)) == every // 6
    assert [r.tweet_id for r in sinks.new_rows(batch, target).collect()] == [4 * block + 7]


def _page(workdir, name, ids):
    import json

    os.makedirs(f"{workdir}/{name}", exist_ok=True)
    with open(f"{workdir}/{name}/p.json", "w") as fh:
        fh.write(json.dumps({"data": [{"id": i, "author_id": 1 + i % 2, "text": "t", "created_at": at(0)} for i in ids],
                             "includes": {"users": [{"id": 1, "username": "u"}, {"id": 2, "username": "v"}]}}))
    return f"{workdir}/{name}"


def test_pages_again_change_nothing_and_a_lost_log_row_comes_back(spark, workdir):
    raw, state, quarantine, log = (f"{workdir}/{x}" for x in ("raw", "state", "q", "log"))
    run = lambda p: jobs.ingest_pages(spark, p, raw, state, quarantine, log)
    logged = lambda: sorted((r.author_id, r.id) for r in spark.read.parquet(log).collect())
    a = _page(workdir, "a", [10, 11, 12])
    run(a)
    run(a)
    assert logged() == [(1, 12), (2, 11)] and spark.read.parquet(raw).count() == 3
    run(_page(workdir, "late", [4, 12]))                    # one new post of author 1
    assert logged() == [(1, 12), (1, 12), (2, 11)]
    # a crash after the data and before the log: the same pages write the row that is missing
    sinks.append_raw(spark.read.schema(_posts(spark, []).schema).parquet(raw).limit(0), raw)
    lost = f"{workdir}/log2"
    jobs.ingest_pages(spark, a, raw, state, quarantine, lost)
    jobs.ingest_pages(spark, a, raw, state, quarantine, lost)
    assert sorted((r.author_id, r.id) for r in spark.read.parquet(lost).collect()) == [(1, 12), (2, 11)]
    assert sorted((r.author_id, r.last_id) for r in spark.read.parquet(state).collect()) == [(1, 12), (2, 11)]


@pytest.mark.parametrize("crash", ["before the swap", "after the old went", "while writing"])
def test_state_survives_a_crash_of_its_replacement(spark, workdir, crash):
    path, schema = f"{workdir}/state", "author_id long, last_id long"
    row = lambda v: spark.createDataFrame([(1, v)], schema)
    sinks.overwrite_state(row(5), path)
    row(6).write.parquet(path + "_next")
    if crash == "after the old went":
        os.rename(path, f"{workdir}/gone")
    if crash == "while writing":
        os.rename(path + "_next/_SUCCESS", f"{workdir}/mark")
    want = 5 if crash == "while writing" else 6
    assert [r.last_id for r in sinks.read_state(spark, path, schema).collect()] == [want]
    old = sinks.read_state(spark, path, schema)             # a replacement may read what it replaces
    sinks.overwrite_state(old.withColumn("last_id", F.col("last_id") + 1), path)
    assert [r.last_id for r in sinks.read_state(spark, path, schema).collect()] == [want + 1]
    assert not os.path.exists(path + "_next")


def test_state_objects_and_logs_are_safe_as_well(spark, workdir):
    path, schema = f"{workdir}/objects", "author_id long, last_id long"
    for v in (1, 2):
        sinks.write_state_objects(spark.createDataFrame([(1, v)], schema), path)
    assert [tuple(r) for r in sinks.read_state_objects(spark, path, schema).collect()] == [(1, 2)]
    rows = spark.createDataFrame([(1, 5), (None, 6)], "author_id long, id long")
    for _ in range(2):
        sinks.append_log(rows, f"{workdir}/log", once_by=("author_id", "id"))
    assert spark.read.parquet(f"{workdir}/log").count() == 2


def _silver(spark, path, months):
    rows = [_post(1000 * k + j, created=at(-31 * k, j)) for k, n in enumerate(months) for j in range(n)]
    sinks.append_new(enrich(_posts(spark, rows + [_post(99_999, created="no time")])), path, partition_by=jobs.SILVER_PARTITIONS)
    return spark.read.parquet(path)


@pytest.mark.parametrize("months, n, folders", [((5, 9, 9, 9), 5, 1), ((5, 9, 9, 9), 6, 2), ((1, 1, 1), 3, 3), ((2, 2), 20, 3)])
def test_latest_posts_read_the_newest_months(spark, workdir, months, n, folders):
    silver = _silver(spark, f"{workdir}/silver", months)
    top = jobs.latest_posts(spark, f"{workdir}/silver", n)
    assert top.collect() == reports.latest_posts(silver, n).collect()
    assert files_read(jobs.latest_posts(spark, f"{workdir}/silver", n)) == folders


def test_daily_sums_follow_overlapping_batches_and_leave_other_months(spark, workdir):
    silver, daily = f"{workdir}/silver", f"{workdir}/daily"
    first = enrich(_posts(spark, [_post(j, created=at(-31 * (j % 3), j), text=t) for j, t in enumerate(["the the", "of of", None] * 6)]))
    second = enrich(_posts(spark, [_post(j, created=at(-31 * (j % 3), j)) for j in (0, 3, 30, 33)] + [_post(60, created="no time")]))
    months = lambda: {p: os.stat(p).st_ino for p in glob.glob(f"{daily}/year=*/month=*/*.parquet")}
    jobs.apply_batch(spark, first, silver, daily, 1)
    before = months()
    for _ in range(2):                                      # a replayed batch adds nothing
        jobs.apply_batch(spark, second, silver, daily, 2)
    after = months()
    assert len(set(before.items()) & set(after.items())) == 2 and len(after) == 4
    want = reports.calendar_sentiment(spark.read.parquet(silver)).collect()
    got = {(r.year, r.month, r.dayofmonth): r for r in jobs.stored_daily(spark, daily).collect()}
    assert len(got) == len(want) and sum(r.total_count for r in want) == 21
    for r in want:
        g = got[r.year, r.month, r.dayofmonth]
        assert g.total_count == r.total_count
        for a, b in ((g.avg_sentiment, r.avg_sentiment), (g.avg_polarity, r.avg_polarity)):
            assert (a is None and b is None) or abs(a - b) < 1e-12


def test_a_batch_cut_off_by_a_crash_goes_on(spark, workdir):
    """Posts were appended, sums were not: the same batch again adds them once."""
    silver, daily = f"{workdir}/silver", f"{workdir}/daily"
    batch = enrich(_posts(spark, [_post(j, created=at(0, j)) for j in range(4)]))
    sinks.new_rows(batch, silver).write.parquet(f"{daily}_batches/batch=1")
    sinks.append_new(batch, silver, partition_by=jobs.SILVER_PARTITIONS)
    jobs.apply_batch(spark, batch, silver, daily, 1)
    assert [r.total_count for r in jobs.stored_daily(spark, daily).collect()] == [4] and spark.read.parquet(silver).count() == 4


def test_bounded_daily_stream(spark, workdir):
    """Against a plain loop over the pulls: closed days, late posts, and what the state still holds."""
    root, target, state, late, ckpt = (f"{workdir}/{x}" for x in ("land", "days", "state", "late", "ckpt"))
    pulls = [[(1, 0), (2, 0), (2, 0)], [(2, 0), (3, 1), (4, 5)], [(5, 0), (4, 5), (6, 3), (None, 4)], [(None, 4), (7, 9), (8, 2)], [(9, 8)], [(10, 20)]]
    newest, seen, counted, too_late = None, set(), {}, []
    for k, pull in enumerate(pulls):
        _land(spark, root, k, [_json(i, at(d)) for i, d in pull] + ([_json(77, "no time")] if k == 1 else []))
        streams.daily_sentiment_bounded(spark, root, target, state, late, ckpt, max_files_per_trigger=1)
        closed = None if newest is None else newest - 2
        for i, d in pull:
            if closed is not None and d < closed:
                too_late.append((i, d))
            elif (i, d) not in seen:
                seen.add((i, d))
                counted[d] = counted.get(d, 0) + 1
        newest = max([d for _, d in pull] + ([newest] if newest is not None else []))
    day = lambda d: dt.date(2024, 1, 15) + dt.timedelta(days=d)
    got = {r.day: r.total_count for r in streams.closed_days(spark, target).collect()}
    assert got == {day(d): n for d, n in counted.items() if d < newest - 2}
    left = spark.read.parquet(late).select("tweet_id", "day").collect()
    assert sorted(((r.tweet_id, r.day) for r in left if r.day), key=repr) == sorted(((i, day(d)) for i, d in too_late), key=repr)
    assert [r.tweet_id for r in left if r.day is None] == [77]
    held = {v for (v,) in sinks.partition_values(spark, f"{state}/posts", ("day",))}
    assert held == {str(day(d)) for d in (7, 8, 9, 20)} & held and str(day(0)) not in held
    assert len(sinks.partition_values(spark, f"{state}/marks", ("epoch",))) <= 2
    before = sorted(map(tuple, streams.closed_days(spark, target).collect()))
    streams.daily_sentiment_bounded(spark, root, target, state, late, ckpt)      # nothing new
    assert sorted(map(tuple, streams.closed_days(spark, target).collect())) == before


def test_marks_of_a_stream_go_on_from_its_checkpoint(spark, workdir):
    path, ckpt = f"{workdir}/log", f"{workdir}/ckpt"
    rows = [[(1, 5, 10), (2, 5, 20), (None, 1, 3)], [(1, 4, 99), (2, 6, 1), (3, 1, 7), (2, 6, 2)]]
    for part in rows:
        sinks.append_log(spark.createDataFrame(part, "author_id long, t long, id long"), path)
        streams.marks_stream(spark.readStream.schema("author_id long, t long, id long").parquet(path), ckpt, "author_id", "t", ["id"])
    got = streams.stream_marks(spark, ckpt, "author_id", "t", ["id"])
    assert sorted(map(tuple, got.collect()), key=repr) == [(1, 5, 10), (2, 6, 2), (3, 1, 7), (None, 1, 3)]
