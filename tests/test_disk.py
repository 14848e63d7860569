"""Texts are written once and compressed, and shuffled only where stored and new keys mix."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from postlytics import config as C
from postlytics import registry, sinks
from postlytics.functions.text import extract_tickers
from postlytics.operators import extensions, reports, sentiment
from postlytics.operators.enrich import enrich
from postlytics.plans.inspect import plan_text
from postlytics.sources import files, fixtures, pages

from conftest import SF001
from test_sinks_safety import _post, _posts

DAY_MS = 86_400_000


def _days(spark, ids, days=4, **kw):
    return _posts(spark, [_post(i, created=str(1705300000000 + i % days * DAY_MS), **kw) for i in ids])


def test_pulls_land_compressed_and_large_ones_unshuffled(spark, workdir, monkeypatch):
    posts = _days(spark, range(200), text="the same words " * 50).repartition(3).checkpoint()
    for few, batch in ((1000, 1), (10, 2)):
        monkeypatch.setattr(C, "FEW_ROWS", few)
        files.land_json(posts, f"{workdir}/land", batch)
    names = [glob.glob(f"{workdir}/land/batch={b}/**/part-*", recursive=True) for b in (1, 2)]
    assert all(n.endswith(".json.gz") for n in names[0] + names[1])
    assert len({os.path.basename(n).split("-")[1] for n in names[1]}) == 3      # the tasks that held the rows wrote them
    open(f"{os.path.dirname(names[1][0])}/plain.json", "w").write('{"tweet_id": 777, "author_id": 1}\n')
    got = sorted(r.tweet_id for r in files.read_landed(spark, f"{workdir}/land").collect())
    assert got == sorted([*range(200)] * 2 + [777])
    assert files.list_files(spark, f"{workdir}/land").count() == len(names[0]) + len(names[1]) + 1


def test_pulls_land_at_the_level_set(spark, workdir, monkeypatch):
    posts = _days(spark, range(100), text="some words that come again, some words " * 20)
    size = {}
    for batch, level in enumerate(("NO_COMPRESSION", C.LANDING_GZIP_LEVEL)):
        monkeypatch.setattr(C, "LANDING_GZIP_LEVEL", level)
        path = files.land_json(posts, f"{workdir}/land", batch)
        size[level] = sum(os.path.getsize(f) for f in glob.glob(f"{path}/**/part-*", recursive=True))
    assert size["BEST_SPEED"] * 3 < size["NO_COMPRESSION"]
    assert files.read_landed(spark, f"{workdir}/land").count() == 200


@pytest.mark.parametrize("few", [1000, 10])
def test_pulls_written_in_one_pass_land_one_by_one(spark, workdir, monkeypatch, few):
    monkeypatch.setattr(C, "FEW_ROWS", few)
    twice = F.when(F.col("tweet_id") % 10 == 3, F.array(F.lit(0), F.lit(2))).otherwise(F.array(F.lit(0)))
    posts = _days(spark, range(40)).unionByName(_posts(spark, [_post(None), _post(41, text=None)]))
    written, root = files.write_pulls(posts, twice, f"{workdir}/pulls"), f"{workdir}/land"
    landed = lambda: sorted((r.batch, r.tweet_id or -1, r.text, r.author_id) for r in files.read_landed(spark, root).collect())
    want = lambda k: sorted((k, r.tweet_id or -1, r.text, r.author_id) for r in posts.where(F.array_contains(twice, k)).collect())
    for k, so_far in ((0, want(0)), (1, want(0)), (2, want(0) + want(2))):
        files.land_pull(spark, written, root, k)
        assert os.path.isdir(f"{root}/batch={k}") and repr(landed()) == repr(so_far)
    with pytest.raises(FileExistsError):
        files.land_pull(spark, written, root, 0)
    ids = lambda **kw: sorted(r.tweet_id or -1 for r in files.read_landed(spark, root, **kw).collect())
    assert ids(author=1) == ids() and ids(author=2) == []


def test_no_landed_file_holds_more_rows_than_set(spark, workdir, monkeypatch):
    monkeypatch.setattr(C, "LANDING_FILE_ROWS", 7)
    posts = _days(spark, range(40)).coalesce(1)
    files.land_json(posts, f"{workdir}/land", 0)
    files.write_pulls(posts, F.array(F.lit(0)), f"{workdir}/pulls")
    for root in ("land", "pulls"):
        rows = files.read_landed(spark, f"{workdir}/{root}").groupBy("_file_path").count().collect()
        assert sum(r["count"] for r in rows) == 40 and max(r["count"] for r in rows) == 7


@pytest.mark.parametrize("grain", [("post_date",), ()])
def test_fresh_rows_are_new_rows_and_join_mixed_days_alone(spark, workdir, monkeypatch, grain):
    monkeypatch.setattr(C, "FEW_ROWS", 0)
    target, dated = f"{workdir}/raw", lambda df: df.withColumn("post_date", sinks.post_date())
    sinks.append_raw(_days(spark, [i for i in range(40) if i % 4 in (0, 1) and i != 5]), target)
    again = _posts(spark, [_post(9002, created=str(1705300000000 + 3 * DAY_MS), text=t) for t in ("a", "b")])
    batch = dated(_days(spark, range(40)).unionByName(again).unionByName(_posts(spark, [_post(None), _post(9001, created=None)])))
    rows, n, keyless = sinks.fresh_rows(batch, target, grain=grain)
    assert (n, keyless) == (1 + 20 + 2 + 1, 1)
    want = sinks.new_rows(batch, target)
    key = lambda r: (r.tweet_id, r.text)
    assert sorted(map(key, rows.collect())) == sorted(map(key, want.collect()))
    sinks.append_new(batch, target, partition_by=sinks.RAW_PARTITIONS, grain=grain)
    stored = sinks.read_table(spark, target)
    assert stored.count() == stored.select("tweet_id").distinct().count() == 19 + 23
    assert spark.read.parquet(target + "_no_key").count() == 1
    rows, n, _ = sinks.fresh_rows(batch, target, grain=grain)
    assert n == 0 and rows.count() == 0
    plan = plan_text(sinks.fresh_rows(dated(_days(spark, range(100, 140))), target, grain=("post_date",))[0], "simple")
    assert "Join" not in plan and "Exchange" not in plan


@pytest.mark.parametrize("most", [0, 1000])
def test_only_the_new_keys_of_mixed_days_are_joined_with_and_few_are_broadcast(spark, workdir, monkeypatch, most):
    monkeypatch.setattr(C, "BROADCAST_ROWS", most)
    seen, beside = [], sinks.beside
    monkeypatch.setattr(sinks, "beside", lambda keys, n: seen.append((keys.count(), n)) or beside(keys, n))
    target, dated = f"{workdir}/raw", lambda df: df.withColumn("post_date", sinks.post_date())
    sinks.append_raw(_days(spark, [i for i in range(40) if i % 4 == 0 and i > 8]), target)        # days 0 to 3: i % 4
    batch = dated(_days(spark, range(40)))
    rows, n, _ = sinks.fresh_rows(batch, target, grain=("post_date",))
    assert seen == [(3, 3)] and n == 33                                            # 0, 4 and 8; days 1 to 3 are whole
    assert sorted(r.tweet_id for r in rows.collect()) == [i for i in range(40) if i % 4 or i <= 8]
    plan = plan_text(sinks.fresh_rows(batch, target, grain=("post_date",))[0], "simple")
    assert ("BroadcastHashJoin" in plan) == (most > 0) and ("SortMergeJoin" in plan) == (most == 0)


def test_report_table_is_stored_where_its_texts_were_cleaned(spark, monkeypatch):
    seen, append = [], sinks.append_rows
    monkeypatch.setattr(sinks, "append_rows", lambda rows, target, *a, **kw: (
        seen.append((plan_text(rows, "simple"), target)), append(rows, target, *a, **kw)))
    monkeypatch.setattr(C, "FEW_ROWS", 10, raising=False)
    got = registry.QUERIES["src_report_table"](spark, SF001).collect()
    [(plan, silver)] = seen
    assert "Exchange hashpartitioning(tweet_id" not in plan and "Aggregate" not in plan.split("Subquery")[0]
    assert plan.index("regexp_replace") < plan.index("Exchange")                # cleaned above the last shuffle
    files_of = glob.glob(f"{silver.removeprefix('file:')}/**/part-*", recursive=True)
    assert files_of and all(f.endswith(".zstd.parquet") for f in files_of)
    posts = fixtures.posts(spark, SF001)
    assert spark.read.parquet(silver).count() == posts.count()
    assert got == reports.daily_rounded(reports.daily_sentiment(enrich(posts))).collect()


def test_pages_in_order_are_stored_without_a_further_shuffle(spark, workdir):
    p = fixtures.posts(spark, SF001)
    a = pages.store_pages(fixtures.response_pages(p), f"{workdir}/a")
    b = pages.store_pages(fixtures.response_pages(p, in_order=True), f"{workdir}/b", in_order=True)
    low = lambda path: [(r.id_low, r.id_high, len(r.data)) for r in spark.read.parquet(path).orderBy("id_low").collect()]
    assert low(a) == low(b) and low(a)
    ranges = sorted((spark.read.parquet(f).agg(F.min("id_low"), F.max("id_high")).first() for f in glob.glob(f"{b}/part-*")))
    assert all(x[1] < y[0] for x, y in zip(ranges, ranges[1:]))
    path = pages.land_pages(fixtures.response_pages(p), f"{workdir}/json")
    assert glob.glob(f"{path}/*.json.gz") and pages.read_pages(spark, path).count() == len(low(a))


def test_many_pages_are_landed_and_stored_part_by_part(spark, workdir, monkeypatch):
    p = fixtures.posts(spark, SF001).unionByName(_posts(spark, [_post(None)]))
    tweets = lambda df: sorted((r.page_no is None, r.page_no, sorted(str(t) for t in r.data), sorted(str(u) for u in r.includes.users))
                               for r in df.collect())
    whole = [tweets(pages.read_pages(spark, pages.land_pages(fixtures.response_pages(p), f"{workdir}/json")))]
    path = pages.store_pages(fixtures.response_pages(p, in_order=True), f"{workdir}/table", in_order=True)
    whole.append(tweets(spark.read.parquet(path)))
    assert whole[0] == whole[1] and len(whole[0]) == 11
    moved, move = [], sinks.move_folder
    monkeypatch.setattr(C, "PART_PAGES", 3, raising=False)
    monkeypatch.setattr(sinks, "move_folder", lambda spark, path, to: moved.append(to) or move(spark, path, to))
    a = pages.land_pages(fixtures.response_pages(p), f"{workdir}/parts_json")
    b = pages.store_pages(fixtures.response_pages(p, in_order=True), f"{workdir}/parts_table", in_order=True)
    assert moved == [a, b] and not glob.glob(f"{workdir}/*_parts")
    assert [tweets(pages.read_pages(spark, a)), tweets(spark.read.parquet(b))] == whole
    ranges = sorted(x for x in (tuple(spark.read.parquet(f).agg(F.min("id_low"), F.max("id_high")).first()) for f in glob.glob(f"{b}/part-*"))
                    if x[0] is not None)
    assert len(ranges) >= 4 and all(x[1] < y[0] for x, y in zip(ranges, ranges[1:]))
    with pytest.raises(Exception):
        pages.land_pages(fixtures.response_pages(p), a)
    assert tweets(pages.read_pages(spark, a)) == whole[0]
    part = pages._parts(fixtures.response_pages(fixtures.posts(spark, SF001)))[1]       # noqa: SLF001
    below = part._jdf.queryExecution().optimizedPlan().toString().split("Join", 1)[1]
    assert any("Filter" in x and "event_id" in x for x in below.split("\n"))           # posts of other parts are not joined
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"


def test_tweets_stay_in_place_beside_few_users(spark, workdir, monkeypatch):
    path = pages.land_pages(fixtures.response_pages(fixtures.posts(spark, SF001)), f"{workdir}/json")
    flat = pages.flatten_pages(pages.read_pages(spark, path))
    assert "Exchange hashpartitioning" not in plan_text(flat, "simple")
    monkeypatch.setattr(C, "BROADCAST_ROWS", 1)
    large = pages.flatten_pages(pages.read_pages(spark, path))
    key = lambda df: sorted((r.tweet_id, r.username, r.author_followers) for r in df.collect())
    assert key(flat) == key(large)


def test_small_and_large_vocabularies_give_the_same_sums(spark, monkeypatch):
    texts = ["the good day", "The day the", "none", "", None, "the good day"]
    rows = _posts(spark, [_post(i % 5, text=t) for i, t in enumerate(texts)] + [_post(None, text="good good")]).withColumnRenamed("text", "cleaned_tweet_text")
    model = spark.createDataFrame([("the", -1.0, -2.0, -3.0), ("good", -3.0, -2.0, -1.0), ("day", -2.5, -2.0, -1.5)],
                                  "token string, w_negative double, w_neutral double, w_positive double")
    priors = spark.createDataFrame([(-1.0, -1.1, -1.2)], "p_negative double, p_neutral double, p_positive double")
    small = sentiment.score_naive_bayes(rows, model, priors).select("tweet_id", "cleaned_tweet_text", "sentiment_label", "sentiment_score")
    assert plan_text(small.drop("cleaned_tweet_text"), "simple").count("cleaned_tweet_text") < 12 and "BroadcastHashJoin" in plan_text(small, "simple")
    monkeypatch.setattr(C, "BROADCAST_ROWS", 1)
    large = sentiment.score_naive_bayes(rows, model, priors).select(*small.columns)
    assert sorted(small.collect(), key=repr) == sorted(large.collect(), key=repr) and small.count() == 7


@pytest.mark.parametrize("most", [0, 1, 2, 3, 100])
def test_texts_stay_in_place_beside_a_large_vocabulary(spark, monkeypatch, most):
    texts = ["the good day", "The odd the", "none", "", None, "the good day", "day odd zzz odd"]
    rows = _posts(spark, [_post(i % 5, text=t) for i, t in enumerate(texts)] + [_post(None, text="good odd")]).withColumnRenamed("text", "cleaned_tweet_text")
    words = {"the": 4.0, "good": 1.0, "day": -2.0, "odd": -1.5, "none": -8.0}
    lexicon = spark.createDataFrame([*words.items(), ("odd", -0.5), (None, 9.0), ("", 5.0), ("unused", 1.0)], "token string, weight double")
    weights = [(w, -x, -1.0, -0.3 * x) for w, x in words.items()]
    model = spark.createDataFrame([*weights, ("odd", -9.0, -0.5, -0.1)], "token string, w_negative double, w_neutral double, w_positive double")
    priors = spark.createDataFrame([(-1.0, -1.1, -1.2)], "p_negative double, p_neutral double, p_positive double")
    columns = ["tweet_id", "cleaned_tweet_text", "sentiment_label", "sentiment_score"]
    scored = lambda: (sentiment.score_lexicon(rows, lexicon).select(columns),
                      sentiment.score_naive_bayes(rows, model, priors).select(columns))
    want = [sorted(df.collect(), key=repr) for df in scored()]
    assert any(r.sentiment_label == "Negative" for r in want[0]) and len(want[0]) == 8
    monkeypatch.setattr(C, "BROADCAST_ROWS", most)
    for df, rows_wanted in zip(scored(), want):
        assert "Exchange hashpartitioning(_key" not in plan_text(df, "simple").split("Generate", 1)[1]   # cut where they lie
        assert sorted(df.collect(), key=repr) == rows_wanted


def test_posts_are_read_once_for_the_spine_and_scored_only_with_a_ticker(spark):
    e = enrich(fixtures.posts(spark, SF001))
    spine = reports.calendar_spine(e, days_back=35)
    assert spine.count() == 35 and "parquet" not in plan_text(spine, "simple").lower()
    posts = _posts(spark, [_post(1, text="$P1 the"), _post(2, text="the"), _post(3, text="$p1 $"), _post(4, text=None)])
    scored = enrich(posts)
    aliases = spark.createDataFrame([("P1", 1)], "symbol string, asset_id int")
    m = extensions.ticker_mentions(scored, aliases, keep=("sentiment_score",))
    assert [(r.tweet_id, r.symbol) for r in m.collect()] == [(1, "P1")]
    optimized = m._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.index("Generate") < optimized.index("(?i:") < optimized.rindex("RLIKE")      # filtered below the scorer
    assert posts.where(F.size(extract_tickers("text")) > 0).count() == 1
