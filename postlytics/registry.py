"""Named queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver's tables (or tables Spark derives from them) in
full.  Doubles that are sums or averages are rounded to 9 places in the
registered form only, so the oracle comparison does not depend on summation
order; the operators themselves do not round.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlytics import sinks
from postlytics.functions.timeparts import epoch_ms_to_seconds, ntz_from_epoch_seconds, parse_timestamp_text
from postlytics.operators import extensions, filters, reports, sentiment, state
from postlytics.operators.enrich import add_clean_text, add_date_parts, enrich
from postlytics.schema import POST_COLUMNS
from postlytics.session import scratch_path
from postlytics.sources import files, fixtures, pages
from postlytics.plans import jobs as plans
from postlytics.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def r9(c: str):
    return F.round(F.col(c), 9).alias(c)


def enriched_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(fixtures.posts(spark, sf_dir))


@query("agg_daily_sentiment")
def q_agg_daily_sentiment(spark, sf_dir):
    d = reports.daily_sentiment(enriched_posts(spark, sf_dir))
    return d.select("dayofmonth", "total_count", r9("avg_sentiment"), r9("avg_polarity"))


# ------------------------------------------------------------------ cleaning, dates, scorers


STATE_BEFORE = "2024-01-15"      # first UTC day not loaded yet in the state fixtures
INCOMING_FROM = "2024-01-10"     # first UTC day of the overlapping second batch
BATCH1_BEFORE = STATE_BEFORE     # batch 1: UTC days before this
BATCH2_FROM = INCOMING_FROM      # batch 2: UTC days from this (overlaps batch 1)


@query("prj_clean_text")
def q_prj_clean_text(spark, sf_dir):
    return add_clean_text(fixtures.posts(spark, sf_dir)).select("tweet_id", "cleaned_tweet_text")


@query("prj_date_parts")
def q_prj_date_parts(spark, sf_dir):
    return add_date_parts(fixtures.posts(spark, sf_dir)).select(
        "tweet_id", "created_at_date", "year", "month", "dayofmonth")


@query("sentiment_lexicon")
def q_sentiment_lexicon(spark, sf_dir):
    cleaned = add_clean_text(fixtures.posts(spark, sf_dir))
    return sentiment.score_lexicon(cleaned).select("tweet_id", "sentiment_label", "sentiment_score")


@query("sentiment_model")
def q_sentiment_model(spark, sf_dir):
    """Plug-in model path (pandas UDF) with the deterministic stand-in model."""
    cleaned = add_clean_text(fixtures.posts(spark, sf_dir))
    return sentiment.score_model(cleaned).select("tweet_id", "sentiment_label", "sentiment_score")


@query("sentiment_fit_nb")
def q_sentiment_fit_nb(spark, sf_dir):
    docs = fixtures.labelled_documents(spark, sf_dir)
    model = sentiment.fit_naive_bayes(docs)
    priors = sentiment.naive_bayes_priors(docs)
    cleaned = add_clean_text(fixtures.posts(spark, sf_dir))
    scored = sentiment.score_naive_bayes(cleaned, model, priors)
    return scored.select("tweet_id", "sentiment_label", "sentiment_score")


@query("sentiment_fit_nb_merged")
def q_sentiment_fit_nb_merged(spark, sf_dir):
    """The model of counts to which two halves of the labelled documents were added, the second twice."""
    docs, path = fixtures.labelled_documents(spark, sf_dir), scratch_path(spark, "nb_counts")
    for k in (0, 1, 1):
        counts = sentiment.add_naive_bayes(docs.where(F.col("doc_id") % 2 == k), path, k + 1)
    model, priors = sentiment.naive_bayes_of_counts(counts)
    cleaned = add_clean_text(fixtures.posts(spark, sf_dir))
    return sentiment.score_naive_bayes(cleaned, model, priors).select("tweet_id", "sentiment_label", "sentiment_score")


@query("sentiment_fitted_model")
def q_sentiment_fitted_model(spark, sf_dir):
    """Posts scored by a logistic regression fitted on the labelled documents (no SQL form)."""
    _, model = sentiment.fit_model(fixtures.labelled_documents(spark, sf_dir))
    cleaned = add_clean_text(fixtures.posts(spark, sf_dir))
    return sentiment.score_fitted(cleaned, model).select("tweet_id", "sentiment_label", "sentiment_score")


# ------------------------------------------------------------------ reports


@query("flt_day_in")
def q_flt_day_in(spark, sf_dir):
    return filters.day_in(enriched_posts(spark, sf_dir)).select("tweet_id", "dayofmonth")


@query("agg_daily_rounded")
def q_agg_daily_rounded(spark, sf_dir):
    return reports.daily_rounded(reports.daily_sentiment(enriched_posts(spark, sf_dir)))


@query("agg_calendar_sentiment")
def q_agg_calendar_sentiment(spark, sf_dir):
    d = reports.calendar_sentiment(enriched_posts(spark, sf_dir))
    return d.select("year", "month", "dayofmonth", "total_count", r9("avg_sentiment"), r9("avg_polarity"))


@query("sort_day")
def q_sort_day(spark, sf_dir):
    d = reports.daily_sentiment(enriched_posts(spark, sf_dir), days=list(range(1, 32)))
    return d.select("dayofmonth", "total_count", r9("avg_sentiment"), r9("avg_polarity")).orderBy("dayofmonth")


@query("agg_calendar_spine")
def q_agg_calendar_spine(spark, sf_dir):
    d = reports.calendar_spine(enriched_posts(spark, sf_dir), days_back=35)
    return d.select("day", "total_count", r9("avg_sentiment"))


@query("top_latest_posts")
def q_top_latest_posts(spark, sf_dir):
    return reports.latest_posts_of_posts(fixtures.posts(spark, sf_dir), enrich)


@query("prj_row_number")
def q_prj_row_number(spark, sf_dir):
    return reports.numbered_latest(reports.latest_posts_of_posts(fixtures.posts(spark, sf_dir), enrich))


@query("prj_series")
def q_prj_series(spark, sf_dir):
    return reports.series(reports.daily_sentiment(enriched_posts(spark, sf_dir)))


def _two_batches(spark, sf_dir):
    """Enriched posts in two batches that overlap by some days; the second also holds late posts."""
    e = enriched_posts(spark, sf_dir)
    day, late = F.to_date("created_at_date"), F.col("tweet_id") % 50 == 7
    return (e.where((day < F.lit(BATCH1_BEFORE).cast("date")) & ~late),
            e.where((day >= F.lit(BATCH2_FROM).cast("date")) | late))


@query("agg_daily_maintained")
def q_agg_daily_maintained(spark, sf_dir):
    """Daily sums kept up to date by two overlapping batches, the second one applied twice."""
    silver, daily = scratch_path(spark, "silver"), scratch_path(spark, "daily")
    first, second = _two_batches(spark, sf_dir)
    for k, batch in ((1, first), (2, second), (2, second)):
        plans.apply_batch(spark, batch, silver, daily, k)
    return plans.stored_daily(spark, daily).select("year", "month", "dayofmonth", "total_count",
                                                   r9("avg_sentiment"), r9("avg_polarity"))


@query("top_latest_stored")
def q_top_latest_stored(spark, sf_dir):
    """The latest posts read back from the newest months of the stored table."""
    silver = scratch_path(spark, "silver")
    for batch in _two_batches(spark, sf_dir):
        sinks.append_new(batch, silver, partition_by=plans.SILVER_PARTITIONS, grain=reports.DAY)
    return plans.latest_report(spark, silver)


@query("agg_hashtag_counts")
def q_agg_hashtag_counts(spark, sf_dir):
    return reports.hashtag_counts(fixtures.posts(spark, sf_dir))


@query("agg_mention_counts")
def q_agg_mention_counts(spark, sf_dir):
    return reports.mention_counts(fixtures.posts(spark, sf_dir))


@query("agg_clean_audit")
def q_agg_clean_audit(spark, sf_dir):
    return reports.clean_audit(fixtures.posts(spark, sf_dir))


@query("agg_row_counts")
def q_agg_row_counts(spark, sf_dir):
    return reports.row_counts(fixtures.posts(spark, sf_dir))


# ------------------------------------------------------------------ filters


@query("flt_hashtag")
def q_flt_hashtag(spark, sf_dir):
    return filters.hashtag(fixtures.posts(spark, sf_dir), "#en_click").select("tweet_id", "author_id")


@query("flt_since_id")
def q_flt_since_id(spark, sf_dir):
    p = fixtures.posts(spark, sf_dir)
    since = p.select(F.expr("max(tweet_id) div 2")).scalar()
    return filters.since_id(p, since).select("tweet_id", "author_id")


@query("flt_time_range")
def q_flt_time_range(spark, sf_dir):
    """Pull window: [today - 10 days 00:00, today 12:00) UTC, today = newest post day."""
    p = fixtures.posts(spark, sf_dir).withColumn(
        "_utc", ntz_from_epoch_seconds(epoch_ms_to_seconds("created_at")))
    today = p.select(F.max(F.to_date("_utc")).cast("timestamp_ntz")).scalar()
    start = F.timestamp_add("DAY", F.lit(-10), today)
    end = F.timestamp_add("HOUR", F.lit(12), today)
    return filters.time_range(p, start, end, "_utc").select("tweet_id", "author_id")


@query("flt_author")
def q_flt_author(spark, sf_dir):
    return filters.by_author(fixtures.posts(spark, sf_dir), 7).select("tweet_id", "author_id", "username")


@query("agg_max_id")
def q_agg_max_id(spark, sf_dir):
    return state.max_id_per_author(fixtures.posts(spark, sf_dir))


# ------------------------------------------------------------------ state


def _authors(p):
    return p.select("author_id").distinct()


@query("agg_latest_state")
def q_agg_latest_state(spark, sf_dir):
    log = fixtures.insert_log(fixtures.posts(spark, sf_dir), STATE_BEFORE)
    return state.latest_per_key(log, "author_id", "date_time", ["id"])


@query("state_raw")
def q_state_raw(spark, sf_dir):
    p = fixtures.posts(spark, sf_dir)
    return state.raw_state(_authors(p), fixtures.insert_log(p, STATE_BEFORE))


@query("state_pull")
def q_state_pull(spark, sf_dir):
    p = fixtures.posts(spark, sf_dir)
    return state.pull_state(_authors(p), fixtures.loaded_before(p, STATE_BEFORE))


@query("state_processed")
def q_state_processed(spark, sf_dir):
    p = fixtures.posts(spark, sf_dir)
    return state.processed_state(_authors(p), fixtures.processed_log(p, STATE_BEFORE))


@query("state_pull_stream")
def q_state_pull_stream(spark, sf_dir):
    """The pull state kept by a stream over the landed files of the days loaded so far."""
    p = fixtures.posts(spark, sf_dir)
    root, ckpt = scratch_path(spark, "landing"), scratch_path(spark, "marks")
    files.land_json(fixtures.loaded_before(p, STATE_BEFORE), root, 1)
    jobs.marks_stream(jobs.read_landed_stream(spark, root), ckpt, "author_id", "tweet_id", [])
    return state.pull_state(_authors(p), jobs.stream_marks(spark, ckpt, "author_id", "tweet_id", []))


def _log_marks(spark, log, value):
    """The newest row per author of a log, kept by a stream over the log's files."""
    path, ckpt = scratch_path(spark, "log"), scratch_path(spark, "marks")
    sinks.append_log(log, path)
    stream = spark.readStream.schema(log.schema).parquet(path)
    jobs.marks_stream(stream, ckpt, "author_id", "date_time", [value])
    return jobs.stream_marks(spark, ckpt, "author_id", "date_time", [value])


@query("state_raw_stream")
def q_state_raw_stream(spark, sf_dir):
    p = fixtures.posts(spark, sf_dir)
    return state.raw_state(_authors(p), _log_marks(spark, fixtures.insert_log(p, STATE_BEFORE), "id"))


@query("state_processed_stream")
def q_state_processed_stream(spark, sf_dir):
    p = fixtures.posts(spark, sf_dir)
    return state.processed_state(_authors(p), _log_marks(spark, fixtures.processed_log(p, STATE_BEFORE), "file_modified_date"))


@query("top_latest_state")
def q_top_latest_state(spark, sf_dir):
    log = fixtures.insert_log(fixtures.posts(spark, sf_dir), STATE_BEFORE)
    return log.orderBy(F.col("date_time").desc(), F.col("author_id").desc(), F.col("id").desc()) \
        .select("author_id", "id", "date_time").limit(1)


@query("flt_id_watermark")
def q_flt_id_watermark(spark, sf_dir):
    p = fixtures.posts(spark, sf_dir)
    st = state.raw_state(_authors(p), fixtures.insert_log(p, STATE_BEFORE))
    return state.above_watermark(p, st).select("tweet_id", "author_id")


@query("join_state_lookup")
def q_join_state_lookup(spark, sf_dir):
    p = fixtures.posts(spark, sf_dir)
    st = state.raw_state(_authors(p), fixtures.insert_log(p, STATE_BEFORE))
    return state.lookup_state(p, st).select("tweet_id", "author_id", "last_id")


@query("join_dedupe_anti")
def q_join_dedupe_anti(spark, sf_dir):
    p = fixtures.posts(spark, sf_dir)
    incoming = p.where(fixtures.post_day() >= F.lit(INCOMING_FROM).cast("date"))
    loaded = fixtures.loaded_before(p, STATE_BEFORE)
    return state.not_loaded(incoming, loaded).select("tweet_id")


@query("set_dedupe_posts")
def q_set_dedupe_posts(spark, sf_dir):
    p = fixtures.posts(spark, sf_dir)
    a = fixtures.loaded_before(p, STATE_BEFORE).select("tweet_id", "likes", F.lit(1).alias("load_ts"))
    b = (p.where(fixtures.post_day() >= F.lit(INCOMING_FROM).cast("date"))
         .select("tweet_id", (F.col("likes") + 1000).alias("likes"), F.lit(2).alias("load_ts")))
    return state.dedupe_latest(a.unionByName(b), "tweet_id", "load_ts")


# ------------------------------------------------------------------ landed pages -> flat posts



def _landed_pages(spark, sf_dir, post_rows=None, with_orphans=True):
    p = fixtures.posts(spark, sf_dir) if post_rows is None else post_rows
    path = pages.land_pages(fixtures.response_pages(p, with_orphans), scratch_path(spark, "pages"))
    return pages.read_pages(spark, path)


def _flat_out(df):
    return df.select(*[c for c in POST_COLUMNS if c not in ("attach_list", "referenced_tweets_list")],
                     F.array_join("attach_list.media_keys", ",").alias("media_keys"),
                     F.col("referenced_tweets_list")[0]["data"]["type"].alias("ref_type"),
                     F.col("referenced_tweets_list")[0]["data"]["id"].alias("ref_id"))


@query("src_flatten_timeline")
def q_src_flatten_timeline(spark, sf_dir):
    return _flat_out(pages.flatten_pages(_landed_pages(spark, sf_dir)))


@query("src_flatten_search")
def q_src_flatten_search(spark, sf_dir):
    """Search pages hold only the posts with the queried hashtag; a missing user stops the job."""
    hits = filters.hashtag(fixtures.posts(spark, sf_dir), "#en_click")
    flat = pages.flatten_pages(_landed_pages(spark, sf_dir, hits, with_orphans=False), on_orphan="raise")
    return _flat_out(flat)


@query("src_pages_window")
def q_src_pages_window(spark, sf_dir):
    """Posts of a pull window, read from pages stored with their bounds: pages that end before the
    window or the id are skipped by the scan; authors are those of the pages that are read."""
    p = fixtures.posts(spark, sf_dir)
    path = pages.store_pages(fixtures.response_pages(p, in_order=True), scratch_path(spark, "page_table"), in_order=True)
    since, start, end = p.agg(F.expr("max(tweet_id) div 2"), F.expr("max(bigint(created_at)) - 864000000"),
                              F.expr("max(bigint(created_at)) - 86400000")).first()
    flat = pages.window_posts(spark, path, since_id=since, start_ms=start, end_ms=end)
    return flat.select("tweet_id", "author_id", "username", "author_followers", "created_at")


@query("prj_post_fields")
def q_prj_post_fields(spark, sf_dir):
    """Tweet-level fields out of the nested page records (no user join)."""
    t = pages._tweets(_landed_pages(spark, sf_dir))  # noqa: SLF001
    return t.select("tweet_id", "author_id", "created_at", "retweets", "replies", "likes",
                    "quote_count", "conversation_id", F.array_join("attach_list.media_keys", ",").alias("media_keys"))


@query("join_post_author")
def q_join_post_author(spark, sf_dir):
    flat = pages.flatten_pages(_landed_pages(spark, sf_dir))
    return flat.select("tweet_id", "author_id", "username", "author_followers", "author_tweets",
                       "author_location")


@query("join_post_author_orphans")
def q_join_post_author_orphans(spark, sf_dir):
    return pages.orphan_posts(_landed_pages(spark, sf_dir)).select("tweet_id", "author_id")


# ------------------------------------------------------------------ landed files


def _land_batches(spark, sf_dir, overlapping=True):
    p = fixtures.posts(spark, sf_dir)
    root = scratch_path(spark, "landing")
    day = fixtures.post_day()
    files.land_json(p.where(day < F.lit(BATCH1_BEFORE).cast("date")), root, 1)
    second_from = BATCH2_FROM if overlapping else BATCH1_BEFORE
    files.land_json(p.where(day >= F.lit(second_from).cast("date")), root, 2)
    return root


@query("src_json_incremental")
def q_src_json_incremental(spark, sf_dir):
    """After batch 1 was processed (its files are in the processed-file table), read what is new."""
    root = _land_batches(spark, sf_dir)
    processed = files.list_files(spark, root).where(F.col("batch") == 1).select("_file_path")
    return files.read_landed(spark, root, processed_files=processed).select("tweet_id", "author_id", "batch")


@query("src_json_past_mark")
def q_src_json_past_mark(spark, sf_dir):
    """The same without a look at what is processed: only the folders of pulls past the mark are listed."""
    root = _land_batches(spark, sf_dir)
    return files.read_landed(spark, root, after_batch=1).select("tweet_id", "author_id", "batch")


@query("set_union_versions")
def q_set_union_versions(spark, sf_dir):
    """Two versions of a post file in one read: batch 2 has no quote_count and two fields more."""
    p, root = fixtures.posts(spark, sf_dir), scratch_path(spark, "landing")
    day = fixtures.post_day()
    files.land_json(p.where(day < F.lit(BATCH1_BEFORE).cast("date")), root, 1)
    newer = p.where(day >= F.lit(BATCH2_FROM).cast("date")).drop("quote_count").withColumns(
        {"impressions": F.col("likes") * 10, "edits": F.struct(F.col("replies").alias("n"))})
    files.land_json(newer, root, 2)
    u = files.read_versions(spark, root)
    return u.select("tweet_id", "author_id", "quote_count", "batch", F.to_json("other_fields").alias("other_fields"))


@query("flt_file_newer")
def q_flt_file_newer(spark, sf_dir):
    """Marker = newest file time of batch 1, fixed for the read; keep files strictly newer."""
    root = _land_batches(spark, sf_dir)
    marker = files.list_files(spark, root).where(F.col("batch") == 1).select(F.max("_file_mtime")).scalar()
    return files.read_landed(spark, root, modified_after=marker).select("tweet_id", "author_id", "batch")


@query("src_json_direct")
def q_src_json_direct(spark, sf_dir):
    root = _land_batches(spark, sf_dir)
    df = files.read_json_direct(spark, f"{root}/batch=1")
    return df.select("tweet_id", "author_id", "username", "likes", "created_at")


@query("src_json_latest")
def q_src_json_latest(spark, sf_dir):
    root = _land_batches(spark, sf_dir)
    return files.latest_batch_rows(spark, root).select("tweet_id", "author_id", "batch")


@query("set_union_files")
def q_set_union_files(spark, sf_dir):
    """All landed files in one scan (bag union of the pulls, no dedupe)."""
    root = _land_batches(spark, sf_dir)
    return files.read_landed(spark, root).select("tweet_id", "batch")


@query("flt_file_prefix")
def q_flt_file_prefix(spark, sf_dir):
    root = _land_batches(spark, sf_dir)
    return files.read_landed(spark, root, author=1).select("tweet_id", "author_id", "batch")


@query("flt_file_nonempty")
def q_flt_file_nonempty(spark, sf_dir):
    """An empty file landed beside the pulls is skipped without error."""
    root = _land_batches(spark, sf_dir)
    sinks.touch_empty(spark, f"{root}/batch=3/author_bucket=1/part-empty.json")
    rows = files.read_landed(spark, root)
    return rows.groupBy("batch").agg(F.count(F.lit(1)).alias("n"))


@query("prj_file_keys")
def q_prj_file_keys(spark, sf_dir):
    root = _land_batches(spark, sf_dir)
    return files.author_files(spark, root).select("batch", "author_id").distinct()


@query("agg_max_file_time")
def q_agg_max_file_time(spark, sf_dir):
    """The batch of each author's newest file (its time itself is the wall clock's)."""
    root = _land_batches(spark, sf_dir)
    newest = files.newest_file_time(files.author_files(spark, root))
    return newest.select("author_id", F.col("newest_batch").cast("int").alias("newest_batch"))


@query("top_latest_file")
def q_top_latest_file(spark, sf_dir):
    root = _land_batches(spark, sf_dir)
    fl = files.list_files(spark, root)
    return fl.orderBy(F.col("_file_mtime").desc(), F.col("_file_path").desc()).select("batch").limit(1)


# ------------------------------------------------------------------ sinks


@query("snk_json_local")
def q_snk_json_local(spark, sf_dir):
    p = fixtures.posts(spark, sf_dir).select("tweet_id", "author_id", "likes", "created_at")
    path = sinks.write_json(p, scratch_path(spark, "json"))
    return spark.read.schema(p.schema).json(path)


@query("snk_json_batch")
def q_snk_json_batch(spark, sf_dir):
    """Write only rows above each author's pull watermark (checked per row)."""
    p = fixtures.posts(spark, sf_dir)
    st = state.pull_state(_authors(p), fixtures.loaded_before(p, STATE_BEFORE))
    new = state.above_watermark(p, st).select("tweet_id", "author_id")
    path = sinks.write_json(new, scratch_path(spark, "json"))
    return spark.read.schema(new.schema).json(path)


@query("snk_raw_append")
def q_snk_raw_append(spark, sf_dir):
    """Batch 1, batch 2 (overlapping), then batch 1 again: every id once."""
    root = _land_batches(spark, sf_dir)
    target = scratch_path(spark, "raw")
    for b in (1, 2, 1):
        batch = files.read_landed(spark, root).where(F.col("batch") == b).drop(*files.FILE_COLUMNS, "batch")
        sinks.append_raw(batch, target)
    return sinks.read_table(spark, target).select("tweet_id", "author_id", "likes")


@query("snk_enriched_append")
def q_snk_enriched_append(spark, sf_dir):
    p = fixtures.posts(spark, sf_dir)
    day = fixtures.post_day()
    target = scratch_path(spark, "silver")
    for part in (p.where(day < F.lit(BATCH1_BEFORE).cast("date")),
                 p.where(day >= F.lit(BATCH2_FROM).cast("date"))):
        sinks.append_new(enrich(part), target, partition_by=("year", "month"), grain=reports.DAY)
    return spark.read.parquet(target).select("tweet_id", "year", "month", "dayofmonth",
                                             "sentiment_label", "sentiment_score")


@query("snk_state_latest")
def q_snk_state_latest(spark, sf_dir):
    """Per-author state objects (JSON), overwritten by a later run, read back typed."""
    p = fixtures.posts(spark, sf_dir)
    path = scratch_path(spark, "state")
    sinks.write_state_objects(state.pull_state(_authors(p), fixtures.loaded_before(p, STATE_BEFORE)), path)
    sinks.write_state_objects(state.pull_state(_authors(p), p), path)
    return sinks.read_state_objects(spark, path, "author_id long, last_id long")


@query("snk_state_log_raw")
def q_snk_state_log_raw(spark, sf_dir):
    p = fixtures.posts(spark, sf_dir)
    path = scratch_path(spark, "insert_log")
    first = fixtures.insert_log(p, STATE_BEFORE)
    second = fixtures.insert_log(p, "2024-01-20").join(first, ["author_id", "id", "date_time"], "left_anti")
    for rows in (first, second, second):                    # a replay writes no second row
        sinks.append_log(rows, path, once_by=("author_id", "id", "date_time"))
    return sinks.read_latest_log(spark, path, "author_id", "date_time", ["id"])


@query("snk_state_log_processed")
def q_snk_state_log_processed(spark, sf_dir):
    p = fixtures.posts(spark, sf_dir)
    path = scratch_path(spark, "processed_log")
    first = fixtures.processed_log(p, STATE_BEFORE)
    second = fixtures.processed_log(p, "2024-01-20").join(first, ["author_id", "date_time"], "left_anti")
    sinks.append_log(first, path)
    sinks.append_log(second, path)
    return sinks.read_latest_log(spark, path, "author_id", "date_time", ["file_modified_date"])


# ------------------------------------------------------------------ streaming


@query("str_ingest")
def q_str_ingest(spark, sf_dir):
    """File stream over two overlapping pulls, run twice: every id once."""
    root = _land_batches(spark, sf_dir)
    target, ckpt = scratch_path(spark, "stream_raw"), scratch_path(spark, "stream_ckpt")
    jobs.ingest_stream(spark, root, target, ckpt, max_files_per_trigger=1000)
    jobs.ingest_stream(spark, root, target, ckpt)
    return sinks.read_table(spark, target).select("tweet_id", "author_id")


@query("str_daily_sentiment")
def q_str_daily_sentiment(spark, sf_dir):
    """Daily counts over two overlapping pulls: a post landed twice counts once."""
    root = _land_batches(spark, sf_dir)
    target, ckpt = scratch_path(spark, "stream_daily"), scratch_path(spark, "stream_ckpt")
    jobs.daily_sentiment_stream(spark, root, target, ckpt, mode="complete", max_files_per_trigger=1000)
    return spark.read.parquet(target).select("day", "total_count", r9("avg_sentiment"))


@query("str_daily_bounded")
def q_str_daily_bounded(spark, sf_dir):
    """Eight pulls of five days, each landed and then taken in one trigger, with posts that come two pulls late
    and posts that come in two pulls: the closed days, and how many posts of theirs came too late."""
    day = F.dayofmonth(fixtures.post_day())
    pull = F.least(F.floor((day - 1) / 5), F.lit(5)).cast("int")
    pulls = (F.when(F.col("tweet_id") % 50 == 7, F.array(pull + 2)).when(F.col("tweet_id") % 20 == 3, F.array(pull, pull + 1))
             .otherwise(F.array(pull)))
    written = files.write_pulls(fixtures.posts(spark, sf_dir), pulls, scratch_path(spark, "pulls"))
    root = scratch_path(spark, "landing")
    target, state, late, ckpt = (scratch_path(spark, f"bounded_{x}") for x in ("days", "state", "late", "ckpt"))
    for k in range(8):
        files.land_pull(spark, written, root, k)
        jobs.daily_sentiment_bounded(spark, root, target, state, late, ckpt)
    too_late = spark.read.parquet(late).groupBy("day").agg(F.count(F.lit(1)).alias("late_posts"))
    return jobs.closed_days(spark, target).join(too_late, "day", "left").select(
        "day", "total_count", r9("avg_sentiment"), F.coalesce("late_posts", F.lit(0)).alias("late_posts"))


# ------------------------------------------------------------------ extensions


def _mentions(spark, sf_dir, post_rows=None, keep=()):
    p = fixtures.posts(spark, sf_dir) if post_rows is None else post_rows
    return extensions.ticker_mentions(p, fixtures.assets(spark, sf_dir), keep=keep)


@query("ext_ticker_mentions")
def q_ext_ticker_mentions(spark, sf_dir):
    return _mentions(spark, sf_dir).select("tweet_id", "symbol", "asset_id")


@query("ext_price_asof")
def q_ext_price_asof(spark, sf_dir):
    p = fixtures.posts(spark, sf_dir).withColumn(
        "ts", ntz_from_epoch_seconds(epoch_ms_to_seconds("created_at")))
    m = _mentions(spark, sf_dir, p, keep=("ts",))
    out = extensions.price_asof(m.select("tweet_id", "symbol", "ts"), fixtures.daily_prices(spark, sf_dir))
    return out.select("tweet_id", "symbol", "price_time", r9("price"))


@query("ext_price_asof_ticks")
def q_ext_price_asof_ticks(spark, sf_dir):
    """The last tick at or before each mention, over all ticks of the symbol."""
    p = fixtures.posts(spark, sf_dir).withColumn(
        "ts", ntz_from_epoch_seconds(epoch_ms_to_seconds("created_at")))
    m = _mentions(spark, sf_dir, p, keep=("ts",)).select("tweet_id", "symbol", "ts")
    ticks = fixtures.price_ticks(spark, sf_dir).withColumn("price_time", parse_timestamp_text("tick_time"))
    return extensions.price_asof_ticks(m, ticks).select("tweet_id", "symbol", "ts", "price_time", "price")


@query("ext_sentiment_price_corr")
def q_ext_sentiment_price_corr(spark, sf_dir):
    e = enrich(fixtures.posts(spark, sf_dir)).withColumn("polarity", extensions.polarity())
    em = _mentions(spark, sf_dir, e, keep=("created_at_date", "polarity"))
    out = extensions.sentiment_price_corr(em, fixtures.daily_prices(spark, sf_dir))
    return out.select("symbol", r9("corr"), "days")


@query("ext_multi_author")
def q_ext_multi_author(spark, sf_dir):
    """Many authors: a followed-author table (users with a signup event) by semi-join, state per author."""
    followed = fixtures.followed_authors(spark, sf_dir)
    p = filters.by_author(fixtures.posts(spark, sf_dir), followed)
    return p.groupBy("author_id").agg(F.count(F.lit(1)).alias("n_posts"), F.max("tweet_id").alias("max_id"))


@query("src_report_table")
def q_src_report_table(spark, sf_dir):
    """The report read back from the stored enriched table (the report's source)."""
    silver = scratch_path(spark, "silver")
    sinks.append_new(enrich(fixtures.posts(spark, sf_dir)), silver, partition_by=("year", "month"), grain=reports.DAY)
    return reports.daily_rounded(reports.daily_sentiment(spark.read.parquet(silver)))


@query("prj_sentiment")
def q_prj_sentiment(spark, sf_dir):
    """Label and score from one struct-valued scorer column, split with `select('s.*')`."""
    cleaned = add_clean_text(fixtures.posts(spark, sf_dir))
    scored = sentiment.score_struct(cleaned)
    return scored.select("tweet_id", "s.*").withColumnsRenamed(
        {"label": "sentiment_label", "score": "sentiment_score"})
