"""Report queries over enriched posts, and the tag/mention counts.

Every aggregation here is algebraic (count, sum, avg, max), so Spark combines
map-side before the shuffle: a hot day, tag or author costs one partial row per
task, not one row per post.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlytics import config as C
from postlytics.session import ensure_checkpoint_dir
from postlytics.functions.text import (
    count_matches, extract_hashtags, extract_mentions, remove_links, remove_punctuation,
)


def polarity(label_col: str = "sentiment_label", score_col: str = "sentiment_score"):
    """Signed score: +score for Positive, -score for Negative, 0 for Neutral (null stays null)."""
    lab = F.col(label_col)
    return (F.when(lab == C.LABEL_POSITIVE, F.col(score_col))
            .when(lab == C.LABEL_NEGATIVE, -F.col(score_col))
            .when(lab == C.LABEL_NEUTRAL, F.lit(0.0)))


def _measures():
    # the mean of the winner's confidence (as the reference reports it) and, beside it,
    # the mean signed polarity, which does not mix positive and negative confidence
    return [F.count(F.lit(1)).alias("total_count"),
            F.avg("sentiment_score").alias("avg_sentiment"),
            F.avg(polarity()).alias("avg_polarity")]


def daily_sentiment(enriched: DataFrame, days: list[int] | None = None) -> DataFrame:
    """Count and mean score per day of month (months and years share a day), days ascending."""
    days = C.REPORT_DAYS if days is None else days
    return (enriched.where(F.col("dayofmonth").isin(days))
            .groupBy("dayofmonth").agg(*_measures())
            .orderBy("dayofmonth"))


def daily_rounded(daily: DataFrame) -> DataFrame:
    """The chart's numbers: both rounded to 2 places, the count as a double."""
    return daily.select("dayofmonth",
                        F.round(F.col("total_count").cast("double"), 2).alias("total_count"),
                        F.round("avg_sentiment", 2).alias("avg_sentiment"))


def calendar_sentiment(enriched: DataFrame) -> DataFrame:
    """Same measures per real calendar day (year, month, dayofmonth)."""
    return (enriched.groupBy("year", "month", "dayofmonth").agg(*_measures())
            .orderBy("year", "month", "dayofmonth"))


DAY = ("year", "month", "dayofmonth")
SUMS = ("total_count", "scored", "score_sum", "polar", "polarity_sum")


def daily_sums(enriched: DataFrame) -> DataFrame:
    """Per local day the sums that means are made of; those of two sets of posts add up."""
    return enriched.groupBy(*DAY).agg(
        F.count(F.lit(1)).alias("total_count"), F.count("sentiment_score").alias("scored"),
        F.coalesce(F.sum("sentiment_score"), F.lit(0.0)).alias("score_sum"),
        F.count(polarity()).alias("polar"), F.coalesce(F.sum(polarity()), F.lit(0.0)).alias("polarity_sum"))


def daily_of_sums(sums: DataFrame) -> DataFrame:
    """The measures of `calendar_sentiment` from stored sums."""
    return sums.select(*DAY, "total_count",
                       F.try_divide("score_sum", "scored").alias("avg_sentiment"),
                       F.try_divide("polarity_sum", "polar").alias("avg_polarity"))


def merge_daily(new: DataFrame, path: str, batch_id: int) -> None:
    """Add the posts of one batch to the daily sums stored at `path`, partitioned by (year, month).

    Only the months that the batch touches are read and written again, late posts' months included.
    Each row keeps the last batch that went into its month (`upto`): a month that already holds
    this batch is left as it is, so a repeated call adds nothing.
    """
    spark = new.sparkSession
    ensure_checkpoint_dir(spark)
    delta = daily_sums(new).withColumn("upto", F.lit(batch_id).cast("long")).checkpoint()     # one row a day
    months = [(r.year, r.month) for r in delta.select("year", "month").distinct().collect()]
    if not months:
        return
    touched = F.lit(False)
    for y, m in months:
        touched = touched | (F.col("year").eqNullSafe(F.lit(y)) & F.col("month").eqNullSafe(F.lit(m)))
    try:
        old = spark.read.schema(delta.schema).parquet(path).where(touched)
    except AnalysisException:                                   # no table yet
        old = delta.where(F.lit(False))
    done = old.groupBy("year", "month").agg((F.max("upto") >= batch_id).alias("done")).where("done")
    fresh = delta.alias("d").join(done.alias("o"), F.col("d.year").eqNullSafe(F.col("o.year"))
                                  & F.col("d.month").eqNullSafe(F.col("o.month")), "left_anti")
    todo = fresh.select("year", "month").distinct().withColumnsRenamed({"year": "_y", "month": "_m"})
    both = old.join(todo, old["year"].eqNullSafe(todo["_y"]) & old["month"].eqNullSafe(todo["_m"]), "left_semi").unionByName(fresh)
    merged = both.groupBy(*DAY).agg(*[F.sum(c).alias(c) for c in SUMS]).withColumn("upto", F.lit(batch_id).cast("long"))
    merged = merged.checkpoint()                                # read wholly before its folders are replaced
    (merged.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("year", "month").parquet(path))


def calendar_spine(enriched: DataFrame, days_back: int = 35, end_date=None) -> DataFrame:
    """Every local day of [end - days_back + 1, end] with its count (0 when empty).

    `end_date` defaults to the newest local day in the data, taken from the daily rows (posts are
    read once); the spine is made by `sequence` + `explode` from that one-row aggregate (never by a
    cross join).
    """
    daily = (enriched.groupBy(F.to_date("created_at_date").alias("day"))
             .agg(F.count(F.lit(1)).alias("total_count"),
                  F.avg("sentiment_score").alias("avg_sentiment")))
    ensure_checkpoint_dir(enriched.sparkSession)
    daily = daily.checkpoint()                                  # one row a day
    end = F.lit(end_date).cast("date") if end_date is not None else F.max("day")
    spine = (daily.agg(end.alias("_end"))
             .select(F.explode(F.sequence(F.date_sub("_end", days_back - 1), F.col("_end"))).alias("day")))
    return (spine.join(daily, "day", "left")
            .select("day", F.coalesce("total_count", F.lit(0)).alias("total_count"), "avg_sentiment")
            .orderBy("day"))


def latest_posts(enriched: DataFrame, n: int = C.LATEST_POSTS_LIMIT) -> DataFrame:
    """Newest n posts, newest first; ties broken by tweet_id (TakeOrderedAndProject)."""
    return (enriched.orderBy(F.col("created_at_date").desc(), F.col("tweet_id").desc())
            .select("tweet_id", *C.REPORT_COLUMNS).limit(n))


def latest_posts_of_posts(post_rows: DataFrame, enrich_fn, n: int = C.LATEST_POSTS_LIMIT,
                          zone: str = C.LOCAL_TIME_ZONE) -> DataFrame:
    """Same rows as `latest_posts(enrich_fn(post_rows))`, but the top-k is taken on
    the cheap local-time column first and only the n winners are cleaned and scored."""
    from postlytics.functions.timeparts import epoch_ms_to_seconds, to_local_time

    keyed = post_rows.withColumn("_local", to_local_time(epoch_ms_to_seconds("created_at"), zone))
    # the top-k runs as TakeOrderedAndProject on the raw rows; after the global limit the
    # n rows sit in one partition, so coalesce(1) moves nothing -- it only keeps the
    # optimizer from pushing the cleaning/scoring projections below the limit (which
    # would turn the top-k into a full sort of every post)
    top = keyed.orderBy(F.col("_local").desc(), F.col("tweet_id").desc()).limit(n).coalesce(1).drop("_local")
    return latest_posts(enrich_fn(top), n)


def numbered_latest(top: DataFrame) -> DataFrame:
    """The latest-posts table with its 1-based row number (numbered after the top-k)."""
    w = Window.orderBy(F.col("created_at_date").desc(), F.col("tweet_id").desc())
    return top.withColumn("row_no", F.row_number().over(w))


def series(daily: DataFrame) -> DataFrame:
    """Three aligned lists for a chart: day labels, mean scores (2 places), counts.

    `daily` holds one row per day (at most 31), so one bounded list is collected.
    """
    pts = F.sort_array(F.collect_list(F.struct("dayofmonth", "avg_sentiment", "total_count")))
    return (daily.agg(pts.alias("_p"))
            .select(F.transform("_p", lambda x: x["dayofmonth"]).alias("labels"),
                    F.transform("_p", lambda x: F.round(x["avg_sentiment"], 2)).alias("averages"),
                    F.transform("_p", lambda x: x["total_count"].cast("double")).alias("counts")))


def hashtag_counts(post_rows: DataFrame, text_col: str = "text") -> DataFrame:
    """How often each hashtag occurs in the raw text (what cleaning throws away)."""
    return (post_rows.select(F.explode(extract_hashtags(text_col)).alias("hashtag"))
            .groupBy("hashtag").agg(F.count(F.lit(1)).alias("n")))


def mention_counts(post_rows: DataFrame, text_col: str = "text") -> DataFrame:
    return (post_rows.select(F.explode(extract_mentions(text_col)).alias("mention"))
            .groupBy("mention").agg(F.count(F.lit(1)).alias("n")))


def clean_audit(post_rows: DataFrame, text_col: str = "text") -> DataFrame:
    """Per author: links, handles, hashtags removed and characters lost by cleaning.

    Matches are counted at the step of the chain where they are removed.  Each
    step of the chain is its own column, so every regex pass runs once per row.
    """
    steps = (post_rows.select("author_id", F.col(text_col).alias("_t"))
             .withColumn("_no_links", remove_links("_t"))
             .withColumn("_no_rt", F.regexp_replace("_no_links", C.RETWEET_PATTERN, ""))
             .withColumn("_no_users", F.regexp_replace("_no_rt", C.HANDLE_PATTERN, ""))
             .withColumn("_no_punct", remove_punctuation("_no_users")))
    per_row = steps.select(
        "author_id",
        count_matches("_t", C.LINK_PATTERN).alias("links"),
        (count_matches("_no_links", C.RETWEET_PATTERN) + count_matches("_no_rt", C.HANDLE_PATTERN)).alias("handles"),
        count_matches("_no_punct", C.HASHTAG_PATTERN).alias("hashtags"),
        (F.length("_t") - F.length(F.regexp_replace("_no_punct", C.HASHTAG_PATTERN, ""))).alias("chars_lost"),
    )
    return per_row.groupBy("author_id").agg(
        F.count(F.lit(1)).alias("posts"),
        F.sum("links").alias("links"), F.sum("handles").alias("handles"),
        F.sum("hashtags").alias("hashtags"), F.sum("chars_lost").alias("chars_lost"))


def row_counts(df: DataFrame, created_col: str = "created_at") -> DataFrame:
    """Rows, and rows whose created_at text is not an epoch-ms number."""
    bad = F.col(created_col).try_cast("bigint").isNull()
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.sum(F.when(bad, 1).otherwise(0)).alias("n_bad_created_at"))
