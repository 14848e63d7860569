"""Tables derived by Spark from the driver's parquet tables.

`posts` decorates each event with the whole text of one document so that every
cleaning rule has something to do (a retweet handle, a link, two hashtags and
sometimes a ticker).  All derived tables grow with the input tables; none is
made-up fixed input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlytics import config as C
from postlytics.functions.timeparts import epoch_ms_of_ntz
from postlytics.schema import POST_COLUMNS
from postlytics.sources.tables import table


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat posts (POST_SCHEMA): events joined to documents by `event_id % n_docs`.

    Both sides are dealt by doc_id over a stated number of partitions, so the text work on the
    posts is spread however few row groups the documents have, and posts are never broadcast.
    """
    events = table(spark, sf_dir, "events")
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("doc_text"), "lang")
    n_docs = docs.select(F.count(F.lit(1))).scalar()       # scalar subquery, stays in the plan
    keyed = events.withColumn("doc_id", F.col("event_id") % n_docs)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    joined = keyed.repartition(parts, "doc_id").join(docs.repartition(parts, "doc_id").hint("merge"), "doc_id", "inner")
    e, u = F.col("event_id"), F.col("user_id")
    ticker = F.when(e % 4 == 0, F.concat(F.lit(" $P"), ((e / 4).cast("bigint") % 5 + 1).cast("string"))) \
        .otherwise(F.lit(""))
    text = F.concat(
        F.lit("RT @user_"), u.cast("string"), F.lit(": "), F.col("doc_text"),
        F.lit(" http://t.co/"), e.cast("string"),
        F.lit(" #"), F.col("lang"), F.lit("_"), F.col("event_type"),
        F.lit(" #"), F.col("lang"), F.lit("x"), ticker,
    )
    media = F.when(F.col("event_type") == "view", F.struct(
        F.array(F.concat(e.cast("string"), F.lit("_1")), F.concat(e.cast("string"), F.lit("_2")))
        .alias("media_keys")))
    refs = F.when((e % 3 == 0) & (e > 0), F.array(F.struct(F.struct(
        F.lit("replied_to").alias("type"), (e - 1).cast("string").alias("id")).alias("data"))))
    out = joined.select(
        u.alias("author_id"),
        F.concat(F.lit("user_"), u.cast("string")).alias("username"),
        (u * 37 + 100).cast("bigint").alias("author_followers"),
        (u * 11 + 5).cast("bigint").alias("author_tweets"),
        F.concat(F.lit("about user "), u.cast("string")).alias("author_description"),
        F.when(u % 4 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("city_"), (u % 10).cast("string"))).alias("author_location"),
        e.alias("tweet_id"),
        text.alias("text"),
        epoch_ms_of_ntz("ts").cast("string").alias("created_at"),
        F.floor("value").cast("int").alias("retweets"),
        (e % 7).cast("int").alias("replies"),
        F.get_json_object("props", "$.k").cast("int").alias("likes"),
        (e % 3).cast("int").alias("quote_count"),
        (e / 10).cast("bigint").alias("conversation_id"),
        media.alias("attach_list"),
        refs.alias("referenced_tweets_list"),
    )
    return out.select(*POST_COLUMNS)


def page_no(tweet_id: Column) -> Column:
    """Pages of at most 100 posts (the API page size), in id order."""
    return (tweet_id / 100).cast("bigint")


def user_included(author_id: Column, page: Column) -> Column:
    """Which page carries a user record: some users never (orphans), some only on odd pages."""
    return ~(author_id % 50 == 7) & ~((author_id % 50 == 3) & (page % 2 == 0))


def response_pages(post_rows: DataFrame, with_orphans: bool = True, in_order: bool = False) -> DataFrame:
    """Group posts into API response pages (PAGE_SCHEMA); each page holds <= 100 posts.

    A user's counters grow with the page number, so "the later record wins" is visible.
    `in_order` deals the posts by ranges of page numbers, so that the pages come in the order of ids.
    """
    p = post_rows.withColumn("page_no", page_no(F.col("tweet_id")))
    p = p.repartitionByRange("page_no") if in_order else p.repartition("page_no")
    tweet = F.struct(
        F.col("tweet_id").alias("id"), "author_id", "text", "created_at",
        F.struct(F.col("retweets").alias("retweet_count"), F.col("replies").alias("reply_count"),
                 F.col("likes").alias("like_count"), F.col("quote_count").alias("quote_count"))
        .alias("public_metrics"),
        F.col("referenced_tweets_list").alias("referenced_tweets"),
        "conversation_id",
        F.col("attach_list").alias("attachments"),
    )
    user = F.struct(
        F.col("author_id").alias("id"), "username",
        F.col("author_description").alias("description"),
        F.col("author_location").alias("location"),
        F.struct((F.col("author_followers") + F.col("page_no")).alias("followers_count"),
                 (F.col("author_tweets") + F.col("page_no")).alias("tweet_count")).alias("public_metrics"),
    )
    keep = user_included(F.col("author_id"), F.col("page_no")) if with_orphans else F.lit(True)
    return (p.groupBy("page_no")
            .agg(F.collect_list(tweet).alias("data"),
                 F.array_distinct(F.collect_list(F.when(keep, user))).alias("users"))
            .select("page_no", "data", F.struct("users").alias("includes")))


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents joined to labels, with the three-class target.

    toxic = 1 -> Negative; else quality = 1 -> Positive; else Neutral.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels")
    label = (F.when(F.col("toxic") == 1, F.lit("Negative"))
             .when(F.col("quality") == 1, F.lit("Positive"))
             .otherwise(F.lit("Neutral")))
    return docs.join(labels, "doc_id").select("doc_id", "text", label.alias("label"))


def assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticker alias table: one asset per order priority, symbol 'P' + its digit."""
    o = table(spark, sf_dir, "orders")
    k = F.substring("o_orderpriority", 1, 1).cast("int")
    return (o.select(k.alias("asset_id"), F.col("o_orderpriority").alias("asset_name")).distinct()
            .withColumn("symbol", F.concat(F.lit("P"), F.col("asset_id").cast("string"))))


def daily_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A daily price series per symbol: mean order total per priority and day, moved 29 years on."""
    o = table(spark, sf_dir, "orders")
    symbol = F.concat(F.lit("P"), F.substring("o_orderpriority", 1, 1))
    day = F.add_months(F.to_date("o_orderdate"), 12 * 29)
    return (o.groupBy(symbol.alias("symbol"), day.alias("price_date"))
            .agg(F.avg("o_totalprice").alias("price")))


def price_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intraday prices: every purchase is a tick of the symbol its id picks; times are landed as text."""
    ev = table(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
    return ev.select(F.concat(F.lit("P"), (F.col("event_id") % 5 + 1).cast("string")).alias("symbol"),
                     F.date_format("ts", C.TIMESTAMP_TEXT_FORMAT).alias("tick_time"), F.col("value").alias("price"))


# ------------------------------------------------------------------ state logs
# Posts are taken to have been loaded once per UTC day, at midnight after
# that day.  `before` is the first day not loaded yet.

def post_day(created_at: Column | str = "created_at") -> Column:
    from postlytics.functions.timeparts import epoch_ms_to_seconds, ntz_from_epoch_seconds

    return F.to_date(ntz_from_epoch_seconds(epoch_ms_to_seconds(created_at)))


def loaded_before(post_rows: DataFrame, before: str) -> DataFrame:
    return post_rows.where(post_day() < F.lit(before).cast("date"))


def insert_log(post_rows: DataFrame, before: str) -> DataFrame:
    """author_id, id (newest id loaded that day), date_time (load time)."""
    day = post_day()
    return (post_rows.where(day < F.lit(before).cast("date"))
            .groupBy("author_id", day.alias("day")).agg(F.max("tweet_id").alias("id"))
            .select("author_id", "id",
                    F.timestamp_add("DAY", F.lit(1), F.col("day").cast("timestamp_ntz")).alias("date_time")))


def processed_log(post_rows: DataFrame, before: str) -> DataFrame:
    """author_id, file_modified_date (file landed 5 minutes after the day), date_time."""
    day = post_day()
    start = F.timestamp_add("DAY", F.lit(1), F.col("day").cast("timestamp_ntz"))
    return (post_rows.where(day < F.lit(before).cast("date"))
            .select("author_id", day.alias("day")).distinct()
            .select("author_id",
                    F.timestamp_add("MINUTE", F.lit(5), start).alias("file_modified_date"),
                    F.timestamp_add("MINUTE", F.lit(10), start).alias("date_time")))


def followed_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The author table of the many-author form: every user with a signup event."""
    ev = table(spark, sf_dir, "events")
    return ev.where(F.col("event_type") == "signup").select(F.col("user_id").alias("author_id")).distinct()
