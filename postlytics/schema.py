"""Explicit schemas: the flat post, the landed API response page, state rows."""

from pyspark.sql.types import (
    ArrayType, IntegerType, LongType, StringType, StructField, StructType,
    TimestampNTZType,
)

MEDIA = StructType([StructField("media_keys", ArrayType(StringType()), True)])
REFERENCED = ArrayType(StructType([
    StructField("data", StructType([
        StructField("type", StringType(), True),
        StructField("id", StringType(), True),
    ]), True),
]))

# --- fixed values: the 16 field names of the flat post and their order are the data format ---
# The flat post as landed (raw / bronze). Ids are Long; counters Int.
POST_SCHEMA = StructType([
    StructField("author_id", LongType(), True),
    StructField("username", StringType(), True),
    StructField("author_followers", LongType(), True),
    StructField("author_tweets", LongType(), True),
    StructField("author_description", StringType(), True),
    StructField("author_location", StringType(), True),
    StructField("tweet_id", LongType(), True),
    StructField("text", StringType(), True),
    StructField("created_at", StringType(), True),
    StructField("retweets", IntegerType(), True),
    StructField("replies", IntegerType(), True),
    StructField("likes", IntegerType(), True),
    StructField("quote_count", IntegerType(), True),
    StructField("conversation_id", LongType(), True),
    StructField("attach_list", MEDIA, True),
    StructField("referenced_tweets_list", REFERENCED, True),
])
POST_COLUMNS = [f.name for f in POST_SCHEMA.fields]

# One API response page: tweets plus the users they reference.
TWEET = StructType([
    StructField("id", LongType(), True),
    StructField("author_id", LongType(), True),
    StructField("text", StringType(), True),
    StructField("created_at", StringType(), True),
    StructField("public_metrics", StructType([
        StructField("retweet_count", IntegerType(), True),
        StructField("reply_count", IntegerType(), True),
        StructField("like_count", IntegerType(), True),
        StructField("quote_count", IntegerType(), True),
    ]), True),
    StructField("referenced_tweets", REFERENCED, True),
    StructField("conversation_id", LongType(), True),
    StructField("attachments", MEDIA, True),
])
USER = StructType([
    StructField("id", LongType(), True),
    StructField("username", StringType(), True),
    StructField("description", StringType(), True),
    StructField("location", StringType(), True),
    StructField("public_metrics", StructType([
        StructField("followers_count", LongType(), True),
        StructField("tweet_count", LongType(), True),
    ]), True),
])
PAGE_SCHEMA = StructType([
    StructField("page_no", LongType(), True),
    StructField("data", ArrayType(TWEET), True),
    StructField("includes", StructType([StructField("users", ArrayType(USER), True)]), True),
])

# State rows
ID_LOG_SCHEMA = StructType([
    StructField("author_id", LongType(), True),
    StructField("id", LongType(), True),
    StructField("date_time", TimestampNTZType(), True),
])
PROCESSED_LOG_SCHEMA = StructType([
    StructField("author_id", LongType(), True),
    StructField("file_modified_date", TimestampNTZType(), True),
    StructField("date_time", TimestampNTZType(), True),
])
