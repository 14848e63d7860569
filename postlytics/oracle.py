"""DuckDB SQL equal to the registered Spark queries (the correctness oracle).

Building blocks are CTEs; `sql(name)` returns the full text for one query.
DuckDB notes: regexes need the 'g' flag; `//` on integers truncates toward zero
like Spark's long division; `epoch_us(ts) // 1000` (not `epoch_ms`, which rounds).
"""

from __future__ import annotations

from postlytics import config as C

LEXICON_VALUES = ", ".join(f"('{k}', {v:.1f})" for k, v in C.FIXTURE_LEXICON.items())
DAYS = ", ".join(str(d) for d in C.REPORT_DAYS)
PUNCT_SQL = C.PUNCTUATION_PATTERN.replace("'", "''")

POSTS = """
posts AS (
  SELECT
    e.user_id AS author_id,
    'user_' || e.user_id AS username,
    e.user_id * 37 + 100 AS author_followers,
    e.user_id * 11 + 5 AS author_tweets,
    'about user ' || e.user_id AS author_description,
    CASE WHEN e.user_id % 4 = 0 THEN NULL ELSE 'city_' || (e.user_id % 10) END AS author_location,
    e.event_id AS tweet_id,
    'RT @user_' || e.user_id || ': ' || d.text || ' http://t.co/' || e.event_id
      || ' #' || d.lang || '_' || e.event_type || ' #' || d.lang || 'x'
      || CASE WHEN e.event_id % 4 = 0 THEN ' $P' || ((e.event_id // 4) % 5 + 1) ELSE '' END AS text,
    CAST(epoch_us(e.ts) // 1000 AS VARCHAR) AS created_at,
    CAST(floor(e.value) AS INTEGER) AS retweets,
    CAST(e.event_id % 7 AS INTEGER) AS replies,
    CAST(json_extract_string(e.props, '$.k') AS INTEGER) AS likes,
    CAST(e.event_id % 3 AS INTEGER) AS quote_count,
    e.event_id // 10 AS conversation_id,
    CASE WHEN e.event_type = 'view' THEN e.event_id || '_1,' || e.event_id || '_2' END AS media_keys,
    CASE WHEN e.event_id % 3 = 0 AND e.event_id > 0 THEN 'replied_to' END AS ref_type,
    CASE WHEN e.event_id % 3 = 0 AND e.event_id > 0 THEN CAST(e.event_id - 1 AS VARCHAR) END AS ref_id,
    e.ts AS _ts
  FROM events e
  JOIN documents d ON d.doc_id = e.event_id % (SELECT count(*) FROM documents)
)"""


def clean_expr(col: str) -> str:
    links = f"regexp_replace({col}, 'http\\S+', '', 'g')"
    rt = f"regexp_replace({links}, 'RT\\s@[A-Za-z]+[A-Za-z0-9_-]+', '', 'g')"
    users = f"regexp_replace({rt}, '@[A-Za-z]+[A-Za-z0-9_-]+', '', 'g')"
    punct = f"regexp_replace({users}, '{PUNCT_SQL}', ' ', 'g')"
    return f"regexp_replace({punct}, '#[A-Za-z]+[A-Za-z0-9_-]+', '', 'g')"


CLEANED = f"""
cleaned AS (
  SELECT *, {clean_expr('text')} AS cleaned_tweet_text FROM posts
)"""

LEXICON = f"""
lex(token, weight) AS (VALUES {LEXICON_VALUES}),
toks AS (
  SELECT tweet_id,
         unnest(string_split(lower(regexp_replace(cleaned_tweet_text, '[^A-Za-z]+', ' ', 'g')), ' ')) AS token
  FROM cleaned
),
lex_sums AS (
  SELECT tweet_id, sum(weight) AS s, sum(abs(weight)) AS h FROM toks JOIN lex USING (token) GROUP BY tweet_id
),
scored AS (
  SELECT c.*,
         CASE WHEN coalesce(s, 0) > 0 THEN 'Positive' WHEN coalesce(s, 0) < 0 THEN 'Negative'
              ELSE 'Neutral' END AS sentiment_label,
         round((1 + abs(coalesce(s, 0))) / (1 + coalesce(h, 0)), 6) AS sentiment_score
  FROM cleaned c LEFT JOIN lex_sums USING (tweet_id)
)"""

LOCAL = ("timezone('America/Los_Angeles', to_timestamp(TRY_CAST(created_at AS BIGINT) // 1000))")

# the dates alone, without cleaning and scoring
DATED = f"""
post_dates AS (SELECT tweet_id, {LOCAL} AS created_at_date FROM posts)"""

ENRICHED = f"""
dated AS (
  SELECT *, {LOCAL} AS created_at_date FROM scored
),
enriched AS (
  SELECT * EXCLUDE (created_at),
         CAST(year(created_at_date) AS INTEGER) AS year,
         CAST(month(created_at_date) AS INTEGER) AS month,
         CAST(day(created_at_date) AS INTEGER) AS dayofmonth
  FROM dated
)"""


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + body


BASE = (POSTS, CLEANED, LEXICON, ENRICHED)
POLARITY = ("round(avg(CASE WHEN sentiment_label = 'Positive' THEN sentiment_score "
            "WHEN sentiment_label = 'Negative' THEN -sentiment_score "
            "WHEN sentiment_label = 'Neutral' THEN 0.0 END), 9) AS avg_polarity")

QUERIES: dict[str, str] = {}


def register(name: str, text: str) -> None:
    QUERIES[name] = text


register("agg_daily_sentiment", with_ctes(*BASE, body=f"""
SELECT dayofmonth, count(*) AS total_count, round(avg(sentiment_score), 9) AS avg_sentiment,
       {POLARITY}
FROM enriched WHERE dayofmonth IN ({DAYS})
GROUP BY dayofmonth ORDER BY dayofmonth"""))

UTC_DAY = "CAST(to_timestamp(TRY_CAST(created_at AS BIGINT) // 1000) AT TIME ZONE 'UTC' AS DATE)"

STATE = f"""
days AS (SELECT *, {UTC_DAY} AS _day FROM posts),
insert_log AS (
  SELECT author_id, max(tweet_id) AS id, CAST(_day AS TIMESTAMP) + INTERVAL 1 DAY AS date_time
  FROM days WHERE _day < DATE '2024-01-15' GROUP BY author_id, _day
),
processed_log AS (
  SELECT DISTINCT author_id,
         CAST(_day AS TIMESTAMP) + INTERVAL 1 DAY + INTERVAL 5 MINUTE AS file_modified_date,
         CAST(_day AS TIMESTAMP) + INTERVAL 1 DAY + INTERVAL 10 MINUTE AS date_time
  FROM days WHERE _day < DATE '2024-01-15'
),
authors AS (SELECT DISTINCT author_id FROM posts),
raw_latest AS (SELECT author_id, arg_max(id, date_time) AS last_id FROM insert_log GROUP BY author_id),
raw_state AS (
  SELECT a.author_id, coalesce(r.last_id, 0) AS last_id FROM authors a LEFT JOIN raw_latest r USING (author_id)
)"""

NB = """
ldocs AS (
  SELECT d.doc_id, d.text,
         CASE WHEN l.toxic = 1 THEN 'Negative' WHEN l.quality = 1 THEN 'Positive' ELSE 'Neutral' END AS label
  FROM documents d JOIN labels l USING (doc_id)
),
dtoks AS (
  SELECT label, unnest(string_split(lower(regexp_replace(text, '[^A-Za-z]+', ' ', 'g')), ' ')) AS token
  FROM ldocs
),
counts AS (
  SELECT token,
         sum(CASE WHEN label = 'Negative' THEN 1 ELSE 0 END) AS n_negative,
         sum(CASE WHEN label = 'Neutral' THEN 1 ELSE 0 END) AS n_neutral,
         sum(CASE WHEN label = 'Positive' THEN 1 ELSE 0 END) AS n_positive
  FROM dtoks WHERE token <> '' GROUP BY token
),
tot AS (SELECT count(*) AS vocab, sum(n_negative) AS t_neg, sum(n_neutral) AS t_neu,
               sum(n_positive) AS t_pos FROM counts),
w AS (
  SELECT token,
         ln((n_negative + 1) / ((SELECT t_neg FROM tot) + (SELECT vocab FROM tot))) AS w_negative,
         ln((n_neutral + 1) / ((SELECT t_neu FROM tot) + (SELECT vocab FROM tot))) AS w_neutral,
         ln((n_positive + 1) / ((SELECT t_pos FROM tot) + (SELECT vocab FROM tot))) AS w_positive
  FROM counts
),
pri AS (
  SELECT ln(sum(CASE WHEN label = 'Negative' THEN 1 ELSE 0 END) / count(*)) AS p_negative,
         ln(sum(CASE WHEN label = 'Neutral' THEN 1 ELSE 0 END) / count(*)) AS p_neutral,
         ln(sum(CASE WHEN label = 'Positive' THEN 1 ELSE 0 END) / count(*)) AS p_positive
  FROM ldocs
),
ptoks AS (
  SELECT tweet_id,
         unnest(string_split(lower(regexp_replace(cleaned_tweet_text, '[^A-Za-z]+', ' ', 'g')), ' ')) AS token
  FROM cleaned
),
psums AS (
  SELECT tweet_id, sum(w_negative) AS s_neg, sum(w_neutral) AS s_neu, sum(w_positive) AS s_pos
  FROM ptoks JOIN w USING (token) GROUP BY tweet_id
),
logits AS (
  SELECT c.tweet_id, (SELECT p_negative FROM pri) + coalesce(s_neg, 0) AS a,
         (SELECT p_neutral FROM pri) + coalesce(s_neu, 0) AS b,
         (SELECT p_positive FROM pri) + coalesce(s_pos, 0) AS c
  FROM cleaned c LEFT JOIN psums USING (tweet_id)
),
nb AS (
  SELECT tweet_id,
         CASE WHEN a = m THEN 'Negative' WHEN b = m THEN 'Neutral' ELSE 'Positive' END AS sentiment_label,
         round(1 / (exp(a - m) + exp(b - m) + exp(c - m)), 6) AS sentiment_score
  FROM (SELECT *, greatest(a, b, c) AS m FROM logits)
)"""

DAILY = "count(*) AS total_count, round(avg(sentiment_score), 9) AS avg_sentiment, " + POLARITY

register("prj_clean_text", with_ctes(POSTS, CLEANED, body="SELECT tweet_id, cleaned_tweet_text FROM cleaned"))
register("prj_date_parts", with_ctes(POSTS, DATED, body="""
SELECT tweet_id, created_at_date, CAST(year(created_at_date) AS INTEGER) AS year,
       CAST(month(created_at_date) AS INTEGER) AS month, CAST(day(created_at_date) AS INTEGER) AS dayofmonth
FROM post_dates"""))
register("sentiment_lexicon", with_ctes(POSTS, CLEANED, LEXICON, body="""
SELECT tweet_id, sentiment_label, sentiment_score FROM scored"""))
register("sentiment_model", QUERIES["sentiment_lexicon"])
register("sentiment_fit_nb", with_ctes(POSTS, CLEANED, NB, body="""
SELECT tweet_id, sentiment_label, sentiment_score FROM nb"""))
register("flt_day_in", with_ctes(POSTS, DATED, body=f"""
SELECT tweet_id, CAST(day(created_at_date) AS INTEGER) AS dayofmonth FROM post_dates
WHERE day(created_at_date) IN ({DAYS})"""))
register("agg_daily_rounded", with_ctes(*BASE, body=f"""
SELECT dayofmonth, round(CAST(count(*) AS DOUBLE), 2) AS total_count,
       round(avg(sentiment_score), 2) AS avg_sentiment
FROM enriched WHERE dayofmonth IN ({DAYS}) GROUP BY dayofmonth"""))
register("agg_calendar_sentiment", with_ctes(*BASE, body=f"""
SELECT year, month, dayofmonth, {DAILY} FROM enriched GROUP BY year, month, dayofmonth"""))
register("sort_day", with_ctes(*BASE, body=f"""
SELECT dayofmonth, {DAILY} FROM enriched GROUP BY dayofmonth ORDER BY dayofmonth"""))
register("agg_calendar_spine", with_ctes(*BASE, body="""
, daily AS (SELECT CAST(created_at_date AS DATE) AS day, count(*) AS total_count,
                   round(avg(sentiment_score), 9) AS avg_sentiment FROM enriched GROUP BY 1),
spine AS (SELECT CAST(unnest(generate_series(m - INTERVAL 34 DAY, m, INTERVAL 1 DAY)) AS DATE) AS day
          FROM (SELECT CAST(max(CAST(created_at_date AS DATE)) AS TIMESTAMP) AS m FROM enriched))
SELECT s.day, coalesce(d.total_count, 0) AS total_count, d.avg_sentiment
FROM spine s LEFT JOIN daily d USING (day)"""))
register("top_latest_posts", with_ctes(*BASE, body=f"""
SELECT tweet_id, {', '.join(C.REPORT_COLUMNS)} FROM enriched
ORDER BY created_at_date DESC, tweet_id DESC LIMIT {C.LATEST_POSTS_LIMIT}"""))
register("prj_row_number", with_ctes(*BASE, body=f"""
SELECT *, CAST(row_number() OVER (ORDER BY created_at_date DESC, tweet_id DESC) AS INTEGER) AS row_no FROM (
SELECT tweet_id, {', '.join(C.REPORT_COLUMNS)} FROM enriched
ORDER BY created_at_date DESC, tweet_id DESC LIMIT {C.LATEST_POSTS_LIMIT})"""))
register("prj_series", with_ctes(*BASE, body=f"""
, daily AS (SELECT dayofmonth, count(*) AS total_count, avg(sentiment_score) AS avg_sentiment
            FROM enriched WHERE dayofmonth IN ({DAYS}) GROUP BY dayofmonth)
SELECT list(dayofmonth ORDER BY dayofmonth) AS labels,
       list(round(avg_sentiment, 2) ORDER BY dayofmonth) AS averages,
       list(CAST(total_count AS DOUBLE) ORDER BY dayofmonth) AS counts
FROM daily"""))
register("agg_hashtag_counts", with_ctes(POSTS, body="""
SELECT hashtag, count(*) AS n FROM (
  SELECT unnest(regexp_extract_all(text, '#[A-Za-z]+[A-Za-z0-9_-]+')) AS hashtag FROM posts)
GROUP BY hashtag"""))
register("agg_mention_counts", with_ctes(POSTS, body="""
SELECT mention, count(*) AS n FROM (
  SELECT unnest(regexp_extract_all(text, '@[A-Za-z]+[A-Za-z0-9_-]+')) AS mention FROM posts)
GROUP BY mention"""))
_nl = "regexp_replace(text, 'http\\S+', '', 'g')"
_nrt = f"regexp_replace({_nl}, 'RT\\s@[A-Za-z]+[A-Za-z0-9_-]+', '', 'g')"
_nu = f"regexp_replace({_nrt}, '@[A-Za-z]+[A-Za-z0-9_-]+', '', 'g')"
_np = f"regexp_replace({_nu}, '{PUNCT_SQL}', ' ', 'g')"
register("agg_clean_audit", with_ctes(POSTS, body=f"""
SELECT author_id, count(*) AS posts, CAST(sum(links) AS BIGINT) AS links,
       CAST(sum(handles) AS BIGINT) AS handles, CAST(sum(hashtags) AS BIGINT) AS hashtags,
       CAST(sum(chars_lost) AS BIGINT) AS chars_lost
FROM (
  SELECT author_id,
         len(regexp_extract_all(text, 'http\\S+')) AS links,
         len(regexp_extract_all({_nl}, 'RT\\s@[A-Za-z]+[A-Za-z0-9_-]+'))
           + len(regexp_extract_all({_nrt}, '@[A-Za-z]+[A-Za-z0-9_-]+')) AS handles,
         len(regexp_extract_all({_np}, '#[A-Za-z]+[A-Za-z0-9_-]+')) AS hashtags,
         length(text) - length(regexp_replace({_np}, '#[A-Za-z]+[A-Za-z0-9_-]+', '', 'g')) AS chars_lost
  FROM posts)
GROUP BY author_id"""))
register("agg_row_counts", with_ctes(POSTS, body="""
SELECT count(*) AS n_rows,
       CAST(sum(CASE WHEN TRY_CAST(created_at AS BIGINT) IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_bad_created_at
FROM posts"""))
register("flt_hashtag", with_ctes(POSTS, body="""
SELECT tweet_id, author_id FROM posts
WHERE list_contains(regexp_extract_all(text, '#[A-Za-z]+[A-Za-z0-9_-]+'), '#en_click')"""))
register("flt_since_id", with_ctes(POSTS, body="""
SELECT tweet_id, author_id FROM posts WHERE tweet_id > (SELECT max(tweet_id) // 2 FROM posts)"""))
register("flt_time_range", with_ctes(POSTS, body="""
, bounds AS (SELECT CAST(CAST(max(_ts) AS DATE) AS TIMESTAMP) AS today FROM posts)
SELECT tweet_id, author_id FROM posts, bounds
WHERE to_timestamp(TRY_CAST(created_at AS BIGINT) // 1000) AT TIME ZONE 'UTC' >= today - INTERVAL 10 DAY
  AND to_timestamp(TRY_CAST(created_at AS BIGINT) // 1000) AT TIME ZONE 'UTC' < today + INTERVAL 12 HOUR
"""))
register("flt_author", with_ctes(POSTS, body="SELECT tweet_id, author_id, username FROM posts WHERE author_id = 7"))
register("agg_max_id", with_ctes(POSTS, body="SELECT author_id, max(tweet_id) AS max_id FROM posts GROUP BY author_id"))

# state
register("agg_latest_state", with_ctes(POSTS, STATE, body="""
SELECT author_id, max(date_time) AS date_time, arg_max(id, date_time) AS id FROM insert_log GROUP BY author_id"""))
register("state_raw", with_ctes(POSTS, STATE, body="SELECT author_id, last_id FROM raw_state"))
register("state_pull", with_ctes(POSTS, STATE, body="""
SELECT a.author_id, coalesce(p.last_id, 1) AS last_id FROM authors a
LEFT JOIN (SELECT author_id, max(tweet_id) AS last_id FROM days WHERE _day < DATE '2024-01-15'
           GROUP BY author_id) p USING (author_id)"""))
register("state_processed", with_ctes(POSTS, STATE, body="""
SELECT a.author_id, coalesce(p.f, TIMESTAMP '1970-01-01 00:00:00') AS file_modified_date FROM authors a
LEFT JOIN (SELECT author_id, arg_max(file_modified_date, date_time) AS f FROM processed_log
           GROUP BY author_id) p USING (author_id)"""))
register("top_latest_state", with_ctes(POSTS, STATE, body="""
SELECT author_id, id, date_time FROM insert_log ORDER BY date_time DESC, author_id DESC, id DESC LIMIT 1"""))
register("flt_id_watermark", with_ctes(POSTS, STATE, body="""
SELECT p.tweet_id, p.author_id FROM posts p LEFT JOIN raw_state s USING (author_id)
WHERE p.tweet_id > coalesce(s.last_id, 0)"""))
register("join_state_lookup", with_ctes(POSTS, STATE, body="""
SELECT p.tweet_id, p.author_id, coalesce(s.last_id, 0) AS last_id FROM posts p LEFT JOIN raw_state s USING (author_id)"""))
register("join_dedupe_anti", with_ctes(POSTS, STATE, body="""
SELECT d.tweet_id FROM days d
ANTI JOIN (SELECT tweet_id FROM days WHERE _day < DATE '2024-01-15') l ON l.tweet_id = d.tweet_id
WHERE d._day >= DATE '2024-01-10'"""))
register("set_dedupe_posts", with_ctes(POSTS, STATE, body="""
, both_batches AS (
  SELECT tweet_id, likes, 1 AS load_ts FROM days WHERE _day < DATE '2024-01-15'
  UNION ALL
  SELECT tweet_id, likes + 1000 AS likes, 2 AS load_ts FROM days WHERE _day >= DATE '2024-01-10')
SELECT tweet_id, arg_max(likes, load_ts) AS likes, max(load_ts) AS load_ts FROM both_batches GROUP BY tweet_id
"""))

# ------------------------------------------------------------------ pages
FLAT_COLS = ("p.author_id, p.username, p.author_followers + i.last_page AS author_followers, "
             "p.author_tweets + i.last_page AS author_tweets, p.author_description, p.author_location, "
             "p.tweet_id, p.text, p.created_at, p.retweets, p.replies, p.likes, p.quote_count, "
             "p.conversation_id, p.media_keys, p.ref_type, p.ref_id")
PAGES = """
pg AS (SELECT *, tweet_id // 100 AS page_no FROM posts),
inc AS (
  SELECT author_id, max(page_no) AS last_page FROM pg
  WHERE NOT (author_id % 50 = 7) AND NOT (author_id % 50 = 3 AND page_no % 2 = 0)
  GROUP BY author_id
)"""
SEARCH_PAGES = """
pg AS (SELECT *, tweet_id // 100 AS page_no FROM posts
       WHERE list_contains(regexp_extract_all(text, '#[A-Za-z]+[A-Za-z0-9_-]+'), '#en_click')),
inc AS (SELECT author_id, max(page_no) AS last_page FROM pg GROUP BY author_id)"""
register("src_flatten_timeline", with_ctes(POSTS, PAGES, body=f"""
SELECT {FLAT_COLS} FROM pg p JOIN inc i USING (author_id)"""))
register("src_flatten_search", with_ctes(POSTS, SEARCH_PAGES, body=f"""
SELECT {FLAT_COLS} FROM pg p JOIN inc i USING (author_id)"""))
register("src_pages_window", with_ctes(POSTS, body="""
, w AS (SELECT max(tweet_id) // 2 AS since, max(CAST(created_at AS BIGINT)) - 864000000 AS a,
               max(CAST(created_at AS BIGINT)) - 86400000 AS z FROM posts),
pg AS (SELECT *, tweet_id // 100 AS page_no, CAST(created_at AS BIGINT) AS ms FROM posts),
used AS (SELECT page_no FROM pg GROUP BY page_no
         HAVING max(tweet_id) > (SELECT since FROM w) AND max(ms) >= (SELECT a FROM w) AND min(ms) < (SELECT z FROM w)),
inc AS (SELECT author_id, max(page_no) AS last_page FROM pg JOIN used USING (page_no)
        WHERE NOT (author_id % 50 = 7) AND NOT (author_id % 50 = 3 AND page_no % 2 = 0) GROUP BY author_id)
SELECT p.tweet_id, p.author_id, p.username, p.author_followers + i.last_page AS author_followers, p.created_at
FROM pg p JOIN used USING (page_no) JOIN inc i USING (author_id), w
WHERE p.tweet_id > since AND p.ms >= a AND p.ms < z"""))
register("prj_post_fields", with_ctes(POSTS, body="""
SELECT tweet_id, author_id, created_at, retweets, replies, likes, quote_count, conversation_id, media_keys
FROM posts"""))
register("join_post_author", with_ctes(POSTS, PAGES, body="""
SELECT p.tweet_id, p.author_id, p.username, p.author_followers + i.last_page AS author_followers,
       p.author_tweets + i.last_page AS author_tweets, p.author_location
FROM pg p JOIN inc i USING (author_id)"""))
register("join_post_author_orphans", with_ctes(POSTS, PAGES, body="""
SELECT tweet_id, author_id FROM pg WHERE author_id NOT IN (SELECT author_id FROM inc)"""))

# ------------------------------------------------------------------ landed files
LANDED = """
landed AS (
  SELECT *, 1 AS batch FROM days WHERE _day < DATE '2024-01-15'
  UNION ALL
  SELECT *, 2 AS batch FROM days WHERE _day >= DATE '2024-01-10'
)"""
F_BASE = (POSTS, STATE, LANDED)
register("src_json_incremental", with_ctes(*F_BASE, body="SELECT tweet_id, author_id, batch FROM landed WHERE batch = 2"))
register("src_json_past_mark", QUERIES["src_json_incremental"])
register("set_union_versions", with_ctes(*F_BASE, body="""
SELECT tweet_id, author_id, CASE WHEN batch = 1 THEN quote_count END AS quote_count, batch,
       CASE WHEN batch = 2 THEN '{"edits":{"n":' || replies || '}' || coalesce(',"impressions":' || likes * 10, '') || '}'
            ELSE '{}' END AS other_fields
FROM landed"""))
register("flt_file_newer", QUERIES["src_json_incremental"])
register("src_json_direct", with_ctes(*F_BASE, body="""
SELECT tweet_id, author_id, username, CAST(likes AS BIGINT) AS likes, created_at
FROM landed WHERE batch = 1"""))
register("src_json_latest", with_ctes(*F_BASE, body="""
SELECT l.tweet_id, l.author_id, l.batch FROM landed l
JOIN (SELECT author_id, max(batch) AS b FROM landed GROUP BY author_id) m
  ON l.author_id = m.author_id AND l.batch = m.b"""))
register("set_union_files", with_ctes(*F_BASE, body="SELECT tweet_id, batch FROM landed"))
register("flt_file_prefix", with_ctes(*F_BASE, body="SELECT tweet_id, author_id, batch FROM landed WHERE author_id = 1"))
register("flt_file_nonempty", with_ctes(*F_BASE, body="SELECT batch, count(*) AS n FROM landed GROUP BY batch"))
register("prj_file_keys", with_ctes(*F_BASE, body="SELECT DISTINCT batch, author_id FROM landed"))
register("agg_max_file_time", with_ctes(*F_BASE, body="""
SELECT author_id, max(batch) AS newest_batch FROM landed GROUP BY author_id"""))
register("top_latest_file", with_ctes(*F_BASE, body="SELECT max(batch) AS batch FROM landed"))

# ------------------------------------------------------------------ sinks
register("snk_json_local", with_ctes(POSTS, body="SELECT tweet_id, author_id, likes, created_at FROM posts"))
register("snk_json_batch", with_ctes(POSTS, STATE, body="""
SELECT p.tweet_id, p.author_id FROM posts p
LEFT JOIN (SELECT author_id, max(tweet_id) AS m FROM days WHERE _day < DATE '2024-01-15' GROUP BY author_id) s
  USING (author_id)
WHERE p.tweet_id > coalesce(s.m, 1)"""))
register("snk_raw_append", with_ctes(*F_BASE, body="SELECT DISTINCT tweet_id, author_id, likes FROM landed"))
register("snk_enriched_append", with_ctes(*BASE, body="""
SELECT tweet_id, year, month, dayofmonth, sentiment_label, sentiment_score FROM enriched"""))
register("snk_state_latest", with_ctes(POSTS, body="SELECT author_id, max(tweet_id) AS last_id FROM posts GROUP BY author_id"))
LOG20 = """
log20 AS (
  SELECT author_id, max(tweet_id) AS id, CAST(_day AS TIMESTAMP) + INTERVAL 1 DAY AS date_time
  FROM days WHERE _day < DATE '2024-01-20' GROUP BY author_id, _day
),
plog20 AS (
  SELECT DISTINCT author_id,
         CAST(_day AS TIMESTAMP) + INTERVAL 1 DAY + INTERVAL 5 MINUTE AS file_modified_date,
         CAST(_day AS TIMESTAMP) + INTERVAL 1 DAY + INTERVAL 10 MINUTE AS date_time
  FROM days WHERE _day < DATE '2024-01-20'
)"""
register("snk_state_log_raw", with_ctes(POSTS, STATE, LOG20, body="""
SELECT author_id, max(date_time) AS date_time, arg_max(id, date_time) AS id FROM log20 GROUP BY author_id"""))
register("snk_state_log_processed", with_ctes(POSTS, STATE, LOG20, body="""
SELECT author_id, max(date_time) AS date_time, arg_max(file_modified_date, date_time) AS file_modified_date
FROM plog20 GROUP BY author_id"""))

# ------------------------------------------------------------------ streaming
register("str_ingest", with_ctes(*F_BASE, body="SELECT DISTINCT tweet_id, author_id FROM landed"))
register("str_daily_sentiment", with_ctes(*BASE, body="""
SELECT CAST(created_at_date AS DATE) AS day, count(*) AS total_count,
       round(avg(sentiment_score), 9) AS avg_sentiment
FROM enriched GROUP BY 1"""))

register("str_daily_bounded", with_ctes(*BASE, body="""
, a0 AS (
  SELECT tweet_id, created_at_date AS ts, CAST(created_at_date AS DATE) AS day, sentiment_score,
         least((extract(day FROM _ts)::INTEGER - 1) // 5, 5) AS pull FROM enriched),
arrivals AS (
  SELECT tweet_id, ts, day, sentiment_score,
         unnest(CASE WHEN tweet_id % 50 = 7 THEN [pull + 2] WHEN tweet_id % 20 = 3 THEN [pull, pull + 1] ELSE [pull] END) AS pull
  FROM a0),
per_pull AS (SELECT pull, max(ts) AS m FROM arrivals GROUP BY pull),
marks AS (
  SELECT pull, CAST(max(m) OVER (ORDER BY pull ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS DATE) - 2 AS closed
  FROM per_pull),
judged AS (SELECT a.*, closed IS NULL OR day >= closed AS on_time FROM arrivals a JOIN marks USING (pull)),
counted AS (SELECT DISTINCT tweet_id, day, sentiment_score FROM judged WHERE on_time),
late AS (SELECT day, count(*) AS late_posts FROM judged WHERE NOT on_time GROUP BY day)
SELECT day, count(*) AS total_count, round(avg(sentiment_score), 9) AS avg_sentiment,
       coalesce(any_value(late_posts), 0) AS late_posts
FROM counted LEFT JOIN late USING (day)
WHERE day < (SELECT CAST(max(ts) AS DATE) - 2 FROM arrivals) GROUP BY day"""))

# ------------------------------------------------------------------ extensions
EXT = """
assets AS (
  SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS asset_id,
         'P' || substr(o_orderpriority, 1, 1) AS symbol
  FROM orders
),
prices AS (
  SELECT 'P' || substr(o_orderpriority, 1, 1) AS symbol,
         CAST(CAST(o_orderdate AS DATE) + INTERVAL 348 MONTH AS DATE) AS price_date,
         avg(o_totalprice) AS price
  FROM orders GROUP BY 1, 2
),
mentions AS (
  SELECT tweet_id, symbol, asset_id FROM (
    SELECT tweet_id,
           unnest(list_distinct(regexp_extract_all(text, '\\$([A-Z][A-Z0-9]{0,5})\\b', 1))) AS symbol
    FROM posts)
  JOIN assets USING (symbol)
)"""
register("ext_ticker_mentions", with_ctes(POSTS, EXT, body="SELECT tweet_id, symbol, asset_id FROM mentions"))
register("ext_price_asof", with_ctes(POSTS, EXT, body="""
, m AS (SELECT mn.tweet_id, mn.symbol,
               to_timestamp(TRY_CAST(p.created_at AS BIGINT) // 1000) AT TIME ZONE 'UTC' AS ts
        FROM mentions mn JOIN posts p USING (tweet_id)),
px AS (SELECT symbol, CAST(price_date AS TIMESTAMP) AS price_time, price FROM prices)
SELECT m.tweet_id, m.symbol, px.price_time, round(px.price, 9) AS price
FROM m ASOF LEFT JOIN px ON m.symbol = px.symbol AND m.ts >= px.price_time"""))
register("ext_price_asof_ticks", with_ctes(POSTS, EXT, body="""
, m AS (SELECT mn.tweet_id, mn.symbol,
               to_timestamp(TRY_CAST(p.created_at AS BIGINT) // 1000) AT TIME ZONE 'UTC' AS ts
        FROM mentions mn JOIN posts p USING (tweet_id)),
ticks AS (
  SELECT 'P' || (event_id % 5 + 1) AS symbol,
         strptime(strftime(ts, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS price_time, max(value) AS price
  FROM events WHERE event_type = 'purchase' GROUP BY 1, 2)
SELECT m.tweet_id, m.symbol, m.ts, t.price_time, t.price
FROM m ASOF LEFT JOIN ticks t ON m.symbol = t.symbol AND m.ts >= t.price_time"""))
register("ext_sentiment_price_corr", with_ctes(*BASE, EXT, body="""
, em AS (
  SELECT mn.symbol, CAST(e.created_at_date AS DATE) AS day,
         CASE WHEN e.sentiment_label = 'Positive' THEN e.sentiment_score
              WHEN e.sentiment_label = 'Negative' THEN -e.sentiment_score ELSE 0.0 END AS polarity
  FROM mentions mn JOIN enriched e USING (tweet_id)),
daily AS (SELECT symbol, day, avg(polarity) AS polarity FROM em GROUP BY 1, 2)
SELECT d.symbol, round(corr(d.polarity, p.price), 9) AS corr, count(*) AS days
FROM daily d JOIN prices p ON d.symbol = p.symbol AND d.day = p.price_date
GROUP BY d.symbol"""))
register("ext_multi_author", with_ctes(POSTS, body="""
SELECT author_id, count(*) AS n_posts, max(tweet_id) AS max_id FROM posts
WHERE author_id IN (SELECT DISTINCT user_id FROM events WHERE event_type = 'signup')
GROUP BY author_id"""))

register("src_report_table", QUERIES["agg_daily_rounded"])
register("prj_sentiment", QUERIES["sentiment_lexicon"])

register("state_pull_stream", QUERIES["state_pull"])
register("state_raw_stream", QUERIES["state_raw"])
register("state_processed_stream", QUERIES["state_processed"])
register("agg_daily_maintained", QUERIES["agg_calendar_sentiment"])
register("top_latest_stored", QUERIES["prj_row_number"])
register("sentiment_fit_nb_merged", QUERIES["sentiment_fit_nb"])
