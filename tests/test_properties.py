"""Property tests (hypothesis): state operators against plain-Python statements of the rules."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from postlytics.operators import state

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

rows = st.lists(st.tuples(st.integers(0, 6), st.integers(0, 50), st.integers(-5, 5)), max_size=40)


@SETTINGS
@given(rows)
def test_dedupe_keeps_the_newest_copy(spark, data):
    df = spark.createDataFrame(data, "tweet_id int, load_ts int, likes int")
    got = {r.tweet_id: (r.load_ts, r.likes) for r in state.dedupe_latest(df, "tweet_id", "load_ts").collect()}
    want = {}
    for k, ts, v in data:                       # newest load wins; ties: the larger value
        if k not in want or (ts, v) > want[k]:
            want[k] = (ts, v)
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 30)), max_size=30),
       st.dictionaries(st.integers(0, 4), st.integers(0, 30), max_size=5))
def test_watermark_keeps_exactly_the_rows_above(spark, posts, marks):
    p = spark.createDataFrame(posts, "author_id int, tweet_id int")
    s = spark.createDataFrame(list(marks.items()), "author_id int, last_id int")
    got = sorted((r.author_id, r.tweet_id) for r in state.above_watermark(p, s).collect())
    want = sorted((a, t) for a, t in posts if a not in marks or t > marks[a])
    assert got == want


@SETTINGS
@given(rows, rows)
def test_anti_join_then_union_is_idempotent(spark, first, second):
    a = spark.createDataFrame(first, "tweet_id int, load_ts int, likes int")
    b = spark.createDataFrame(second, "tweet_id int, load_ts int, likes int")
    new = state.not_loaded(b, a)
    got = {r.tweet_id for r in a.select("tweet_id").union(new.select("tweet_id")).collect()}
    assert got == {k for k, _, _ in first} | {k for k, _, _ in second}
    assert state.not_loaded(b, a.unionByName(b)).count() == 0
