"""Token counts against the library, and what the cache stores."""

import public_tokenizers
import sentencepiece

from postlytics.llm import token_cache
from llm_fixtures import SF001, make_docs  # noqa: F401

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ROWS = [(1, "Hello  world\n"), (2, None), (3, ""), (4, "Hello  world\n"), (4, "Hello  world\n"), (None, "<s> é 日本 😀 \x00"),
        (6, "long " * 20000), (7, " "), (8, "▁ a")]


def expected(rows):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    return sorted([(i, len((t or "").encode()), n := len(sp.encode(t or "")), n > 4096) for i, t in rows], key=repr)


def got(df):
    return sorted([(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in df.collect()], key=repr)


def test_counts_and_cache(spark, make_docs, workdir):
    cache = f"{workdir}/cache"
    assert got(token_cache.count_tokens(make_docs(ROWS, extra=True), MODEL, cache)) == expected(ROWS)
    store = f"{cache}/tokenizer={token_cache.tokenizer_version(MODEL)}"
    stored = spark.read.schema(token_cache.CACHE_SCHEMA).parquet(store)
    distinct = len({t or "" for _, t in ROWS})
    assert stored.count() == distinct == stored.select("digest").distinct().count()
    more = ROWS[:3] + [(20, "a new text"), (21, "a new text")]
    assert got(token_cache.count_tokens(make_docs(more), MODEL, cache)) == expected(more)
    assert spark.read.schema(token_cache.CACHE_SCHEMA).parquet(store).count() == distinct + 1


def test_stored_counts_are_used(spark, make_docs, workdir):
    cache = f"{workdir}/cache"
    token_cache.count_tokens(make_docs(["abc"]), MODEL, cache)
    store = f"{cache}/tokenizer={token_cache.tokenizer_version(MODEL)}"
    kept = spark.read.schema(token_cache.CACHE_SCHEMA).parquet(store).collect()
    spark.createDataFrame([(bytes(kept[0].digest), 77)], token_cache.CACHE_SCHEMA).write.mode("overwrite").parquet(store)
    assert [r.n_tokens for r in token_cache.count_tokens(make_docs(["abc"]), MODEL, cache).collect()] == [77]


def test_small_table_and_empty_table(spark, make_docs, workdir):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    want = expected([(r.doc_id, r.text) for r in docs.collect()])
    assert got(token_cache.count_tokens(docs, MODEL, f"{workdir}/a")) == want
    assert token_cache.count_tokens(make_docs([]), MODEL, f"{workdir}/b").count() == 0
