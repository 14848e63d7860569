"""Decontamination against a search for every window."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from postlytics.llm import decontaminate
from llm_fixtures import SF001, make_docs  # noqa: F401


def tokens(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, n=10):
    wins = [(i, [w[k:k + n] for k in range(max(1, len(w) - n + 1))]) for i, t in items if (w := tokens(t))]
    out = []
    for i, t in docs:
        w, hit, found = tokens(t), set(), set()
        for item, windows in wins:
            for x in windows:
                for k in range(len(w) - len(x) + 1):
                    if w[k:k + len(x)] == x:
                        hit.update(range(k, k + len(x)))
                        found.add("" if item is None else str(item))
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def digested(c):
    return sorted(map(tuple, c.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids"), F.sha2(F.array_join("item_ids", ","), 256), "contaminated").collect()), key=repr)


ITEMS = [(1, "The quick brown fox, jumps over the lazy dog and runs far away today"), (10, "Two WORDS"), (2, "two words"),
         (3, None), (4, "..."), (5, ""), (None, "nulls have words too"), (7, "the the the the the the the the the the the")]
DOCS = [(1, "x THE quick-brown fox jumps over the lazy dog and runs far y"), (2, None), (3, ""), (4, "two, words; two words"),
        (4, "two, words; two words"), (None, "so nulls have words too!"), (6, "the " * 40), (7, "clean text of 3 words é"),
        (8, "quick brown fox jumps over the lazy dog"), (9, "the quick brown fox jumps over the lazy dog and " * 300)]


@pytest.mark.parametrize("block", [1 << 20, 300])
def test_matches_brute_force(spark, make_docs, block):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string").withColumn("words", F.lit(1))
    got = decontaminate.contamination(make_docs(DOCS, extra=True, partitions=3), items, block_bytes=block)
    assert digested(got) == brute(DOCS, ITEMS)


def test_whole_small_table(spark):
    docs, items = (spark.read.parquet(f"{SF001}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert digested(decontaminate.contamination(docs, items)) == want


def test_drop_and_empty_tables(spark, make_docs):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    docs = make_docs(DOCS, extra=True)
    kept = decontaminate.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted([(r.doc_id, r.text) for r in kept.collect()], key=repr) == sorted(
        [d for d, b in zip(DOCS, (1, 0, 0, 1, 1, 1, 1, 0, 0, 1)) if not b], key=repr)
    assert decontaminate.contamination(make_docs([]), items).count() == 0
    none = decontaminate.contamination(docs, items.limit(0))
    assert none.where("contaminated or n_hit > 0").count() == 0 and none.count() == len(DOCS)


def test_blocks_run_one_after_another(spark, make_docs, monkeypatch):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    build, events = decontaminate.build_index, []
    kind = type(spark.sparkContext.broadcast(0))
    destroy = kind.destroy
    monkeypatch.setattr(decontaminate, "build_index", lambda *a: events.append("built") or build(*a))
    monkeypatch.setattr(kind, "destroy", lambda self, *a: events.append("freed") or destroy(self, *a))
    docs = make_docs(DOCS, extra=True, partitions=3)
    got = decontaminate.contamination(docs, items, block_bytes=200)
    # of each block the words are freed, the index built, used and freed before the next
    assert len(events) > 6 and events == ["freed", "built", "freed"] * (len(events) // 3)
    assert digested(got) == brute(DOCS, ITEMS)
    clean = decontaminate.drop_contaminated(docs, items, block_bytes=200)
    assert clean.columns == docs.columns
    assert sorted(clean.collect(), key=repr) == sorted(decontaminate.drop_contaminated(docs, items).collect(), key=repr)
