"""Sharding: the law, the mixture, slots, and the order against plain sorting."""

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest

from postlytics.llm import sharding
from llm_fixtures import SF01, make_docs  # noqa: F401


def plain(rows, shards, seed=42, bucket_rows=sharding.BUCKET_ROWS):
    """(doc_id, text, source) rows in their order by ranks sorted in memory: their (shard, slot)."""
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    name = lambda s: "n" if s is None else "=" + s
    n, texts = len(rows), defaultdict(list)
    for _, t, s in rows:
        texts[t or ""].append(name(s))
    buckets, sources = max(1, n // bucket_rows), defaultdict(list)
    for i, t, s in rows:
        h2, group = md5(f"{seed}:{'' if i is None else i}:{t or ''}"), texts[t or ""]
        whole = 2 <= len(group) <= n // shards
        u = md5(f"{seed}:{t or ''}") if whole else h2
        sources[min(group) if whole else name(s)].append(
            (int(u[:12], 16) % buckets, u, len(group) if whole else 1, h2, i is not None, i or 0, zlib.crc32((t or "").encode())))
    order = []
    for s, rs in sources.items():
        first = {}
        for k, x in enumerate(sorted(rs)):
            twice = 2 * first.setdefault(x[:2], k) + x[2]
            order.append((twice * buckets // (2 * len(rs)), twice / (2 * len(rs)), s, x[1], x[3:6], x[6]))
    order.sort()
    return sorted([(x[4][2] if x[4][1] else None, x[5], p * shards // n, p - -(-(p * shards // n) * n // shards))
                   for p, x in enumerate(order)], key=repr)


ROWS = [(1, "a", None, "s"), (2, None, None, None), (3, "", None, "t"), (4, "é", None, "s"), (4, "é", None, "s"), (None, "x", None, "s"),
        *[(10 + i, f"text {i}", None, "s" if i % 3 else "t") for i in range(50)], *[(100 + i, "hot text", None, "s") for i in range(40)]]


@pytest.mark.parametrize("shards, bucket_rows", [(1, 1 << 16), (2, 5), (7, 3), (40, 1 << 16), (300, 20)])
def test_order_slots_and_odd_rows(make_docs, shards, bucket_rows):
    got = sharding.assign(make_docs(ROWS, extra=True, partitions=3), shards, bucket_rows=bucket_rows).collect()
    want = plain([(i, t, s) for i, t, _, s in ROWS], shards, bucket_rows=bucket_rows)
    assert sorted([(r.doc_id, r.text_crc32, r.shard, r.slot) for r in got], key=repr) == want
    assert all(r.law == "rows" and r.grown_shard is None for r in got)
    assert sorted(r.size for r in got) == sorted(len((t or "").encode()) + 16 for _, t, _, _ in ROWS)


def test_whole_table_matches_the_mixture(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    got = sharding.assign(docs).join(docs.select("doc_id", "source"), "doc_id").collect()
    sizes = Counter(r.shard for r in got)
    assert set(sizes) == set(range(40)) and max(sizes.values()) - min(sizes.values()) <= 1
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    total, each = Counter(r.source for r in got), Counter((r.shard, r.source) for r in got)
    assert all(abs(each[k, s] - n / 40) <= 4 for s, n in total.items() for k in range(40))
    assert sum(abs(each[k, s] - n / 40) <= 2 for s, n in total.items() for k in range(40)) >= 0.97 * 40 * len(total)
    texts = defaultdict(list)
    for r in got:
        texts[r.text_crc32, r.size].append(r.shard)
    split = [set(s) for s in texts.values() if 2 <= len(s) <= len(got) // 40 and len(set(s)) > 1]
    assert len([s for s in texts.values() if len(s) > 1]) > 50 and len(split) <= 10 and all(len(s) == 2 for s in split)


def test_a_group_larger_than_a_shard_is_spread(make_docs):
    """A text that a third of all rows hold, in one source and with one doc_id: no shard gets more than its share."""
    rows = [(i, f"text {i}", None, "s") for i in range(200)] + [(7, "hot", None, "s")] * 100
    got = sharding.assign(make_docs(rows, partitions=4), 10, bucket_rows=16).collect()
    hot = Counter(r.shard for r in got if r.doc_id == 7 and r.size == 19)
    assert set(hot) == set(range(10)) and max(hot.values()) <= 20
    assert set(Counter(r.shard for r in got).values()) == {30}


def test_partitions_do_not_matter_and_seeds_do(make_docs):
    a, b, c = (sorted(((r.doc_id, r.text_crc32, r.shard, r.slot) for r in df.collect()), key=repr) for df in (
        sharding.assign(make_docs(ROWS, partitions=1), 5), sharding.assign(make_docs(ROWS, partitions=6), 5),
        sharding.assign(make_docs(ROWS), 5, seed=1)))
    assert a == b and a != c


def test_empty_table(make_docs):
    assert sharding.assign(make_docs([])).count() == 0
