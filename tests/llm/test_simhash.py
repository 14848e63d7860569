"""SimHash near-duplicates against brute force over all pairs of fingerprints."""

import random
import re

import pytest
import xxhash

from postlytics.llm import simhash
from postlytics.llm.components import connected_components
from postlytics.llm.common import pick
from llm_fixtures import SF001, make_docs  # noqa: F401


def brute_fingerprint(text, n=4):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    grams = [" ".join(w[i:i + n]) for i in range(len(w) - n + 1)] if len(w) >= n else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    fp = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    return fp


def brute_components(fps, distance=4):
    up = {f: f for f in fps}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    d = sorted(set(fps))
    for i, a in enumerate(d):
        for b in d[:i]:
            if (a ^ b).bit_count() <= distance:
                up[find(a)] = find(b)
    return {f: find(f) for f in fps}


def expected(rows):
    fps = [brute_fingerprint(t) for _, t in rows]
    comp = brute_components(fps)
    low = {}
    for (i, _), f in zip(rows, fps):
        if i is not None:
            low[comp[f]] = min(low.get(comp[f], i), i)
    return sorted([(i, f"{f:016x}", low.get(comp[f])) for (i, _), f in zip(rows, fps)], key=repr)


def got(df):
    return sorted([(r.doc_id, f"{r.fp & (1 << 64) - 1:016x}", r.component_id) for r in df.collect()], key=repr)


def near_copies(n, seed=3):
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(400)}" for _ in range(220)]
    out = []
    for _ in range(n):
        t = list(base)
        for _ in range(rnd.randrange(3)):
            t[rnd.randrange(len(t))] = f"x{rnd.randrange(50)}"
        out.append(" ".join(t))
    return out


def test_matches_brute_force_with_odd_rows(make_docs):
    texts = [*near_copies(40), None, "", "  \t\n", "One two", "one TWO", "ÀB c d e", "àb c d e", "x " * 5000, "a b c d e f g"]
    rows = [*enumerate(texts), (3, texts[3]), (None, "null id alone here now"), (None, texts[0])]
    df = simhash.near_duplicates(make_docs(rows, extra=True))
    assert got(df) == expected(rows)


@pytest.mark.parametrize("segments", [2, 3, 5])
def test_segments_give_the_same_links(make_docs, segments):
    rows = list(enumerate(near_copies(60, seed=segments)))
    assert got(simhash.near_duplicates(make_docs(rows), segments=segments)) == expected(rows)


def test_hot_bucket_is_dealt_over_slots(make_docs, monkeypatch):
    monkeypatch.setattr(simhash, "SLOT_ROWS", 4)
    rows = list(enumerate(near_copies(80, seed=9)))
    assert got(simhash.near_duplicates(make_docs(rows))) == expected(rows)


def test_whole_small_table(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [tuple(r) for r in pick(docs, "doc_id", "text").collect()]
    assert got(simhash.near_duplicates(docs)) == expected(rows)


def test_empty_table(make_docs):
    assert simhash.near_duplicates(make_docs([])).count() == 0
    assert simhash.keep_one(make_docs([])).count() == 0


def test_keep_one_keeps_the_smallest_id_and_all_columns(make_docs):
    t = near_copies(6, seed=5)
    rows = [(5, t[0]), (2, t[0]), (2, t[0]), (9, "quite another text with its own words"), (None, "lonely words without any id"),
            (9, "same id but a different text than the other one")]
    docs = make_docs(rows, extra=True)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted([(r.doc_id, r.text) for r in kept.collect()], key=repr) == sorted({*rows[1:2], *rows[3:]}, key=repr)


def test_components_of_chains_hubs_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)] + [(7, 7), (None, 3), (200, 199), (199, 200)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = dict(map(tuple, connected_components(df).collect()))
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 199: 199, 200: 199}
