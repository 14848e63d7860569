"""The prefix trie against a dictionary of all prefixes."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from postlytics.llm import prefix_trie as P
from llm_fixtures import EXTRA, SF01

WORD = re.compile("[^\x20\x09-\x0d]+")


def expected(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, tie, role, text))
    own = {c: [x[3:] for x in sorted(t)] for c, t in own.items()}
    built = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        giver = c - (c % 20 if c >= 0 else -(-c % 20))
        built[c] = tuple(own.get(giver, [])[:h] + t[h:])
    if not built:
        return []
    members, stop, kids = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, t in built.items():
        stop[t].append(c)
        for d in range(len(t) + 1):
            members[t[:d]].append(c)
            if d:
                kids[t[:d - 1]].add(t[:d])
    saved, leaves = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        here = (len(m) - 1) * len(WORD.findall(p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += here
            leaves[p[:d]] += not kids[p]
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, sorted(stop[p]))).encode()).hexdigest()) for p, m in members.items()), key=repr)


def table(spark, rows, parts=3):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(parts)
    return df.select("*", *[F.lit("x").alias(c) for c in [*EXTRA, "at", "part", "CONV_ID", "Text"]])


def got(df, **kw):
    return sorted((tuple(r) for r in P.trie(df, **kw).collect()), key=repr)


def test_whole_table(spark):
    df = spark.read.parquet(f"{SF01}/conversations.parquet")
    assert got(df) == expected([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


ODD = [(None, 0, "user", "no conversation"), (1, None, "user", "null turn first"), (1, 0, None, None), (1, 0, "user", None),
       (1, 1, "", ""), (1, 1, "", ""), (2, 5, "user", "a  b\tc"), (2, 5, "assistant", "tie"), (3, 0, "user", "only"),
       (20, 0, "user", "hello there"), (20, 1, "assistant", "hi"), (20, 2, "user", "bye"), (20, 3, "assistant", "ok"),
       *[(c, t, "user", f"turn {t}") for c in (21, 22, 23, 24, 25, 39) for t in range(5)], (-1, 0, "user", "hello there"), (-20, 0, "u", "x y")]


def random_rows(seed, n, longest):
    r = random.Random(seed)
    rows = []
    for c in range(n):
        words = [r.choice("ab") for _ in range(r.choice([0, 1, 2, longest]))] if r.random() < 0.7 else ["a"] * longest
        rows += [(c, t, "user", f"{w} {w} {t % 3}") for t, w in enumerate(words)]
    return rows


@pytest.mark.parametrize("length", [1, 2, 3, 256])
def test_odd_rows_in_segments(spark, length):
    """Ties, nulls, repeated and clashing rows; short segments put tries below tries."""
    assert got(table(spark, ODD), length=length) == expected(ODD)


@pytest.mark.parametrize("seed, n, longest, length, part_rows", [(1, 60, 7, 2, 3), (2, 80, 12, 5, 4), (3, 50, 9, 256, 2), (4, 40, 30, 1, 5)])
def test_random_conversations_over_many_partitions(spark, seed, n, longest, length, part_rows):
    """Most conversations are copies or prefixes of one; nodes reach over several partitions."""
    rows = random_rows(seed, n, longest)
    assert got(table(spark, rows, 5), length=length, part_rows=part_rows) == expected(rows)


def test_one_conversation_and_no_conversation(spark):
    assert got(table(spark, [(20, t, "user", "word " * t) for t in range(9)]), length=4) == \
        expected([(20, t, "user", "word " * t) for t in range(9)])
    assert got(table(spark, [(1, 0, "user", "x")])) == expected([(1, 0, "user", "x")])
    empty = P.trie(table(spark, []))
    assert empty.count() == 0 and empty.columns[0] == "conv_id"
    assert got(table(spark, [(None, 0, "user", "x")])) == []
