"""Packing: exact round trip, gapless sequences, the plan against brute force."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from postlytics.llm import packing
from llm_fixtures import SF001, make_docs  # noqa: F401

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(PATH)


ODD = ["", " ", "a", " a", "a ", "a  b", "a \n b", "x\t y", "two\n\nlines . ! ?", "<|endoftext|>", "a<|endoftext|> b", "don't 's 've",
       "² Ⅷ 12 ½ x²", "\x1c\x85 a", "日本語 テキスト。", "é ñ ü", "a b  c", "😀 emoji 👩‍👩‍👧", "word " * 300, "a" * 5000]


def test_ids_equal_those_of_the_tokenizer(tok, spark):
    texts = ODD + [r.text or "" for r in spark.read.parquet(f"{SF001}/documents.parquet").select("text").collect()]
    got = list(packing.Encoder(PATH).encode(texts))
    assert [g.tolist() for g in got] == [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]
    small = list(packing.Encoder(PATH).encode(texts, at_once=200))
    assert all((a == b).all() for a, b in zip(got, small))


def check(df, rows, tok, window, end=0):
    pieces = [r.asDict() for r in df.collect()]
    by_doc, by_seq = {}, {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
        by_seq.setdefault(p["sequence_id"], []).append(p)
    assert len(set(i for i, _ in rows)) == len(by_doc)
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [end]
        at = 0
        for p in sorted(by_doc[i], key=lambda p: p["start"]):
            part = ids[p["start"]:p["start"] + p["length"]]
            assert p["start"] == at and p["length"] == len(part) > 0 and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
            at += p["length"]
        assert at == len(ids)
    used = padded = 0
    for s in by_seq.values():
        at = 0
        for p in sorted(s, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= window
        used, padded = used + at, padded + (at if at & (at - 1) == 0 else window)
    return used, padded


@pytest.mark.parametrize("block", [64, 5000, 1 << 19])
def test_round_trip(make_docs, tok, block):
    rnd = random.Random(1)
    texts = [*ODD, None] + [" ".join("abcdefgh"[rnd.randrange(8)] + rnd.choice(["", ".", ""]) for _ in range(rnd.randrange(400)))
                            for _ in range(40)]
    rows = list(enumerate(texts))
    check(packing.pack(make_docs(rows, extra=True, partitions=3), PATH, window=64, block=block), rows, tok, 64)


def test_small_table_has_little_padding(spark, tok):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    used, padded = check(packing.pack(docs, PATH), [(r.doc_id, r.text) for r in docs.collect()], tok, 1024)
    assert padded / used < 1.01


def test_repeated_rows_null_ids_and_empty_tables(make_docs):
    docs = make_docs([(1, "same text"), (1, "same text"), (None, "no id")])
    got = packing.pack(docs, PATH, with_ids=True).collect()
    assert sum(r.length for r in got if r.doc_id == 1) == 2 * next(r.doc_tokens for r in got if r.doc_id == 1)
    assert any(r.doc_id is None for r in got) and all(len(r.ids) == r.length for r in got)
    assert packing.pack(make_docs([]), PATH).count() == 0


def cheapest(pos, price, window):
    best = {0: 0}
    for p, pay in zip(pos.tolist(), price.tolist()):
        best[p] = min(c + pay + packing.SEQUENCE + (0 if (p - q) & (p - q - 1) == 0 else window - (p - q))
                      for q, c in best.items() if 0 < p - q <= window)
    return best[int(pos[-1])]


@pytest.mark.parametrize("seed", range(20))
def test_plan_is_the_cheapest(seed):
    rnd = random.Random(seed)
    window = rnd.choice([16, 32])
    pos = np.array(sorted({*rnd.sample(range(1, 200), 60), *range(7, 200, 8), 200}))
    price = np.array([rnd.choice([0, 2, 12]) for _ in pos])
    cuts = packing.plan_cuts(pos, price, window)
    at = dict(zip(pos.tolist(), price.tolist()))
    cost = sum(at[c] + packing.SEQUENCE + (0 if (c - b) & (c - b - 1) == 0 else window - (c - b)) for b, c in zip([0, *cuts], cuts))
    assert cuts[-1] == 200 and all(0 < c - b <= window for b, c in zip([0, *cuts], cuts))
    assert cost == cheapest(pos, price, window)


@pytest.mark.parametrize("seed", range(8))
def test_packed_plan_is_the_cheapest(make_docs, seed):
    rnd = random.Random(seed)
    texts = [" ".join(rnd.choice(["a", "bc", "x.", "y!", "word"]) for _ in range(rnd.randrange(1, 90))) for _ in range(40)]
    docs = make_docs(texts).coalesce(1)
    enc = packing.Encoder(PATH)
    ids = [np.append(x, np.uint32(0)) for x in enc.encode(texts)]
    window, ends = 128, np.cumsum([len(x) for x in ids])
    pos, price = packing.candidates(np.concatenate(ids), ends, enc.ends, 2 * window)
    at = dict(zip(pos.tolist(), price.tolist()))
    sizes = {}
    for r in packing.pack(docs, PATH, window=window).collect():
        sizes[r.sequence_id] = sizes.get(r.sequence_id, 0) + r.length
    cuts = np.cumsum([sizes[k] for k in sorted(sizes)]).tolist()
    cost = sum(at[c] + packing.SEQUENCE + (0 if (c - b) & (c - b - 1) == 0 else window - (c - b)) for b, c in zip([0, *cuts], cuts))
    assert cost == cheapest(pos, price, window)


def test_known_words_are_encoded_once(monkeypatch):
    """A text of known words alone reaches no encoder, and texts with new words encode only these."""
    enc = packing.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["The old house", "The new house", "", "über das house, é"]
    want = [enc.tok.encode(t, add_special_tokens=False).ids for t in texts]
    asked = []
    whole, each = enc._whole, enc._each
    monkeypatch.setattr(enc, "_whole", lambda words: asked.append(sorted(words)) or whole(words))
    monkeypatch.setattr(enc, "_each", lambda words: asked.append(sorted(words)) or each(words))
    assert [ids.tolist() for ids in enc.encode(texts)] == want
    assert len(asked) == 2
    assert [ids.tolist() for ids in enc.encode(texts)] == want and len(asked) == 2
    assert [ids.tolist() for ids in enc.encode(["The red house"])] == [enc.tok.encode("The red house", add_special_tokens=False).ids]
    assert asked[2:] == [["red"]]
    monkeypatch.setattr(packing, "KEPT_WORDS", 0)
    assert [ids.tolist() for ids in packing.Encoder(public_tokenizers.path("byte_bpe_50k.json")).encode(texts)] == want
