"""Order-preserving packing: window cuts by dynamic programming.

Each partition's documents form one token stream in the order the partition holds them.  Cuts
are chosen at document and sentence ends (free, or at a small price) or inside a sentence (at a
higher price, every STEP tokens from its start; at every place of the last two windows of a
partition), so that padding plus penalties is least.  A window of L tokens is padded to
`window` unless L is a power of two, so a cut at position p costs

    cost[p] = price(p) + SEQUENCE + min( min over p - window <= q < p of cost[q] + q  + window - p,
                                         min over k of cost[p - 2**k] )

where p and all q are such places and 2**k takes every power of two from 1 to `window`.  The
first minimum is over a sliding window and kept in a monotone queue.  No shuffle: a
partition is packed as it streams by, in blocks that bound memory; the last windows of a block
are planned again with the next one.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import deque
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from postlytics.llm.common import pick, worker_cache

#: Prices in units of one padding token: a cut at a sentence end, a cut inside a sentence, a sequence.
SENTENCE, INSIDE, SEQUENCE = 2, 12, 1
#: Inside a sentence a cut is possible after so many tokens.
STEP = 32
#: Tokens planned at once, and words kept with their ids by a Python worker.
BLOCK, KEPT_WORDS = 1 << 19, 1_000_000
#: Fixed value: the split pattern of byte-level tokenizers.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A space that is followed by white space or ends the text: such texts are encoded whole.
LOOSE_SPACE = re.compile(r" (?=\s|\Z)")


def _same_merges(spec: dict):
    """A tiktoken encoding with the vocabulary and merges of a `tokenizers` file, or None if the
    file is not plain byte-level BPE whose ids follow the order of its merges."""
    import tiktoken

    pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
    if (pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True)
            or spec.get("normalizer") or model.get("type") != "BPE" or model.get("ignore_merges")):
        return None
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes written as themselves, the rest from 256 on
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    vocab, merges = model["vocab"], [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    order = [vocab.get(a + b, -1) for a, b in merges]
    base = {vocab[c] for c in byte if c in vocab}
    if len(base) < 256 or order != sorted(set(order)) or order and order[0] < max(base):
        return None
    added = {t["content"] for t in spec.get("added_tokens") or []}
    ranks = {bytes(byte[c] for c in s): i for s, i in vocab.items() if s not in added}
    return tiktoken.Encoding("same", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class Encoder:
    """Ids of whole texts by a `tokenizers` file, without added special tokens.

    For a byte-level vocabulary with its usual split pattern a token never spans the place
    before a space that is followed by another character, so a text is encoded word by word
    and each worker encodes a frequent word once; new words go through the same vocabulary and
    merge order in `tiktoken`, several times faster.  Texts with loose spaces or special strings,
    and all texts of other tokenizers, are encoded whole by `tokenizers`.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.fast = _same_merges(spec)
        self.special = [t["content"] for t in spec.get("added_tokens") or []]
        vocab = self.tok.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocab.values(), default=0) + 2, dtype=bool)
        self.sizes = np.zeros(len(self.ends), dtype=np.int64)  # bytes of a token of a byte-level vocabulary
        for s, i in vocab.items():
            self.ends[i] = s[-1:] in ".!?" or "Ċ" in s or "\n" in s
            self.sizes[i] = len(s)
        self.words: dict[str, bytes] = {}  # ids of a word after a space, and of one that begins a text
        self.begins: dict[str, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        out = self.tok.encode_batch(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in out]

    def _each(self, words: list[str]) -> list[bytes]:
        """Ids of each word after a space: all are encoded as one text and cut where words begin."""
        ids = self.fast.encode_to_numpy("".join([" " + w for w in words])).astype("<u4")
        stops = np.cumsum([len(w.encode("utf-8", "surrogatepass")) + 1 for w in words])
        cuts = (np.searchsorted(np.cumsum(self.sizes[ids]), stops) + 1) * 4
        raw, lo, out = ids.tobytes(), 0, []
        for hi in cuts.tolist():
            out.append(raw[lo:hi])
            lo = hi
        return out

    def _by_word(self, texts: list[str]) -> list[bytes]:
        split = [t.split(" ") for t in texts]
        first = self._firsts([s.pop(0) for s in split])
        known, out, missing = self.words, [], []
        for s in split:  # most texts have no new word: one look-up a word, no set of words
            try:
                out.append(b"".join(map(known.__getitem__, s)))
            except KeyError:
                missing.append(len(out))
                out.append(b"")
        if missing:
            todo = list(set(chain.from_iterable(split[i] for i in missing)).difference(known))
            new = dict(zip(todo, self._each(todo)))
            if len(known) + len(new) <= KEPT_WORDS:
                known.update(new)
                at = known.__getitem__
            else:
                at = lambda w: known[w] if w in known else new[w]
            for i in missing:
                out[i] = b"".join(map(at, split[i]))
        return [a + b for a, b in zip(first, out)]

    def _firsts(self, words: list[str]) -> list[bytes]:
        """Ids of each word at the beginning of a text, a frequent one encoded once."""
        known = self.begins
        todo = list(set(words).difference(known))
        new = dict(zip(todo, self._whole(todo))) if todo else {}
        if len(known) + len(new) <= KEPT_WORDS:
            known.update(new)
        return [known[w] if w in known else new[w] for w in words]

    def encode(self, texts: list[str], at_once: int = 1 << 20) -> Iterator[np.ndarray]:
        """Ids of each text as little-endian unsigned 32-bit numbers; about `at_once` characters at a time."""
        part, size = [], 0
        for t in texts:
            whole = not self.fast or LOOSE_SPACE.search(t) or any(s in t for s in self.special)
            if whole or len(t) > at_once:
                yield from (np.frombuffer(x, "<u4") for x in (self._by_word(part) if part else ()))
                part, size = [], 0
                yield np.frombuffer(b"".join(self._whole([t]) if whole else self._long(t, at_once)), "<u4")
                continue
            part.append(t)
            size += len(t)
            if size >= at_once:
                yield from (np.frombuffer(x, "<u4") for x in self._by_word(part))
                part, size = [], 0
        if part:
            yield from (np.frombuffer(x, "<u4") for x in self._by_word(part))

    def _long(self, text: str, at_once: int) -> Iterator[bytes]:
        lo = 0
        while lo < len(text):
            hi = len(text) if len(text) - lo <= at_once else text.rfind(" ", lo + 1, lo + at_once)
            hi = hi if hi > lo else (text.find(" ", lo + at_once) if text.find(" ", lo + at_once) > 0 else len(text))
            yield from self._by_word([text[lo:hi]])
            lo = hi


def encoder(path: str) -> Encoder:
    cache = worker_cache()
    if (key := ("packing", path)) not in cache:
        cache[key] = Encoder(path)
    return cache[key]


def candidates(ids: np.ndarray, doc_ends: np.ndarray, ends: np.ndarray, tail: int) -> tuple[np.ndarray, np.ndarray]:
    """Possible cuts (positions after a token, ascending, the last is len(ids)) and their prices.

    Document ends, sentence ends, every STEP-th place inside longer sentences, and every place
    of the last `tail` tokens.
    """
    n = len(ids)
    price = np.full(n + 1, -1, dtype=np.int16)
    price[np.arange(max(0, n - tail), n + 1)] = INSIDE
    sent = np.flatnonzero(ends[ids]) + 1
    stops = np.unique(np.concatenate([[0], sent, doc_ends, [n]]))
    gaps = np.diff(stops)
    for a, g in zip(stops[:-1][gaps > STEP].tolist(), gaps[gaps > STEP].tolist()):
        price[a + STEP:a + g:STEP] = INSIDE
    price[sent] = SENTENCE
    price[doc_ends] = 0
    price[n] = 0
    price[0] = -1
    pos = np.flatnonzero(price >= 0)
    return pos, price[pos]


def plan_cuts(pos: np.ndarray, price: np.ndarray, window: int) -> list[int]:
    """The cheapest ascending cuts from 0 to pos[-1], no two further apart than `window`.

    `pos` must have no gap over `window`.  A sequence may be unpadded at any power of two.  Ties
    take the earliest start of the last sequence if it is padded, else its shortest length.
    """
    n = int(pos[-1]) if len(pos) else 0
    at = [0] * (n + 1)
    back = [0] * (n + 1)
    queue: deque[tuple[float, int]] = deque([(0, 0)])  # (cost[q] + q, q), ascending in both
    possible = np.zeros(n + 1, dtype=bool)
    possible[0] = True
    possible[pos] = True
    fits = np.zeros(len(pos), dtype=np.int64)  # bit k: a sequence of 2**k tokens may end here
    for k in range(window.bit_length()):
        fits |= (possible[np.maximum(pos - (1 << k), 0)] & (pos >= 1 << k)).astype(np.int64) << k
    lengths: dict[int, list[int]] = {}
    for bits in np.unique(fits).tolist():
        lengths[bits] = [1 << k for k in range(bits.bit_length()) if bits >> k & 1]
    for p, pay, bits in zip(pos.tolist(), price.tolist(), fits.tolist()):
        while queue[0][1] < p - window:
            queue.popleft()
        best, q = queue[0][0] + window - p, queue[0][1]
        for L in lengths[bits]:
            if at[p - L] < best:
                best, q = at[p - L], p - L
        at[p] = cost = best + pay + SEQUENCE
        back[p] = q
        while queue and queue[-1][0] > cost + p:
            queue.pop()
        queue.append((cost + p, p))
    cuts = []
    while n:
        cuts.append(n)
        n = back[n]
    return cuts[::-1]


COLUMNS = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def pack(docs: DataFrame, tokenizer_path: str, window: int = 1024, end_id: int = 0,
         block: int = BLOCK, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset
    (and ids, array<bigint>, if asked for).

    A document is its ids and then `end_id`; null and empty texts have that id alone.  Every id
    lies in exactly one piece, sequences hold whole pieces in order, at most `window` ids, and
    offsets in a sequence are gapless from 0.  Ties in the plan take the earliest start.
    Repeated rows are documents of their own (same doc_id, other sequences or offsets); a null
    doc_id stays null.  An empty table gives no rows.  sequence_id holds the partition in its
    upper bits and counts from 0 in each.
    """
    if window < 1 or window & (window - 1):
        raise ValueError("window must be a power of two")
    kind = dict(pick(docs, "doc_id").dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        id_type = None
        seq = TaskContext.get().partitionId() << 40
        held: list[list] = []  # [doc_id, ids not yet packed, how many of the document are, doc_tokens]
        size = 0

        def flush(final: bool):
            nonlocal held, size, seq
            ids = np.concatenate([h[1] for h in held])
            doc_ends = np.cumsum([len(h[1]) for h in held])
            tail = 2 * window if final else 0
            cuts = plan_cuts(*candidates(ids, doc_ends, enc.ends, tail), window)
            if not final:  # the last windows meet more text: plan them again
                cuts = [c for c in cuts if c <= len(ids) - 8 * window]
            out: list[list] = [[], [], [], [], [], [], [], []]
            d, lo = 0, 0
            for cut in cuts:
                offset = 0
                while lo < cut:
                    doc = held[d]
                    begin = int(doc_ends[d]) - len(doc[1])
                    hi = min(cut, int(doc_ends[d]))
                    raw = ids[lo:hi]
                    for c, v in zip(out, (doc[0], doc[2] + lo - begin, hi - lo, zlib.crc32(raw.tobytes()), doc[3],
                                          seq, offset, raw.tolist() if with_ids else None)):
                        c.append(v)
                    offset += hi - lo
                    lo = hi
                    d += hi == doc_ends[d]
                seq += 1
            rest = held[d:]
            if rest and (used := lo - (int(doc_ends[d]) - len(rest[0][1]))):
                rest[0] = [rest[0][0], rest[0][1][used:], rest[0][2] + used, rest[0][3]]
            held, size = rest, sum(len(h[1]) for h in rest)
            arrays = [pa.array(out[0], id_type), *(pa.array(c, pa.int64()) for c in out[1:7])]
            names = ["doc_id", *COLUMNS]
            if with_ids:
                arrays, names = [*arrays, pa.array(out[7], pa.list_(pa.int64()))], [*names, "ids"]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for b in batches:
            id_type = b.schema.field("doc_id").type
            texts = [t or "" for t in b.column("text").to_pylist()]
            for doc_id, ids in zip(b.column("doc_id").to_pylist(), enc.encode(texts)):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                held.append([doc_id, ids, 0, len(ids)])
                size += len(ids)
                if size >= block + 16 * window:
                    yield flush(False)
        if held:
            yield flush(True)

    extra = ", ids array<bigint>" if with_ids else ""
    schema = f"doc_id {kind}, " + ", ".join(f"`{c}` bigint" for c in COLUMNS) + extra
    return pick(docs, "doc_id", "text").mapInArrow(run, schema)
