"""Exact removal of repeated byte strings by prefix-free parsing.

A rolling hash of GRAM bytes picks triggers: the trigger of a `length`-byte window is its gram
of smallest hash (leftmost on a tie), which depends on the window's own bytes alone, so equal
windows have their triggers at the same place.  The run of windows with one trigger is a phrase;
neighbouring phrases overlap, and the phrases of a text in order are its parse.

    dictionary   distinct phrases with their number of occurrences
    parse        (text, trigger) rows, each naming a phrase

Corpus order is needed only as far as it puts equal `length`-byte prefixes of suffixes side by
side.  For a phrase that occurs twice all its suffixes do.  A phrase that occurs once can share
only part of them, and only with phrases of the same trigger gram.  Such dictionary entries are
cut into blocks of suffixes, aligned at the trigger: all suffixes of a block hold its core, and
its union holds them all.  A core that occurs once settles the block (nothing repeats), a union
that occurs twice too (everything does); only for the rest every suffix is listed, cut at
`length` bytes, and equal ones are brought together.  Digests of 128 bits stand for the strings,
so all steps are sums and joins by key, without a global sort or a group one task must hold.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlytics.llm.common import numbered, pick, restored, worker_cache, written

#: Bytes of a repeated string, of a trigger gram; window starts handled at once in a long text.
LENGTH, GRAM, CHUNK = 400, 100, 1 << 18
#: Suffixes of a block.
BLOCK = 16
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
MIX = np.uint64(0xD6E8FEB86659FD93)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    cache = worker_cache()
    if len(cache.get("pfp", ((), ()))[0]) < n:
        with np.errstate(over="ignore"):
            up, down = np.full(n, BASE, np.uint64), np.full(n, pow(BASE, -1, 1 << 64), np.uint64)
            up[0] = down[0] = 1
            cache["pfp"] = np.cumprod(up), np.cumprod(down)
    return cache["pfp"]


def phrases(body: bytes, length: int = LENGTH, gram: int = GRAM,
            chunk: int = CHUNK) -> Iterator[tuple[int, int, int, int]]:
    """(gram hash, trigger, first start, last start) of each run of windows with one trigger."""
    width = length - gram + 1
    for begin in range(0, len(body) - length + 1, chunk):
        part = np.frombuffer(body, np.uint8, min(len(body) - begin, chunk + length - 1), begin).astype(np.uint64)
        up, down = _powers(max(len(part) + 1, 1 << 16))
        with np.errstate(over="ignore"):
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part * up[:len(part)])])
            h = (total[gram:] - total[:-gram]) * down[:len(part) - gram + 1] * MIX
            h ^= h >> np.uint64(29)
            h *= MIX
        low = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
        size = 1
        while size * 2 <= width:
            low = np.minimum(low[:-size], low[size:])
            size *= 2
        if size < width:
            low = np.minimum(low[:size - width], low[width - size:])
        at = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(at))
        first, last = np.concatenate([[0], cuts + 1]), np.concatenate([cuts, [len(at) - 1]])
        t = at[first]
        yield from zip(h[t].view(np.int64).tolist(), (t + begin).tolist(), (first + begin).tolist(), (last + begin).tolist())


def _parse(length: int, gram: int):
    names = ["gram", "phrase", "key", "trigger", "first", "last"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows):
            kinds = (pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        rows: list[tuple] = []
        for b in batches:
            for key, body in zip(b.column("key").to_pylist(), b.column("body").to_pylist()):
                for g, t, first, last in phrases(body, length, gram):
                    rows.append((g, xxhash.xxh3_128_digest(body[first:last + length]), key, t, first, last))
                    if len(rows) >= 50_000:
                        yield out(rows)
                        rows = []
        if rows:
            yield out(rows)

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    z = zstandard.ZstdCompressor(level=1)
    for b in batches:
        yield pa.RecordBatch.from_arrays(
            [b.column("key"), pa.array([z.compress(x) for x in b.column("body").to_pylist()], pa.binary())],
            names=["key", "packed"])


def _listed(rows_of, schema: pa.Schema, length: int):
    """Rows (of `schema`) that rows_of makes from a text and each of its entries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdDecompressor()
        rows: list[tuple] = []
        for b in batches:
            for key, packed, entries in zip(*(b.column(c) for c in ("key", "packed", "entries"))):
                key, body = key.as_py(), z.decompress(packed.as_py())
                for e in entries:  # Python objects of one entry at a time, a text may have very many
                    e = e.as_py()
                    rows += rows_of(body, key, e, length)
                    if len(rows) >= 50_000:
                        yield batch(rows)
                        rows = []
        if rows:
            yield batch(rows)

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run


def _blocks(body: bytes, key: bytes, e: dict, length: int) -> list[tuple]:
    """(core, union, key, n, first, last) of the blocks of a phrase; n is how often the phrase occurs."""
    t, first, last, out = e["trigger"], e["first"], e["last"], []
    for q in range((t - last) // BLOCK, (t - first) // BLOCK + 1):
        hi = t - q * BLOCK  # the latest start of the block, were it whole
        lo = hi - BLOCK + 1
        a, z = max(first, lo), min(last, hi)
        out.append((xxhash.xxh3_128_digest(body[hi:lo + length]), xxhash.xxh3_128_digest(body[a:z + length]), key, e["n"], a, z))
    return out


def _suffixes(body: bytes, key: bytes, e: dict, length: int) -> list[tuple]:
    """(suffix, key or null, start, n) of the suffixes of a block; a key only where n is 1, for
    more often they are known to repeat and only matter as partners."""
    own = key if e["n"] == 1 else None
    return [(xxhash.xxh3_128_digest(body[i:i + length]), own, i, e["n"]) for i in range(e["first"], e["last"] + 1)]


BLOCK_ROWS = pa.schema([("core", pa.binary()), ("union", pa.binary()), ("key", pa.binary()), ("n", pa.int64()),
                        ("first", pa.int64()), ("last", pa.int64())])
SUFFIX_ROWS = pa.schema([("suffix", pa.binary()), ("key", pa.binary()), ("start", pa.int64()), ("n", pa.int64())])


def _often(df: DataFrame, key: str, n: str = "1") -> DataFrame:
    """The keys whose sum of n is two or more; written, so that a join with them is of two plain
    shuffles and AQE can split a hot key."""
    return written(df.groupBy(key).agg(F.sum(F.expr(n)).alias("c")).where("c > 1").select(key), f"pfp-often-{key}")


def _by_text(texts: DataFrame, entries: DataFrame) -> DataFrame:
    """Distinct texts, compressed for the shuffle, that have entries, with the list of them."""
    packed = texts.mapInArrow(_packed, "key binary, packed binary").dropDuplicates(["key"])
    return packed.join(entries.groupBy("key").agg(F.collect_list("e").alias("entries")), "key")


def text_key(text: str = "text"):
    return F.unhex(F.substring(F.sha2(F.col(text), 256), 1, 32))


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(key, spans): for each distinct text with a repeat, flat pairs (begin, end) of its bytes that
    are covered by `length`-byte strings which also start elsewhere; not merged, in no order.

    key is text_key().  Null texts and texts under `length` bytes have no row.  Each row of docs
    is a text of its own, so a text that occurs twice is wholly covered.
    """
    if not 0 < gram <= length:
        raise ValueError("gram must be 1 to length")
    texts = (pick(docs, "text").where(F.octet_length("text") >= length)
             .select(text_key().alias("key"), F.encode("text", "UTF-8").alias("body")))
    parse = written(texts.mapInArrow(
        _parse(length, gram), "gram bigint, phrase binary, key binary, trigger bigint, first bigint, last bigint"), "pfp-parse")
    shared = written(parse.join(_often(parse, "gram"), "gram", "left_semi"), "pfp-shared")
    dictionary = written(shared.groupBy("gram", "phrase").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "trigger", "first", "last")).alias("at")), "pfp-dictionary")
    spans = [shared.join(dictionary.where("n > 1").select("gram", "phrase"), ["gram", "phrase"], "left_semi")
             .select("key", "first", (F.col("last") + length).alias("end")).distinct()]

    entries = (dictionary.join(_often(dictionary, "gram"), "gram", "left_semi")
               .select("at.key", F.struct("at.trigger", "at.first", "at.last", "n").alias("e")))
    blocks = written(_by_text(texts, entries).mapInArrow(
        _listed(_blocks, BLOCK_ROWS, length),
        "core binary, union binary, key binary, n bigint, first bigint, last bigint"), "pfp-blocks")
    unions = written(blocks.groupBy("core", "union").agg(
        F.sum("n").alias("n"), F.min(F.struct("key", "first", "last")).alias("at")), "pfp-unions")
    spans.append(blocks.where("n = 1").join(unions.where("n > 1").select("core", "union"), ["core", "union"], "left_semi")
                 .select("key", "first", (F.col("last") + length).alias("end")))

    open_cores = unions.groupBy("core").agg(F.count(F.lit(1)).alias("c"), F.min("n").alias("low")).where("c > 1 and low = 1")
    entries = (unions.join(written(open_cores.select("core"), "pfp-open"), "core", "left_semi")
               .select("at.key", F.struct("at.first", "at.last", "n").alias("e")))
    suffixes = written(_by_text(texts, entries).mapInArrow(
        _listed(_suffixes, SUFFIX_ROWS, length), "suffix binary, key binary, start bigint, n bigint"), "pfp-suffixes")
    spans.append(suffixes.where("key is not null").join(_often(suffixes, "suffix", "n"), "suffix", "left_semi")
                 .select("key", F.col("start").alias("first"), (F.col("start") + length).alias("end")))
    return written(spans[0].union(spans[1]).union(spans[2]).groupBy("key")
                   .agg(F.flatten(F.collect_list(F.array("first", "end"))).alias("spans")), "pfp-spans")


def merged(flat: pa.ListScalar | list[int] | None) -> list[tuple[int, int]]:
    """Disjoint, not touching, ascending spans.  There may be one for each byte of a text, so they
    stay in an array and only what is left of them becomes Python objects."""
    if isinstance(flat, pa.ListScalar):
        flat = flat.values
    if flat is None or len(flat) == 0:
        return []
    pairs = np.asarray(flat, np.int64).reshape(-1, 2)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(pairs[:, 1])
    new = np.flatnonzero(pairs[1:, 0] > reach[:-1]) + 1
    begins, ends = np.concatenate([[0], new]), np.concatenate([new, [len(pairs)]]) - 1
    return list(zip(pairs[begins, 0].tolist(), reach[ends].tolist()))


def cut(body: bytes, spans: list[tuple[int, int]]) -> bytes:
    """What is left of body without the spans."""
    out, at = [], 0
    for lo, hi in spans:
        out.append(body[at:lo])
        at = hi
    return b"".join([*out, body[at:]])


def whole_characters(body: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans without the bytes of characters that they hold only in part."""
    out = []
    for lo, hi in spans:
        while lo < hi and lo < len(body) and body[lo] & 0xC0 == 0x80:
            lo += 1
        while hi > lo and hi < len(body) and body[hi] & 0xC0 == 0x80:
            hi -= 1
        if lo < hi:
            out.append((lo, hi))
    return out


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out: list[list] = [[], [], [], []]
        for text, flat in zip(b.column("text").to_pylist(), b.column("spans")):
            body, spans = (text or "").encode("utf-8", "surrogatepass"), merged(flat)
            row = (len(body), sum(hi - lo for lo, hi in spans), len(spans), hashlib.sha256(cut(body, spans)).hexdigest())
            for c, v in zip(out, row):
                c.append(v)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c, k) for c, k in zip(out, kinds))],
                                         names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _cut_texts(at: str, min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text, flat in zip(b.column(at).to_pylist(), b.column("spans")):
                if text is not None and flat.is_valid:
                    body = text.encode("utf-8", "surrogatepass")
                    spans = whole_characters(body, merged(flat))
                    if min_words:
                        spans = [(lo, hi) for lo, hi in spans if len(body[lo:hi].split()) >= min_words]
                    text = cut(body, spans).decode("utf-8", "surrogatepass")
                out.append(text)
            names = [c for c in b.schema.names if c != "spans"]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()) if c == at else b.column(c) for c in names], names=names)

    return run


def _with_spans(rows: DataFrame, spans: DataFrame, text: str = "text") -> DataFrame:
    return rows.withColumn("key", text_key(text)).join(spans, "key", "left").drop("key")


def removed_bytes(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 per row of docs (see repeated_spans).

    Null and empty texts have 0 bytes and the digest of nothing; of copies, and of repeated
    rows, of at least `length` bytes nothing is left; an empty table gives no rows.
    """
    kind = dict(pick(docs, "doc_id").dtypes)["doc_id"]
    return _with_spans(pick(docs, "doc_id", "text"), repeated_spans(docs, length, gram)).mapInArrow(
        _digests, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, min_words: int = 0) -> DataFrame:
    """docs with the repeated strings cut out of `text`; all rows and columns stay, n_chars (if
    there) is counted anew.  A character that a span holds only in part stays whole.

    With `min_words`, what overlapping strings cover goes only where it has so many words: a
    `length` under the bytes of so many words then finds every shared run of them, and shorter
    runs stay.  Null texts stay null; a text that is nothing but repeats becomes empty, so of
    copies, and of repeated rows, nothing is left.  Other columns may have any name.  An empty
    table gives no rows.
    """
    rows, at = numbered(docs, "text")
    text, n_chars = at["text"], f"__{docs.columns.index('n_chars')}" if "n_chars" in docs.columns else None
    rows = rows.withColumn(text, F.col(text).cast("string"))
    out = _with_spans(rows, repeated_spans(docs, length, gram), text).mapInArrow(
        _cut_texts(text, min_words), ", ".join(f"`{c}` {t}" for c, t in rows.dtypes))
    if n_chars:
        out = out.withColumn(n_chars, F.coalesce(F.length(text), F.lit(0)).cast(dict(rows.dtypes)[n_chars]))
    return restored(out, docs)
