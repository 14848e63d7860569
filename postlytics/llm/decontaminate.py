"""Benchmark decontamination by a prefix-filtered join of item windows with documents.

Containment is exact, so of a window's words, ordered by how rare they are in the corpus, the
first alone is the necessary prefix: a document that holds the window holds its rarest word, at
a known place in it.  Documents are probed with those prefix words; a match is bounded by
position and length and then verified word by word.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlytics.llm.common import numbered, pick, restored, written

#: Consecutive item words of a window; bytes of windows that are broadcast at a time.
WINDOW, BLOCK_BYTES = 10, 32 << 20
#: A-Z become a-z, all ASCII but letters and digits becomes a space.
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
              for c in range(256))


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(TABLE).split() if text else []


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct (item, words): `window` consecutive words of an item, or all of a shorter one.

    Items without words give none.  A null item_id is written as the empty string.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = {(i or "", b" ".join(w[k:k + window]))
                   for i, t in zip(b.column("item").to_pylist(), b.column("text").to_pylist()) if (w := words(t))
                   for k in range(max(1, len(w) - window + 1))}
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.string()),
                                              pa.array([x[1] for x in out], pa.binary())], names=["item", "words"])

    d = pick(items, "item_id", "text").select(F.col("item_id").cast("string").alias("item"), "text")
    return d.mapInArrow(run, "item string, words binary").distinct()


def _counter(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, known = Counter(), vocabulary.value
        for b in batches:
            for t in b.column("text").to_pylist():
                seen.update([w for w in words(t) if w in known])
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())],
                                         names=["word", "n"])
    return run


def build_index(rows: list[tuple[str, bytes]], rarity: dict[bytes, int]) -> tuple[dict, list[list[str]]]:
    """prefix word -> [(its place in the window, window, number)], and the items of each number."""
    of: dict[bytes, list[str]] = {}
    for item, w in rows:
        of.setdefault(w, []).append(item)
    index: dict[bytes, list[tuple]] = {}
    for k, w in enumerate(of):
        window = w.split(b" ")
        place = min(range(len(window)), key=lambda i: (rarity.get(window[i], 0), window[i], i))
        index.setdefault(window[place], []).append((place, window, k))
    return index, list(of.values())


def find(w: list[bytes], index: dict) -> list[tuple[int, int, int]]:
    """(first word, end, number) of every occurrence of an indexed window."""
    n, out = len(w), []
    for at in [i for i, x in enumerate(w) if x in index]:
        for place, window, k in index[w[at]]:
            lo = at - place
            hi = lo + len(window)
            if lo >= 0 and hi <= n and w[lo:hi] == window:
                out.append((lo, hi, k))
    return out


def _prober(index, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefix, items = index.value
        spans_t, items_t = pa.list_(pa.int32()), pa.list_(pa.string())
        for b in batches:
            spans, found = b.column("spans").to_pylist(), b.column("found").to_pylist()
            sizes = []
            for r, t in enumerate(b.column("text").to_pylist()):
                w = words(t)
                sizes.append(len(w))
                if hits := find(w, prefix):
                    spans[r] += [x for lo, hi, _ in hits for x in (lo, hi)]
                    found[r] = sorted({*found[r], *(i for _, _, k in hits for i in items[k])})
            keep = [c for c in b.schema.names if c not in ("n_words", "spans", "found") and (with_text or c != "text")]
            yield pa.RecordBatch.from_arrays(
                [*map(b.column, keep), pa.array(sizes, pa.int64()),
                 pa.array([_merged(s) for s in spans], spans_t), pa.array(found, items_t)],
                names=[*keep, "n_words", "spans", "found"])
    return run


def _merged(flat: list[int]) -> list[int]:
    """Disjoint ascending spans of the same words, flat."""
    out: list[int] = []
    for lo, hi in sorted(zip(flat[::2], flat[1::2])):
        if out and lo <= out[-1]:
            out[-1] = max(out[-1], hi)
        else:
            out += [lo, hi]
    return out


def _index(texts: DataFrame, block: list[tuple[str, bytes]]):
    """The broadcast index of a block of windows, by how rare their words are in the texts."""
    context = texts.sparkSession.sparkContext
    vocabulary = context.broadcast({x for _, v in block for x in v.split(b" ")})
    counts = texts.mapInArrow(_counter(vocabulary), "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    rarity = {bytes(r.word): r.n for r in counts.toLocalIterator()} if block else {}
    vocabulary.destroy()
    return context.broadcast(build_index(block, rarity))


def _merge_hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        spans = [_merged([x for part in row for x in part]) for row in b.column("spans").to_pylist()]
        found = [sorted({x for part in row for x in part}) for row in b.column("found").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b.column("row_key"), pa.array(spans, pa.list_(pa.int32())), pa.array(found, pa.list_(pa.string()))],
            names=["row_key", "spans", "found"])


def _probed(rows: DataFrame, items: DataFrame, window: int, block_bytes: int, keep_text: bool) -> DataFrame:
    """rows (with `text`) and n_words, spans, found; without text unless it is to be kept.

    Windows of more than one block: rows are written once with a key, each block's hits are written
    and its index destroyed before the next is built, and hits are merged by key.
    """
    w = written(item_windows(items, window), "benchmark-windows")
    total = w.agg(F.sum(F.octet_length("words") + F.octet_length("item") + 64)).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    none = {"n_words": F.lit(0).cast("long"), "spans": F.array().cast("array<int>"), "found": F.array().cast("array<string>")}

    def windows(k: int) -> list[tuple[str, bytes]]:
        return [(r.item, bytes(r.words)) for r in w.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == k).toLocalIterator()]

    def probe(d: DataFrame, index, with_text: bool) -> DataFrame:
        kept = [f"`{c}` {t}" for c, t in d.dtypes if with_text or c != "text"]
        return d.withColumns(none).mapInArrow(
            _prober(index, with_text), ", ".join([*kept, "n_words bigint", "spans array<int>", "found array<string>"]))

    if blocks == 1:
        return probe(rows, _index(rows.select("text"), windows(0)), keep_text)
    rows = written(rows.withColumn("row_key", F.monotonically_increasing_id()), "benchmark-rows")
    texts = rows.select("row_key", "text")
    hits = []
    for k in range(blocks):
        if not (block := windows(k)):
            continue
        index = _index(texts.select("text"), block)
        found = probe(texts, index, False).where(F.size("spans") > 0)
        hits.append(written(found.select("row_key", "spans", "found"), "benchmark-hits"))
        index.destroy()
    every = reduce(DataFrame.union, hits).groupBy("row_key").agg(
        F.collect_list("spans").alias("spans"), F.collect_list("found").alias("found"))
    merged = written(every.mapInArrow(_merge_hits, "row_key bigint, spans array<int>, found array<string>"), "benchmark-hits")
    nothing = rows.sparkSession.sparkContext.broadcast(({}, []))
    sized = probe(rows, nothing, keep_text).drop("spans", "found").join(merged, "row_key", "left")
    return sized.withColumns({c: F.coalesce(c, none[c]) for c in ("spans", "found")}).drop("row_key")


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, item_ids (array<string>, sorted, distinct), spans (flat word
    spans), contaminated, per row of docs.

    Null and empty texts have no words and no hit; repeated rows each get their row; items with
    equal text or id are found under each id once.  No items: nothing is contaminated.  Windows
    are dealt by hash into blocks of about `block_bytes`; one block at a time is on the driver and
    broadcast.  Each block scans the texts twice, for rarity and for hits, so time grows with the
    benchmark, the memory for windows does not.
    """
    rows = _probed(pick(docs, "doc_id", "text"), items, window, block_bytes, keep_text=False)
    hit = F.aggregate(F.sequence(F.lit(0), F.size("spans") - 1), F.lit(0).cast("long"),
                      lambda a, i: a + F.when(i % 2 == 1, F.get("spans", i) - F.get("spans", i - 1)).otherwise(0))
    return rows.select("doc_id", "n_words", F.when(F.size("spans") > 0, hit).otherwise(F.lit(0).cast("long")).alias("n_hit"),
                       F.col("found").alias("item_ids"), "spans", (F.size("spans") > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of docs, all columns, that hold no benchmark window; texts are shuffled only if
    there is more than one block and the rows that have hits are too many to broadcast.

    Null and empty texts hold none and stay, of repeated rows all stay or go, other columns may
    have any name.  An empty table, or one of items, is left as it is."""
    rows, at = numbered(docs, "text")
    rows = rows.withColumnRenamed(at["text"], "text")
    clean = _probed(rows, items, window, block_bytes, keep_text=True).where(F.size("spans") == 0)
    return restored(clean.withColumnRenamed("text", at["text"]), docs)
