"""SimHash near-duplicates by multi-index hashing.

A 64-bit fingerprint is cut into `segments` parts.  Two fingerprints at most `distance` bits
apart differ in at most distance // segments bits of some part, so each fingerprint probes,
part by part, the keys of that small Hamming ball; table matches are verified on all 64 bits.
Work is on distinct fingerprints: copies never meet each other.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlytics.llm.common import numbered, pick, restored, written
from postlytics.llm.components import connected_components

#: Shingle length and bits of the production query.
WORDS, DISTANCE = 4, 4
#: A table bucket is dealt over slots of about so many fingerprints.
SLOT_ROWS = 2048


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """Signed 64-bit SimHash of the word shingles, repeats included.

    A-Z are lower-cased, words are runs without ASCII white space; fewer words than a shingle
    make one shingle; null, empty or blank text gives 0.
    """
    w = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not w:
        return 0
    grams = zip(*(w[i:] for i in range(words))) if len(w) >= words else (w,)
    h = np.fromiter((xxhash.xxh64_intdigest(b" ".join(g), 42) for g in grams), dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(h), 1 << 16):  # bounded memory for very long texts
        part = h[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, text_hash, fp) of every row; text_hash is xxhash64 of the text, null for null."""
    d = pick(docs, "doc_id", "text").withColumn("text_hash", F.when(F.col("text").isNotNull(), F.xxhash64("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(t, words) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_hash"), pa.array(fps, pa.int64())],
                                             names=["doc_id", "text_hash", "fp"])

    kind = dict(d.dtypes)["doc_id"]
    return d.mapInArrow(run, f"doc_id {kind}, text_hash bigint, fp bigint")


def _parts(segments: int, radius: int) -> tuple[list[tuple], list[tuple]]:
    """(segment, shift, mask) of each part, and (segment, shift, mask, flip) of each probe."""
    cuts = [64 * i // segments for i in range(segments + 1)]
    parts = [(i, lo, (1 << (hi - lo)) - 1, hi - lo) for i, (lo, hi) in enumerate(zip(cuts, cuts[1:]))]
    probes = []
    for i, lo, mask, width in parts:
        for r in range(radius + 1):
            probes += [(i, lo, mask, sum(1 << x for x in c)) for c in combinations(range(width), r)]
    return [p[:3] for p in parts], probes


def _keys(fps: DataFrame, probes: list[tuple]) -> DataFrame:
    """One row per fingerprint and probe: (fp, seg, key)."""
    rows = F.array(*[F.struct(F.lit(s).alias("seg"), F.lit(sh).alias("sh"), F.lit(m).cast("long").alias("m"),
                              F.lit(x).cast("long").alias("x")) for s, sh, m, x in probes])
    return (fps.select("fp", F.inline(rows))
            .select("fp", "seg", F.expr("(shiftrightunsigned(fp, sh) & m) ^ x").alias("key")))


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a batch's links only a spanning forest goes on; that keeps every component."""
    for batch in batches:
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while (up := root.setdefault(x, x)) != x:
                root[x] = root[up]
                x = root[x]
            return x

        a, b = [], []
        for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            rx, ry = find(x), find(y)
            if rx != ry:
                root[max(rx, ry)] = min(rx, ry)
                a.append(x)
                b.append(y)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def links(fps: DataFrame, distance: int = DISTANCE, segments: int = 3) -> DataFrame:
    """(a, b) links between distinct fingerprints at most `distance` bits apart, a spanning
    forest of each task's links: components are exactly those of all links.

    A bucket is dealt over slots of about SLOT_ROWS table rows, probes go to each of its slots,
    so no task gets a whole hot bucket.  `segments` trades probes for false candidates: more
    data wants fewer, longer segments; any value gives the same links.
    """
    if not 1 <= segments <= 16 or distance < 0:
        raise ValueError("segments must be 1 to 16, distance 0 or more")
    parts, probes = _parts(segments, distance // segments)
    table = _keys(fps, [(*p, 0) for p in parts])
    sizes = table.groupBy("seg", "key").agg(F.count(F.lit(1)).alias("n"))
    slots = F.ceil(F.col("n") / F.lit(SLOT_ROWS)).cast("int")
    t = (table.join(sizes.where(f"n > {SLOT_ROWS}"), ["seg", "key"], "left")
         .select("seg", "key", F.coalesce(F.pmod(F.xxhash64("fp"), slots), F.lit(0)).cast("int").alias("slot"),
                 F.col("fp").alias("b")))
    p = (_keys(fps, probes).join(sizes, ["seg", "key"])
         .select("seg", "key", F.col("fp").alias("a"),
                 F.explode(F.sequence(F.lit(0), slots - 1)).alias("slot")))
    x = F.col("a").bitwiseXOR(F.col("b"))
    first = F.lit(True)  # a pair counts in the first segment that finds it
    for i, lo, mask in parts:
        near = F.bit_count(F.shiftrightunsigned(x, lo).bitwiseAND(F.lit(mask).cast("long"))) <= distance // segments
        first = first & ((F.col("seg") <= i) | ~near)
    found = p.join(t, ["seg", "key", "slot"]).where((F.col("a") < F.col("b")) & (F.bit_count(x) <= distance) & first)
    return found.select("a", "b").mapInArrow(_forest, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, words: int = WORDS, distance: int = DISTANCE, segments: int = 3) -> DataFrame:
    """One row per row of docs: doc_id, text_hash, fp (signed), component (smallest fingerprint
    reachable by links), component_id (smallest doc_id reachable, itself included).

    Null, empty and blank texts have fingerprint 0, which links like any other.  Repeated rows
    and copies share a fingerprint and so a component.  Null doc_ids are not counted for
    component_id (null only if the whole component has none).  Empty table: no rows.
    """
    f = written(fingerprints(docs, words), "simhash-fp")
    distinct = f.groupBy("fp").agg(F.min("doc_id").alias("low"))
    comp = connected_components(links(distinct.select("fp"), distance, segments))
    member = (distinct.join(comp.withColumnRenamed("node", "fp"), "fp", "left")
              .select("fp", "low", F.coalesce("component", "fp").alias("component")))
    ids = member.groupBy("component").agg(F.min("low").alias("component_id"))
    member = member.join(ids, "component").select("fp", "component", "component_id")
    return f.join(member, "fp").select("doc_id", "text_hash", "fp", "component", "component_id")


def keep_one(docs: DataFrame, words: int = WORDS, distance: int = DISTANCE, segments: int = 3) -> DataFrame:
    """The rows of docs, all columns, of one document per component: the smallest doc_id
    (null last), then the smallest text hash; of rows with equal doc_id and text one stays.

    Null, empty and blank texts are one group; other columns may have any name and decide nothing.
    An empty table gives no rows."""
    n = near_duplicates(docs, words, distance, segments)
    key = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.col("text_hash").alias("h"))
    keep = (n.groupBy("component").agg(F.min(key).alias("k"))
            .select(F.coalesce(F.col("k.d").cast("string"), F.lit("null")).alias("id"),
                    F.coalesce(F.col("k.h"), F.lit(0)).alias("hash")).distinct())
    rows, at = numbered(docs, "doc_id", "text")
    text = F.col(at["text"])
    marked = rows.withColumns({
        "id": F.coalesce(F.col(at["doc_id"]).cast("string"), F.lit("null")),
        "hash": F.coalesce(F.when(text.isNotNull(), F.xxhash64(text)), F.lit(0))})
    return restored(marked.join(keep, ["id", "hash"], "left_semi").dropDuplicates(["id", "hash"]), docs)
