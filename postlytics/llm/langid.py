"""Language identification by nearest centroid.

Texts become normalised TF-IDF vectors of hashed byte n-grams.  The vectors of each language
are clustered (spherical k-means) into a few centroids; a text gets the language of the centroid
with the largest cosine, and is marked as rejected where that cosine is below what the
centroid's own members reach.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlytics.llm.common import chunks, pick, written

UNKNOWN = "und"
#: Hash dimensions, n-gram lengths in bytes, centroids of a language.
DIM, GRAMS, CLUSTERS = 1 << 14, (2, 3, 4), 4
#: Training texts of a language: an expected number, drawn by hash of the text.
PER_LANGUAGE = 1200
#: Languages a model may hold; more labels than this are taken for an error in the label column.
MAX_LANGUAGES = 1000
#: A text is rejected below this share of the lowest cosine among a centroid's members.
REJECT = 0.5
OTHER = re.compile(r"[\W\d_]+")


def has_letter(text: str | None) -> bool:
    """Whether a character is a letter; number signs such as a half or a raised two are none."""
    return any(map(str.isalpha, text or ""))


def term_counts(text: str, chunk: int = 1 << 20) -> np.ndarray:
    """Counts of hashed n-grams of the lower-cased letters; other characters are one space.

    A long text is read in chunks; the last bytes before a cut go on into the next, so the counts
    are those of the whole text."""
    out = np.zeros(DIM, dtype=np.float32)
    tail = b" "
    for part in chain(chunks(text, chunk), [" "]):
        s = OTHER.sub(" ", part.lower()).encode("utf-8", "ignore")
        if tail.endswith(b" ") and s.startswith(b" "):
            s = s[1:]
        whole = np.frombuffer(tail + s, np.uint8).astype(np.uint32)
        for n in GRAMS:
            b = whole[max(len(tail) - n + 1, 0):]  # n-grams that end in this chunk
            if len(b) < n:
                continue
            h = np.full(len(b) - n + 1, n * 2654435761 % (1 << 32), dtype=np.uint32)
            for k in range(n):
                h = (h ^ b[k:len(b) - n + 1 + k]) * np.uint32(2246822519)
                h ^= h >> np.uint32(15)
            out += np.bincount(h % np.uint32(DIM), minlength=DIM)
        tail = (tail + s)[1 - max(GRAMS):]
    return out


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of length one (or zero) of log counts times inverse document frequency."""
    x = np.log1p(counts) * idf
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm > 0, norm, 1)


def cluster(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """At most k centroids of length one: spherical k-means, started from the mean's nearest row
    and then always the row furthest from the centroids so far."""
    first = int(np.argmax(x @ x.mean(0)))
    c = x[[first]]
    while len(c) < min(k, len(x)):
        near = (x @ c.T).max(1)
        if near.min() > 1 - 1e-6:
            break
        c = np.vstack([c, x[int(np.argmin(near))]])
    for _ in range(rounds):
        own = (x @ c.T).argmax(1)
        new = np.vstack([x[own == i].sum(0) if (own == i).any() else c[i] for i in range(len(c))])
        new /= np.maximum(np.linalg.norm(new, axis=1, keepdims=True), 1e-12)
        if np.allclose(new, c, atol=1e-6):
            break
        c = new
    return c


@dataclass
class Model:
    """Centroids (one a row), the language and lowest member cosine of each, and the idf vector."""

    languages: list[str]
    centroids: np.ndarray
    lowest: np.ndarray
    idf: np.ndarray


def _featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        langs, idx, val = [], [], []
        for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
            if has_letter(text):
                c = term_counts(text)
                at = np.flatnonzero(c)
                langs.append(lang)
                idx.append(at.astype(np.int32))
                val.append(c[at])
        yield pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(idx, pa.list_(pa.int32())), pa.array(val, pa.list_(pa.float32()))],
            names=["lang", "idx", "val"])


def _clusters(idf: np.ndarray, k: int):
    def run(g: pd.DataFrame) -> pd.DataFrame:
        x = np.zeros((len(g), DIM), dtype=np.float32)
        order = sorted(range(len(g)), key=lambda i: (len(g.idx[i]), g.val[i].tobytes(), g.idx[i].tobytes()))
        for r, i in enumerate(order):  # the same model in whatever order the rows come
            x[r, g.idx[i]] = g.val[i]
        x = vectors(x, idf).astype(np.float32)
        c = cluster(x, k)
        near = x @ c.T
        own = near.argmax(1)
        lowest = [float(near[own == i, i].min()) if (own == i).any() else 0.0 for i in range(len(c))]
        return pd.DataFrame({"lang": g.lang.iloc[0], "centroid": [r.astype("<f4").tobytes() for r in c], "lowest": lowest})
    return run


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, clusters: int = CLUSTERS) -> Model:
    """A model of the rows (text, lang) with a lang and a letter.

    Learns from about `per_language` distinct texts of each language (all, if there are fewer),
    drawn by the text alone; of copies with one lang one is learnt from.  Document frequencies are sums over the drawn texts.  No labelled
    row: a model without languages.
    """
    d = pick(docs, "text", "lang").where("lang is not null and text is not null")
    sizes = d.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} different labels")
    if not sizes:
        return Model([], np.zeros((0, DIM), np.float32), np.zeros(0), np.ones(DIM, np.float32))
    grain = 1 << 20
    rate = F.create_map(*[x for r in sizes for x in (F.lit(r["lang"]), F.lit(min(grain, int(per_language / r["count"] * grain) + 1)))])
    drawn = d.where(F.pmod(F.xxhash64("text"), F.lit(grain)) < F.element_at(rate, F.col("lang")))
    drawn = drawn.dropDuplicates(["lang", "text"])
    feats = written(drawn.select("lang", "text").mapInArrow(_featurize, "lang string, idx array<int>, val array<float>"), "langid-terms")
    n = feats.count()
    df = np.zeros(DIM, dtype=np.float32)
    for r in feats.select(F.explode("idx").alias("i")).groupBy("i").count().collect():  # at most DIM rows
        df[r.i] = r["count"]
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)
    rows = (feats.groupBy("lang").applyInPandas(_clusters(idf, clusters), "lang string, centroid binary, lowest double")
            .collect())  # clusters rows a language
    rows.sort(key=lambda r: (r.lang, bytes(r.centroid)))
    c = np.vstack([np.frombuffer(bytes(r.centroid), "<f4") for r in rows]) if rows else np.zeros((0, DIM), np.float32)
    return Model([r.lang for r in rows], c, np.array([r.lowest for r in rows]), idf)


def _predictor(model, reject: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*model.value)
        for b in batches:
            texts = b.column("text").to_pylist()
            best, score, far = [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
            known = [i for i, t in enumerate(texts) if len(m.centroids) and has_letter(t)]
            for k in range(0, len(known), 128):
                part = known[k:k + 128]
                near = vectors(np.stack([term_counts(texts[i]) for i in part]), m.idf) @ m.centroids.T
                own = near.argmax(1)
                for i, j, s in zip(part, own.tolist(), near[np.arange(len(part)), own].tolist()):
                    best[i], score[i], far[i] = m.languages[j], min(1.0, max(0.0, s)), s < reject * m.lowest[j]
            keep = [c for c in b.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*map(b.column, keep), pa.array(best, pa.string()), pa.array(score, pa.float64()), pa.array(far, pa.bool_())],
                names=[*keep, "lang_pred", "score", "rejected"])
    return run


def predict(docs: DataFrame, model: Model, reject: float = REJECT) -> DataFrame:
    """doc_id, lang_pred, score (cosine, 0 to 1), rejected per row of docs; the text alone counts.

    Null texts and texts without a letter, and all texts if the model has no language, give
    'und', 0 and rejected.  A rejected text keeps its nearest language, so a caller may choose;
    ties go to the first language in text order.  Repeated rows are judged alike.
    """
    d = pick(docs, "doc_id", "text")
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.centroids, model.lowest, model.idf))  # DIM numbers a centroid, MAX_LANGUAGES bound them
    return d.mapInArrow(_predictor(shared, reject), f"doc_id {dict(d.dtypes)['doc_id']}, lang_pred string, score double, rejected boolean")
