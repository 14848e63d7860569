"""Quality classifier by positive-unlabelled learning.

Trusted good texts are the positives, web text at large is unlabelled; no text is taken as a
negative.  The share of good texts among the unlabelled (the class prior) is estimated first: a
preliminary model of positives against unlabelled orders all texts, and where a threshold keeps a
share p of the positives and a share u of the unlabelled, u / p bounds the prior from above; the
threshold with the lowest confidence bound is taken.  Then a logistic model minimises the
non-negative unbiased risk

    prior * E_pos[loss(f)] + max(0, E_unl[loss(-f)] - prior * E_pos[loss(-f)])

whose second part is the risk on negatives; where it falls below zero, which only over-fitting
can do, steps go back up.

Texts become class pair frequencies of neighbouring characters and a few statistics, all sums
over the whole text, written once.  Spark counts the threshold histogram over all of them; only a
bounded draw of feature rows is fitted on.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlytics.llm.common import chunks, pick, worker_cache, written

#: Feature rows fitted on: an expected number each of positives and of unlabelled texts.
TRAIN_ROWS = 20_000
#: Steps of the fit, weight penalty, and bins of the threshold histogram.
STEPS, PENALTY, BINS = 400, 1e-3, 512
#: A text is called good from this score on.
GOOD = 0.3
#: Character classes: new line, other space, lower case, upper case, other letter, digit, and the
#: punctuation of sentences, of clauses, of symbols, and any other.
NAMED = ["\n", " \t\r\v\f", "", "", "", "0123456789", ".!?", ",;:'\"()-", "#*$%&|<>@^~_=+\\/{}[]"]
CLASSES, CHUNK = len(NAMED) + 1, 1 << 20
FEATURES = CLASSES * CLASSES + 7


# ------------------------------------------------------------------ features


def _class_table() -> np.ndarray:
    """The class of each character of the basic plane; the rest counts as other letters."""
    cache = worker_cache()
    if "classes" not in cache:
        t = np.full(1 << 16, len(NAMED), dtype=np.uint8)
        for i in range(1 << 16):
            c = chr(i)
            if c.isspace():
                t[i] = 1
            elif c.isalpha():
                t[i] = 2 if c.islower() else 3 if c.isupper() else 4
            elif c.isdigit():
                t[i] = 5
        for k, named in enumerate(NAMED):
            for c in named:
                t[ord(c)] = k
        cache["classes"] = t
    return cache["classes"]


def features(text: str | None, chunk: int = CHUNK) -> np.ndarray:
    """FEATURES numbers of a text: roots of the frequencies of class pairs, log counts of
    characters, words and lines, word length, share of words that repeat the word before, share
    of repeated lines, compressed share.

    Null is as empty.  A long text is read in chunks, what crosses a cut included.
    """
    text, table = text or "", _class_table()
    pairs = np.zeros(CLASSES * CLASSES)
    packer, packed = zlib.compressobj(1), 0
    words = twice = chars = size = 0
    before, word = np.zeros(1, dtype=np.uint8), None  # a text begins after a new line
    for part in chunks(text, chunk):
        code = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), "<u4")
        kind = np.concatenate([before, np.where(code < 1 << 16, table[code & 0xFFFF], 4).astype(np.uint8)])
        pairs += np.bincount(kind[:-1].astype(np.intp) * CLASSES + kind[1:], minlength=CLASSES * CLASSES)
        for w in part.split():
            words += 1
            twice += w == word
            word = w
        chars += int((kind[1:] >= 2).sum())
        before = kind[-1:]
        raw = part.encode("utf-8", "surrogatepass")
        size += len(raw)
        packed += len(packer.compress(raw))
    packed += len(packer.flush())
    lines = [x for x in text.split("\n") if x.strip()]
    again = len(lines) - len(set(lines))
    stats = [math.log1p(len(text)), math.log1p(words), math.log1p(len(lines)), chars / max(words, 1) / 10, twice / max(words, 1),
             again / max(len(lines), 1), min(packed / max(size, 1), 2.0)]
    return np.concatenate([np.sqrt(pairs / max(len(text), 1)), stats]).astype(np.float32)


def _featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [features(t).tobytes() for t in b.column("text").to_pylist()]
        keep = [c for c in b.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([*map(b.column, keep), pa.array(rows, pa.binary())], names=[*keep, "x"])


def _matrix(rows) -> np.ndarray:
    return np.frombuffer(b"".join(rows), dtype=np.float32).reshape(-1, FEATURES).astype(np.float64)


# ------------------------------------------------------------------ the model


@dataclass
class Model:
    """A logistic model of standardised features; weights end with the constant."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -10, 10) @ self.weights[:-1] + self.weights[-1]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.logits(x))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _fit(pos: np.ndarray, unl: np.ndarray, prior: float | None) -> Model:
    """Weights by Adam on all rows.  With a prior: the non-negative risk.  Without: positives
    against unlabelled as if those were negatives, each side half."""
    mean, scale = unl.mean(0), unl.std(0) + 1e-3

    def unit(x):
        return np.column_stack([np.clip((x - mean) / scale, -10, 10), np.ones(len(x))])

    p, u = unit(pos), unit(unl)
    w, m, v = np.zeros(p.shape[1]), np.zeros(p.shape[1]), np.zeros(p.shape[1])
    for step in range(1, STEPS + 1):
        sp, su = sigmoid(p @ w), sigmoid(u @ w)
        pull_p = p.T @ (sp - 1) / len(p)                 # gradient of the positives' loss as good
        if prior is None:
            g = (pull_p + u.T @ su / len(u)) / 2
        else:
            bad_p, bad_u = p.T @ sp / len(p), u.T @ su / len(u)  # and of the losses as bad
            risk = -np.log1p(-np.minimum(su, 1 - 1e-15)).mean() + prior * np.log1p(-np.minimum(sp, 1 - 1e-15)).mean()
            g = prior * pull_p + (bad_u - prior * bad_p) if risk >= 0 else -(bad_u - prior * bad_p)
        g = g + PENALTY * np.append(w[:-1], 0.0)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w = w - 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return Model(mean, scale, w, prior if prior is not None else 0.5)


def prior_of_counts(pos: np.ndarray, unl: np.ndarray, sure: float = 0.1) -> float:
    """The class prior from counts of positives and unlabelled in bins of falling preliminary score.

    Each threshold gives the bound u / p; taken is the bound of the threshold at which u / p and
    its uncertainty (Dvoretzky-Kiefer-Wolfowitz, at level `sure`) are lowest together.
    """
    n, m = pos.sum(), unl.sum()
    if not n or not m:
        return 0.5
    p, u = np.cumsum(pos) / n, np.cumsum(unl) / m
    slack = math.sqrt(math.log(4 / sure) / 2) * (1 / math.sqrt(n) + 1 / math.sqrt(m))
    some = p > 0
    at = int(np.argmin((u[some] + slack) / p[some]))
    return float(np.clip(u[some][at] / p[some][at], 0.01, 0.99))


def _draw(rows: DataFrame, n_rows: int, limit: int) -> DataFrame:
    """Distinct feature rows, some `limit` at most, drawn by their own hash."""
    grain = 1 << 20
    rate = min(grain, int(limit / max(n_rows, 1) * grain) + 1)
    return rows.select("x").where(F.pmod(F.xxhash64(F.lit(7), "x"), F.lit(grain)) < rate).dropDuplicates(["x"])


def _histogram(rows: DataFrame, model: Model) -> np.ndarray:
    """How many of all rows fall in each of BINS bins of falling score, by the logit."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BINS, dtype=np.int64)
        for b in batches:
            z = np.clip(model.logits(_matrix(b.column("x").to_pylist())), -12, 12)
            total += np.bincount(((12 - z) / 24 * (BINS - 1)).astype(int), minlength=BINS)
        yield pa.RecordBatch.from_arrays([pa.array(range(BINS), pa.int32()), pa.array(total)], names=["bin", "n"])

    out = np.zeros(BINS)
    for r in rows.select("x").mapInArrow(run, "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect():
        out[r.bin] = r.n  # BINS rows
    return out


def fit(unlabelled: DataFrame, positives: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """A model of feature rows (column x).

    Rows are halved by hash.  The preliminary model is drawn from one half, the prior's counts
    are those of all rows of the other, and the final model is drawn from both.  At most about
    `train_rows` distinct rows of each kind are fitted on.  Without a positive, or without
    unlabelled rows, there is nothing to learn: every text scores 0.5.
    """
    half = F.pmod(F.xxhash64("x"), F.lit(2)) == 0
    n_pos, n_unl = positives.count(), unlabelled.count()
    drawn = [_draw(r, n, train_rows).withColumn("first", half).toPandas() for r, n in ((positives, n_pos), (unlabelled, n_unl))]
    blank = Model(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES + 1), 0.5)
    if any(d.empty for d in drawn):
        return blank
    drawn = [d.sort_values("x", kind="stable") for d in drawn]  # the same model in any order of rows
    halves = [_matrix(d.x[d["first"]]) for d in drawn]
    prior = 0.5
    if all(len(h) for h in halves):
        rough = _fit(*halves, None)
        prior = prior_of_counts(_histogram(positives.where(~half), rough), _histogram(unlabelled.where(~half), rough))
    return _fit(*[_matrix(d.x) for d in drawn], prior)


def _scorer(model: Model, good: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = model.scores(_matrix(b.column("x").to_pylist()))
            keep = [c for c in b.schema.names if c != "x"]
            yield pa.RecordBatch.from_arrays([*map(b.column, keep), pa.array(s), pa.array((s >= good).astype(np.int32))],
                                             names=[*keep, "score", "predicted"])
    return run


def trusted(labels: DataFrame) -> DataFrame:
    """The doc_ids whose labels all say good (quality 1; null labels say nothing)."""
    return (pick(labels, "doc_id", "quality").where("doc_id is not null and quality is not null")
            .groupBy("doc_id").agg(F.min("quality").alias("low")).where("low = 1").select("doc_id"))


def classify(docs: DataFrame, labels: DataFrame, held_out: Column, train_rows: int = TRAIN_ROWS,
             good: float = GOOD) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (1 from `good` on) per row of docs.

    `held_out` is a condition on doc_id; rows for which it is true are scored and never learnt
    from.  Positives are the rows with trusted labels, unlabelled are all the others and they
    too.  The score depends on the text alone: null and empty texts are scored alike, repeated
    rows too.  An empty table of documents gives no rows, one of labels a score of 0.5.
    """
    d = pick(docs, "doc_id", "text").withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    kind = dict(d.dtypes)["doc_id"]
    rows = written(d.mapInArrow(_featurize, f"doc_id {kind}, held_out boolean, x binary"), "pu-features")
    learn = rows.where("not held_out")
    model = fit(learn, learn.join(trusted(labels), "doc_id", "left_semi"), train_rows)
    return rows.mapInArrow(_scorer(model, good), f"doc_id {kind}, held_out boolean, score double, predicted int")
