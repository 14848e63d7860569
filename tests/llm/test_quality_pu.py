"""The positive-unlabelled classifier: features, prior, risk, held-out accuracy, what it may learn from."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postlytics.llm import quality_pu as Q
from llm_fixtures import SF01, make_docs  # noqa: F401

rng = np.random.default_rng(3)


def held():
    return F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 5 == 0


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aB1 \n\t.,#é中😀", max_size=60), st.integers(1, 7))
def test_features_do_not_depend_on_chunks(text, chunk):
    a, b = Q.features(text), Q.features(text, chunk)
    assert np.allclose(np.delete(a, -1), np.delete(b, -1)) and abs(a[-1] - b[-1]) < 0.01 and np.isfinite(a).all()


def test_features_of_small_texts():
    assert np.array_equal(Q.features(None), Q.features("")) and len(Q.features("")) == Q.FEATURES
    x = Q.features("go go go\ngo go go\n\nno")
    stats = x[Q.CLASSES ** 2:]
    assert np.allclose(stats[:3], np.log1p([21, 7, 3])) and np.isclose(stats[3], 0.2) and np.isclose(stats[4], 5 / 7) and np.isclose(stats[5], 1 / 3)


@pytest.mark.parametrize("share", [0.15, 0.5, 0.9])
def test_prior_of_a_known_mixture(share):
    good, mixed = rng.normal(2, 1, 20_000), np.concatenate([rng.normal(2, 1, int(20_000 * share)), rng.normal(-2, 1, int(20_000 * (1 - share)))])
    edges = np.linspace(-8, 8, 200)
    counts = [np.histogram(z, edges)[0][::-1] for z in (good, mixed)]
    assert abs(Q.prior_of_counts(*counts) - share) < 0.05


def test_risk_is_lower_than_at_other_weights():
    """The fit against the stated risk, written plainly, at random weights around it."""
    n = 6000
    pos, neg = rng.normal(0.08, 1, (n, Q.FEATURES)), rng.normal(-0.08, 1, (n, Q.FEATURES))
    unl = np.concatenate([rng.normal(0.08, 1, (n // 2, Q.FEATURES)), neg[:n // 2]])
    m = Q._fit(pos, unl, 0.5)

    def risk(w):
        z = [np.clip((x - m.mean) / m.scale, -10, 10) @ w[:-1] + w[-1] for x in (pos, unl)]
        loss = lambda v: np.logaddexp(0, -v).mean()
        return 0.5 * loss(z[0]) + max(0.0, loss(-z[1]) - 0.5 * loss(-z[0])) + Q.PENALTY / 2 * (w[:-1] ** 2).sum()

    best = risk(m.weights)
    assert all(best < risk(m.weights + rng.normal(0, 0.05, len(m.weights))) for _ in range(50))
    assert best < 0.8 * risk(np.zeros_like(m.weights))


@pytest.fixture(scope="module")
def whole(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    return docs, labels, {r.doc_id: r for r in Q.classify(docs, labels, held()).collect()}


def test_held_out_accuracy(whole):
    docs, labels, got = whole
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= Q.GOOD) for r in got.values())
    rows = [(got[r.doc_id], r.quality) for r in labels.collect() if got[r.doc_id].held_out]
    good, bad = [r.score for r, q in rows if q == 1], [r.score for r, q in rows if q == 0]
    assert np.mean([[g > b for b in bad] for g in good]) > 0.97
    assert np.mean([r.predicted == q for r, q in rows]) > 0.95 and np.mean([r.predicted for r, q in rows if q == 1]) > 0.97


def test_learns_from_trusted_positives_of_rows_not_held_out_alone(spark, whole):
    """Labels of held-out rows and labels that say bad change nothing; nor do lang, source, order and clashing columns."""
    docs, labels, got = whole
    other = labels.withColumn("quality", F.when(held(), 1 - F.col("quality")).otherwise(F.col("quality"))) \
        .where(held() | (F.col("quality") == 1)).withColumn("x", F.lit(1)).repartition(3)
    docs = docs.withColumns({"lang": F.lit("x"), "source": F.lit("y")}).repartition(5)
    docs = docs.select("*", *[F.lit("z").alias(c) for c in ("x", "DOC_ID", "score", "held_out", "predicted", "quality")])
    again = Q.classify(docs, other, held()).collect()
    assert max(abs(r.score - got[r.doc_id].score) for r in again) < 1e-9


def test_labels_that_disagree_or_are_null_are_not_trusted(spark):
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (2, 0), (3, None), (4, 0), (None, 1), (5, None), (5, 1)], "doc_id long, quality int")
    assert sorted(r.doc_id for r in Q.trusted(labels).collect()) == [1, 5]


def test_odd_rows_and_empty_tables(spark, make_docs):
    labels = spark.createDataFrame([(i, 1) for i in range(20)], "doc_id long, quality int")
    rows = [None, "", "  ", "x", "word " * 300_000, "same text", "same text", "1 2 3", "\n\n", "###"] + [f"A plain text, number {i}.\nIt ends." for i in range(30)]
    rows = [(i, t) for i, t in enumerate(rows)] + [(None, "no id"), (7, "1 2 3")]
    got = Q.classify(make_docs(rows, extra=True, partitions=3), labels, held()).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r.score for r in got}
    assert by[0] == by[1] and by[5] == by[6] and len({r.score for r in got if r.doc_id == 7}) == 1
    assert not next(r for r in got if r.doc_id is None).held_out
    for docs, labs in ((make_docs([]), labels), (make_docs(rows), labels.limit(0))):
        out = Q.classify(docs, labs, held()).collect()
        assert all(r.score == 0.5 and r.predicted == 1 for r in out) and len(out) in (0, len(rows))
