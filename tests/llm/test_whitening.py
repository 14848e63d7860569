"""Whitening against numpy's eigenvalues, the counts against plain ones, and odd rows."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postlytics.llm import whitening as W
from llm_fixtures import EXTRA, SF01

rng = np.random.default_rng(5)


def symmetric(values):
    q, _ = np.linalg.qr(rng.normal(size=(len(values), len(values))))
    return (q * np.array(values)) @ q.T


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from([-3.0, -1.0, -1e-3, 1e-3, 0.5, 2.0, 2.0, 7.0]), min_size=1, max_size=12), st.booleans())
def test_counts_of_positive_eigenvalues(values, zero_diagonal):
    a = symmetric(values)
    if zero_diagonal:  # every pivot on the diagonal would be zero
        a = a - np.diag(np.diag(a))
        e = np.linalg.eigvalsh(a)
        if np.abs(e).min() < 1e-9:
            return
        values = e
    assert W.positive_pivots(a) == sum(v > 0 for v in values)


@pytest.mark.parametrize("values", [[9, 4, 2, 1, 0.5], [1] * 6, [5, 5, 5, 1, 0, 0], [1e6, 1, 1 - 1e-9, 1e-6, 1e-7], [3, 3 - 1e-13, 1, 0.2]])
def test_eigenpairs(values):
    v = symmetric(values)
    v = (v + v.T) / 2
    got, vec = W.leading_eigenpairs(v, 4)
    want = sorted((x for x in values if x > 1e-12), reverse=True)[:4]
    assert np.allclose(got, want, rtol=1e-9, atol=1e-9 * max(values)) and vec.shape == (len(values), len(want))
    assert np.allclose(vec.T @ vec, np.eye(len(want)), atol=1e-10)
    assert np.abs(v @ vec - vec * got).max() <= 1e-12 * max(values)


def test_no_components():
    for v in (np.zeros((3, 3)), np.zeros((0, 0))):
        assert len(W.leading_eigenpairs(v, 4)[0]) == 0


def expected(rows, k=4):
    """(vec_id, x) rows: n, deviations, whitened up to sign, explained, all with numpy in memory."""
    x = np.array([r[1] for r in rows], dtype=np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    y = fit - s / n
    cov = y.T @ y / n
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1], v[:, ::-1]
    k = min(k, int((e > 1e-9 * e[0]).sum())) if e[0] > 0 else 0
    z = (x - s / n) @ v[:, :k] / np.sqrt(e[:k])
    dev = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(r, s)) for r in x]
    return n, dev, z, e[:k] / np.trace(cov)


def compare(got, rows, k=4):
    n, dev, z, share = expected(rows, k)
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {})[r.component] = r
    assert set(by) == {i for i, _ in rows} and all(set(c) == set(range(1, len(share) + 1)) for c in by.values())
    for j in range(len(share)):
        w = np.array([by[i][j + 1].whitened for i, _ in rows])
        sign = 1 if w @ z[:, j] > 0 else -1
        assert np.allclose(w * sign, z[:, j], rtol=1e-7, atol=1e-7)
    for (i, _), d in zip(rows, dev):
        for j, r in by[i].items():
            assert r.n == n and r.deviation == d and abs(r.explained / share[j - 1] - 1) < 1e-9 and r.identity_error < 1e-9


def test_whole_table(spark):
    df = spark.read.parquet(f"{SF01}/embeddings.parquet")
    rows = [(r.vec_id, np.floor(256 * np.array(r.embedding, dtype=np.float64)).astype(np.int64)) for r in df.collect()]
    compare(W.whiten(df).collect(), rows)


def table(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")


def test_odd_rows_copies_and_clashing_names(spark):
    base = [[float(v) for v in r] for r in rng.normal(size=(30, 5))]
    rows = [(i, r) for i, r in enumerate(base)]
    copies = [(100 + i, base[3]) for i in range(40)]
    odd = [(200, None), (201, []), (202, [1.0, None, 2.0, 3.0, 4.0]), (203, [float("nan")] * 5),
           (204, [1.0, 2.0, 3.0, float("inf"), 0.0]), (205, [1.0, 2.0]), (206, [1.0] * 6)]
    df = table(spark, rows + copies + odd, "double").repartition(3)
    df = df.select("*", *[F.lit("x").alias(c) for c in [*EXTRA, "x", "n", "VEC_ID"]])
    ints = [(i, np.floor(256 * np.array(r)).astype(np.int64)) for i, r in rows + copies]
    compare(W.whiten(df).collect(), ints)
    compare(W.whiten(df, components=9).collect(), ints, 9)


def test_null_and_repeated_ids(spark):
    df = table(spark, [(None, [0.1, 0.2]), (1, [0.5, -0.2]), (1, [0.5, -0.2]), (1, [0.9, 0.7])])
    got = W.whiten(df).collect()
    assert sorted((r.vec_id is None, r.component) for r in got) == [(False, 1)] * 3 + [(False, 2)] * 3 + [(True, 1), (True, 2)]
    assert {r.n for r in got} == {3}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.5, 0.5]), (2, [0.5, 0.5])]])
def test_tables_without_spread_give_no_rows(spark, rows):
    got = W.whiten(table(spark, rows))
    assert got.count() == 0 and got.columns[0] == "vec_id"


def test_large_entries(spark):
    """Deviations beyond a long are null, the rest is still right."""
    rows = [(i, [1e6 * i, -3e5 * i * i]) for i in range(1, 9)]
    got = W.whiten(table(spark, rows, "double")).collect()
    assert all(r.identity_error < 1e-9 for r in got)
    n, dev, _, _ = expected([(i, [256 * int(a) for a in r]) for i, r in rows])
    want = {i: d if d < 2**63 else None for (i, _), d in zip(rows, dev)}
    assert None in want.values() or max(dev) < 2**63
    assert all(r.deviation == want[r.vec_id] for r in got)
    huge = W.whiten(table(spark, [(1, [1e300, 1.0]), (2, [-1e300, 2.0]), (3, [0.0, 0.5])], "double")).collect()
    assert {r.vec_id for r in huge} == {1, 2, 3}
