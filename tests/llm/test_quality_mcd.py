"""Quality rules: base statistics against plain Python, estimates against numpy."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np

from postlytics.llm import quality_mcd as Q
from llm_fixtures import SF001, make_docs  # noqa: F401


def stats(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = Counter(zip(w, w[1:], w[2:]))
    hit = {k for i, g in enumerate(zip(w, w[1:], w[2:])) if grams[g] > 1 for k in (i, i + 1, i + 2)}
    s = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit))
    return (*s, s[0] < 50 or 100 * s[4] > 50 * s[0])


def vec(s):
    n = max(s[0], 1)
    return [math.log1p(s[0]), s[1] / n, math.sqrt(s[2] / n), math.sqrt(20 * s[3] / n), s[4] / n]


def bins(x):
    return np.floor(np.log1p(x) * Q.BINS)


def quantile_bin(x, p):
    x = np.sort(bins(np.asarray(x)))
    return x[max(0, math.ceil(p * len(x)) - 1)]


def quantile(x, p):
    return math.expm1((quantile_bin(x, p) + 0.5) / Q.BINS)


def root(cov):
    low, floor = np.zeros((5, 5)), list(Q.FLOORS.values())
    for i in range(5):
        for j in range(i + 1):
            rest = cov[i, j] - low[i, :j] @ low[j, :j]
            low[i, j] = math.sqrt(max(rest, floor[i] ** 2 / 100)) if i == j else rest / low[j, j]
    return low


def distances(x, mean, cov):
    z = np.linalg.solve(root(cov), (x - mean).T)
    return (z * z).sum(0)


def first_covariances(x, mid, scale):
    z = (x - mid) / scale
    t = np.cov(np.tanh(z).T, bias=True).reshape(5, 5)
    sd = np.sqrt(np.diag(t))
    both = np.outer(sd, sd)
    r = np.where(both > 0, t / np.where(both > 0, both, 1), 0)
    np.fill_diagonal(r, 1)
    norm = np.sqrt((z * z).sum(1, keepdims=True))
    u = np.where(norm > 0, z / np.where(norm > 0, norm, 1), 0)
    return [c * np.outer(scale, scale) for c in (np.eye(5), r, 5 * (u.T @ u) / len(u))]


def estimate(x):
    """(mean, covariance, scale) of the start with the smallest determinant."""
    floor = np.array(list(Q.FLOORS.values())) ** 2
    q = np.array([[quantile(x[:, k], p) for k in range(5)] for p in (.25, .5, .75)])
    ends = []
    for cov in first_covariances(x, q[1], np.sqrt(((q[2] - q[0]) / 1.349) ** 2 + floor)):
        mean = q[1]
        for _ in range(Q.STEPS):
            d = distances(x, mean, cov)
            near = x[bins(d) <= quantile_bin(d, Q.SHARE)]
            mean, cov = near.mean(0), np.cov(near.T, bias=True).reshape(5, 5) + np.diag(floor)
        ends.append((np.log(np.diag(root(cov))).sum(), mean, cov))
    _, mean, cov = min(ends, key=lambda e: e[0])
    return mean, cov, max(1.0, quantile(distances(x, mean, cov), .5) / Q.CHI2_MEDIAN)


def towards(n, own, above):
    w = n * n / (n * n + Q.PRIOR ** 2)
    return [w * a + (1 - w) * b for a, b in zip(own, above)]


def expected(rows):
    """rows: (doc_id, text, lang, source)."""
    s = [stats(t) for _, t, _, _ in rows]
    groups = defaultdict(list)
    for (_, _, lang, src), x in zip(rows, s):
        if not x[5]:
            for key in ((lang, src), (lang,), "*"):
                groups[key].append(vec(x))
    fits = {k: estimate(np.array(v)) for k, v in groups.items()}
    for size in (1, 2):  # languages first, then groups towards them
        for k in fits:
            if k != "*" and len(k) == size:
                fits[k] = towards(len(groups[k]), fits[k], fits[k[:1] if size == 2 else "*"])
    out = []
    for (i, _, lang, src), x in zip(rows, s):
        far = None
        if not x[5]:
            mean, cov, scale = fits[lang, src]
            far = math.sqrt(distances(np.array([vec(x)]), mean, cov)[0] / scale)
        out.append((i, *x, far, far is not None and far <= Q.CUTOFF))
    return out


def compare(df, rows):
    got = sorted(map(tuple, df.collect()), key=lambda r: repr(r[:6]))
    want = sorted(expected(rows), key=lambda r: repr(r[:6]))
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:7] == w[:7]
        assert (g[7] is None) == (w[7] is None) and (g[7] is None or abs(g[7] - w[7]) < 1e-6 * max(1, w[7]))
        assert w[7] is not None and abs(w[7] - Q.CUTOFF) < 1e-6 or g[8] == w[8]


def prose(rnd, n):
    return " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randrange(1, 9))) for _ in range(n))


def corpus():
    rnd = random.Random(2)
    rows = [(i, prose(rnd, rnd.randrange(60, 200)), rnd.choice(["en", "de"]), rnd.choice(["a", "b"])) for i in range(300)]
    rows += [(400, " | ".join(prose(rnd, 1) for _ in range(120)), "en", "a"), (401, "### " * 100 + prose(rnd, 60), "en", "a"),
             (402, None, "en", "a"), (403, "", None, None), (404, " \n\t", "en", None), (405, prose(rnd, 80), None, None),
             (406, "a b c " * 40, "en", "a"), (407, "one line here\n" * 3 + prose(rnd, 100), "en", "b"), (None, prose(rnd, 70), "fr", "a"),
             (409, "x" * 20000 + " " + prose(rnd, 60), "en", "a"), (410, prose(rnd, 3000), "en", "a")]
    return rows + [rows[0], rows[-1]]


def test_matches_numpy(make_docs):
    rows = corpus()
    compare(Q.quality(make_docs(rows, extra=True, partitions=3)), rows)


def test_symbol_junk_goes_and_prose_stays(make_docs):
    rows = corpus()
    kept = {r.doc_id for r in Q.quality(make_docs(rows)).where("kept").collect()}
    assert not kept & {400, 401, 402, 403, 404, 406} and kept >= set(range(300)) | {410}


def test_small_table(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    compare(Q.quality(docs), [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()])


def test_a_growing_group_moves_without_a_jump(make_docs):
    """One document of a style of its own, in a group of 1 to 60: its distance has no step."""
    rnd = random.Random(5)
    base = [(i, prose(rnd, rnd.randrange(60, 200)), "en", "a") for i in range(200)]
    own = [(1000 + i, prose(rnd, 100) + " #" * 4, "en", "b") for i in range(60)]
    far = []
    for n in (46, 48, 50, 52, 54):
        far.append(Q.quality(make_docs(base + own[:n])).where("doc_id = 1000").first().mcd_distance)
    assert max(abs(a - b) for a, b in zip(far, far[1:])) < 0.1 * max(far)


def test_a_shifted_fifth_does_not_carry_the_estimate(make_docs):
    """A fifth of a group is junk of one kind: all of it goes, all prose stays."""
    rnd = random.Random(6)
    good = [(i, prose(rnd, rnd.randrange(60, 200)), "en", "a") for i in range(240)]
    junk = [(1000 + i, " | # ".join(prose(rnd, 1) for _ in range(rnd.randrange(60, 90))), "en", "a") for i in range(60)]
    kept = {r.doc_id for r in Q.quality(make_docs(good + junk)).where("kept").collect()}
    assert kept == set(range(240))


def test_keep_good_is_the_same_verdict_and_keeps_columns(make_docs):
    rows = corpus()
    docs = make_docs(rows, extra=True)
    good = Q.keep_good(docs)
    assert good.columns == docs.columns
    want = sorted([r[0] for r in expected(rows) if r[8]], key=repr)
    assert sorted([r.doc_id for r in good.collect()], key=repr) == want


def test_empty_table(make_docs):
    assert Q.quality(make_docs([])).count() == 0
    assert Q.keep_good(make_docs([])).count() == 0
