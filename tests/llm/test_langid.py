"""Language identification: held-out accuracy, rejection, odd rows."""

import numpy as np

from postlytics.llm import langid, queries
from llm_fixtures import SF01, make_docs  # noqa: F401


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    got = queries.op1_language_id(spark, SF01).join(docs.select("doc_id", "lang", "text"), "doc_id")
    rows = [r for r in got.collect() if r.held_out and langid.has_letter(r.text) and len(r.text) >= 40]
    assert len(rows) > 200
    assert sum(r.lang_pred == r.lang for r in rows) / len(rows) > 0.97


def test_odd_rows(spark, make_docs):
    train = make_docs([(i, t, lang) for i, (t, lang) in enumerate(
        [("the cat and the dog are in the house", "en"), ("der Hund und die Katze sind im Haus", "de")] * 4
        + [(None, "en"), ("12 34", "de"), ("", "en"), ("no label here", None)])])
    m = langid.fit(train)
    assert set(m.languages) == {"en", "de"}
    rows = [(1, None), (2, ""), (3, "123 --- 7"), (4, "the dog in the house"), (5, "die Katze im Haus"), (5, "die Katze im Haus"),
            (None, "the cat " * 30000), (7, "日本語の文章")]
    got = langid.predict(make_docs(rows, extra=True), m).collect()
    at = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    assert [at[k].lang_pred for k in (1, 2, 3)] == ["und"] * 3 and all(at[k].rejected and at[k].score == 0 for k in (1, 2, 3))
    assert at[4].lang_pred == "en" and at[5].lang_pred == "de" and at[None].lang_pred == "en"
    assert at[7].rejected and at[7].lang_pred in ("en", "de") and not at[4].rejected
    assert all(0 <= r.score <= 1 for r in got)


def test_number_signs_are_no_letters(make_docs):
    m = langid.fit(make_docs([(1, "the cat", "en"), (2, "die Katze", "de")]))
    got = langid.predict(make_docs(["½ ² ①", "Ⅷ", "a²", "ª", "漢"]), m).collect()
    assert [r.lang_pred == "und" for r in sorted(got, key=lambda r: r.doc_id)] == [True, True, False, False, False]


def test_counts_do_not_depend_on_chunks():
    text = "Les été, 12 mots... d'ici\n und Größe! " * 9 + "word" * 20
    plain = " " + langid.OTHER.sub(" ", text.lower()).strip() + " "
    b = plain.encode()
    assert langid.term_counts(text).sum() == sum(len(b) - n + 1 for n in langid.GRAMS)
    for chunk in (1, 3, 7, 50):
        assert np.array_equal(langid.term_counts(text, chunk), langid.term_counts(text))


def test_the_draw_knows_the_text_alone(make_docs):
    rows = [(i, f"some words {i % 40} of english", "en") for i in range(120)] + [(i, f"einige Wörter {i}", "de") for i in range(60)]
    a = langid.fit(make_docs(rows), per_language=20)
    b = langid.fit(make_docs([(1000 - i, t, lang) for i, t, lang in reversed(rows)], partitions=4), per_language=20)
    assert a.languages == b.languages and np.array_equal(a.idf, b.idf) and np.allclose(a.centroids, b.centroids, atol=1e-6)


def test_no_labels_and_empty_tables(make_docs):
    m = langid.fit(make_docs([(1, "text without a label")]))
    assert [tuple(r) for r in langid.predict(make_docs(["some text"]), m).collect()] == [(0, "und", 0.0, True)]
    assert langid.predict(make_docs([]), langid.fit(make_docs([]))).count() == 0


def test_scores_are_cosines_with_the_nearest_centroid(make_docs):
    m = langid.fit(make_docs([(i, t, "x") for i, t in enumerate(["aa bb cc", "dd ee ff", "gg hh ii"])]), clusters=2)
    assert len(m.centroids) == 2 and np.allclose(np.linalg.norm(m.centroids, axis=1), 1, atol=1e-5)
    row = langid.predict(make_docs(["aa bb dd"]), m).collect()[0]
    want = max(langid.vectors(langid.term_counts("aa bb dd")[None, :], m.idf)[0] @ m.centroids.T)
    assert abs(row.score - want) < 1e-5
