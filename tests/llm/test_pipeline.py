"""The pipeline against its stages' operators on small tables, and its contract."""

from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline as P
from postlytics.llm import decontaminate, quality_mcd, simhash
from postlytics.sources.tables import table
from llm_fixtures import SF001, make_docs  # noqa: F401


def test_stage_order_and_columns(spark, workdir):
    assert [n for n, _ in P.STAGES] == ["quality", "near_duplicates", "repeated_passages", "benchmark_passages", "packing"]
    docs, sizes = table(spark, SF001, "documents"), []
    columns = docs.columns
    for k, (name, stage) in enumerate(P.STAGES):
        before = docs
        stage(spark, docs, SF001).write.parquet(f"{workdir}/{k}")
        docs = spark.read.parquet(f"{workdir}/{k}")
        sizes.append(docs.count())
        if name != "packing":
            assert docs.columns == columns
        ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
        if name == "quality":
            assert ids(docs) == ids(quality_mcd.quality(before).where("kept"))
        elif name == "near_duplicates":
            assert ids(docs) == ids(simhash.near_duplicates(before).where("doc_id = component_id"))
        elif name == "repeated_passages":
            assert ids(docs) == ids(before)
            was = {r.doc_id: r.text for r in before.collect()}
            now = {r.doc_id: r.text for r in docs.collect()}
            assert shared_runs(was.values()) and not shared_runs(now.values())
            assert all(now[i] == was[i] for i in was if was[i] and not repeats(was)[i])
            assert all(r.n_chars == len(r.text) for r in docs.collect())
        elif name == "benchmark_passages":
            bench = table(spark, SF001, "benchmark")
            assert ids(docs) == ids(decontaminate.contamination(before, bench).where("not contaminated"))
            assert decontaminate.contamination(docs, bench).where("contaminated").count() == 0
        else:
            assert sorted(r.doc_id for r in docs.where("start = 0").collect()) == ids(before)
    assert sizes[0] < table(spark, SF001, "documents").count() and sizes[1] < sizes[0] and sizes[3] <= sizes[2]


def shared_runs(texts, n=P.PASSAGE_WORDS):
    """Runs of n words that are in more than one text."""
    seen = Counter(g for t in texts for w in [(t or "").split()] for g in {tuple(w[i:i + n]) for i in range(len(w) - n + 1)})
    return {g for g, k in seen.items() if k > 1}


def repeats(texts, n=P.PASSAGE_BYTES):
    """Whether a text holds a string of n bytes that also starts elsewhere, its own places included."""
    body = {i: (t or "").encode() for i, t in texts.items()}
    seen = Counter(b[k:k + n] for b in body.values() for k in range(len(b) - n + 1))
    return {i: any(seen[b[k:k + n]] > 1 for k in range(len(b) - n + 1)) for i, b in body.items()}


def test_stages_with_odd_rows_and_clashing_columns(spark, make_docs):
    """Nulls in any column, ties, repeated and empty rows, columns that differ in case only."""
    prose = [" ".join(f"w{(i * 7 + k * k) % 997}x" for k in range(60 + i)) for i in range(6)]
    rows = [(i, t, "en", "s") for i, t in enumerate(prose)] + [(i, t, None, None) for i, t in enumerate([None, "", " \n", "x"], 20)]
    rows += [(2, prose[2], "en", "s"), (None, prose[4], None, "s"), (30, prose[5], "de", "t")]
    docs, plain = make_docs(rows, extra=True, partitions=2), make_docs(rows)
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF001)
        assert out.columns == docs.columns
        got = [sorted(((r.doc_id, r.text) for r in stage(spark, d, SF001).select(F.col("doc_id"), F.col("text")).collect()), key=repr)
               if d is plain else sorted(((r[docs.columns.index("doc_id")], r[docs.columns.index("text")]) for r in out.collect()), key=repr)
               for d in (docs, plain)]
        assert got[0] == got[1], name
    assert P.packing_stage(spark, docs, SF001).count() >= len(rows)


def test_run_and_registration(spark):
    import __spark_entry__ as E
    assert P.ORACLE_SQL is None and E.queries()["pipeline"] is P.run
    out = P.run(spark, SF001)
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(out.columns) and out.count() > 0


def test_empty_documents(spark):
    docs = table(spark, SF001, "documents").limit(0)
    for _, stage in P.STAGES:
        out = stage(spark, docs, SF001)
        assert out.count() == 0
        docs = out if "text" in out.columns else docs
