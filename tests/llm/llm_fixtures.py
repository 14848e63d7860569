"""Small tables for the tests of this folder."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])
#: Columns named like outputs and helpers of the operators.
EXTRA = ["key", "fp", "kept", "n_words", "spans", "component", "shard", "host", "score", "grp", "w", "suffix", "digest", "slot",
         "DOC_ID", "TEXT", "Lang", "__id", "__0", "id", "hash", "text "]


@pytest.fixture()
def make_docs(spark):
    """docs(texts or (doc_id, text[, lang, source]) rows, extra) with clashing extra columns if asked for."""
    def make(rows, extra=False, partitions=None):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        rows = [(*r, *(None,) * (4 - len(r)), len(r[1]) if r[1] is not None else None) for r in rows]
        df = spark.createDataFrame(rows, DOCS)
        if extra:
            df = df.select(*[F.lit("x").alias(c) for c in EXTRA[:3]], "*", *[F.lit("x").alias(c) for c in EXTRA[3:]])
        return df.repartition(partitions) if partitions else df
    return make
