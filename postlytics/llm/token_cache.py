"""Token counts through a digest cache.

Content digests (sha256 of the normalised text: null becomes the empty text, nothing else is
changed, since any other normalisation could change the count) are joined to the counts stored
for the tokenizer's own digest.  Only distinct misses are encoded, and appended to the store.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlytics.llm.common import pick, worker_cache

CACHE_SCHEMA = "digest binary, n_tokens bigint"


def tokenizer_version(model_path: str) -> str:
    """Digest of the model file and of the library's version: a change of either is a new cache."""
    import sentencepiece

    h = hashlib.sha256(f"sentencepiece {sentencepiece.__version__}\n".encode())
    with open(model_path, "rb") as f:
        h.update(f.read())
    return h.hexdigest()[:32]


def _processor(model_path: str):
    cache = worker_cache()
    if (key := ("sentencepiece", model_path)) not in cache:
        import sentencepiece

        cache[key] = sentencepiece.SentencePieceProcessor(model_file=model_path)
    return cache[key]


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether a folder exists and holds a Parquet file, by the cluster's own file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/*.parquet")
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def _encoder(model_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = _processor(model_path)
        for b in batches:
            texts, n = b.column("body").to_pylist(), []
            for i in range(0, len(texts), 64):  # ids of few texts at a time
                n += [len(x) for x in sp.encode(texts[i:i + 64], num_threads=1)]
            yield pa.RecordBatch.from_arrays([b.column("digest"), pa.array(n, pa.int64())],
                                             names=["digest", "n_tokens"])
    return run


def count_tokens(docs: DataFrame, model_path: str, cache_path: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) per row of docs.

    Counts are those of the sentencepiece model over the whole text, without begin or end
    tokens.  Null and empty texts have 0 bytes and 0 tokens; repeated rows and copies are
    encoded once and each gets its row; an empty table gives no rows and appends nothing.
    The cache is a Parquet folder per tokenizer version below `cache_path`, on storage that all
    executors share; one writer at a time.  A rerun after a failure encodes what is still missing.
    """
    spark = docs.sparkSession
    store = f"{cache_path.rstrip('/')}/tokenizer={tokenizer_version(model_path)}"
    body = F.coalesce("text", F.lit(""))
    rows = pick(docs, "doc_id", "text").select("doc_id", body.alias("body"),
                                               F.unhex(F.sha2(body, 256)).alias("digest"))
    misses = rows.select("digest", "body").dropDuplicates(["digest"])
    if has_data(spark, store):
        misses = misses.join(spark.read.schema(CACHE_SCHEMA).parquet(store), "digest", "left_anti")
    misses.mapInArrow(_encoder(model_path), CACHE_SCHEMA).write.mode("append").parquet(store)
    counts = spark.read.schema(CACHE_SCHEMA).parquet(store)
    return (rows.select("doc_id", F.octet_length("body").cast("long").alias("n_bytes"), "digest")
            .join(counts, "digest")
            .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))
