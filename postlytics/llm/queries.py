"""The registered query of each operator, with production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlytics.llm import (decontaminate, html_text, langid, packing, pfp_dedup, prefix_trie, quality_mcd, quality_pu,
                            sharding, simhash, token_cache, url_filter, whitening)
from postlytics.session import scratch_path
from postlytics.sources.tables import table


def held_out(parts: int = 3, part: int = 1) -> F.Column:
    """Whether crc32 of the doc_id as text leaves `part` when divided by `parts` (a null doc_id: no)."""
    return F.coalesce(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % parts == part, F.lit(False))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~held_out()))
    return langid.predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A new cache for each call: every distinct text is encoded, as on a first run."""
    return token_cache.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"),
                                    scratch_path(spark, "token-cache"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return n.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_mcd.quality(table(spark, sf_dir, "documents")).select(
        "doc_id", *quality_mcd.STATS, "base_failed", "kept", "mcd_distance")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pfp_dedup.removed_bytes(table(spark, sf_dir, "documents"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return c.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                    F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_pu.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), held_out(5, 0))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_language_id, op2_token_counts, op3_url_filter, op4_html_text, op5_packing, op6_simhash,
                            op7_quality, op8_suffix_dedup, op9_sharding, op10_decontamination, op11_whitening,
                            op12_quality_classifier, op13_prefix_trie)}
