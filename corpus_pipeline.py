"""The corpus pipeline: quality, near duplicates, repeated passages, benchmark passages, packing.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the next stage's docs.  All stages but
the last return the columns of docs, whatever further ones there are and however they are named.
An empty table gives an empty table at each stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from postlytics.llm import decontaminate, packing, pfp_dedup, quality_mcd, simhash
from postlytics.llm.common import written
from postlytics.sources.tables import table


#: Words of a repeated passage, the bytes looked for (fewer than such a passage has), and of its grams.
PASSAGE_WORDS, PASSAGE_BYTES, PASSAGE_GRAM = 51, 200, 50


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule or lie far from their language and source go.

    Null, empty and blank texts and those of under 50 words fail the base rule; a null language
    or source is a group like others; of repeated rows all stay or go.
    """
    return quality_mcd.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays: the one of smallest doc_id (null
    last), of repeated rows one.  All texts without a word are one group.
    """
    return simhash.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of over 50 words that also start elsewhere are cut out of the texts, everywhere.

    Found are strings of PASSAGE_BYTES, fewer than PASSAGE_WORDS words of prose have (238 at
    least among the documents of sf0.1 labelled good); cut is what they cover where it has
    PASSAGE_WORDS words.  A run of so many words that are shorter still, of under three letters
    on average, may stay.  All rows stay: a text without anything else becomes empty, a null text
    stays null.
    """
    return pfp_dedup.remove_repeats(docs, PASSAGE_BYTES, PASSAGE_GRAM, PASSAGE_WORDS)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark window go; null and empty texts have none and stay."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 tokens; a null or empty text is its end token alone."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality", quality_rules), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages),
          ("benchmark_passages", benchmark_passages), ("packing", packing_stage)]

#: Tokenizers, fingerprints and iterated estimates have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
