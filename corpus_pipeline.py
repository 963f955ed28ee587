"""Corpus pipeline: classify, deduplicate exactly, deduplicate nearly, mix sources, pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run``
writes as Parquet to the shared folder and reads again as the next one's docs.
All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedmetrics.llm import exact_dedup, mixing, packing, quality_fm, simhash
from feedmetrics.llm.base import release, staged
from feedmetrics.llm.queries import MIX_BLOCK, MIX_CAP, MIX_CYCLE, MIX_SEED, MIX_SHARD, tokenizer_file
from feedmetrics.session import configure


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on labelled documents, does not reject."""
    release(spark)
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return quality_fm.accepted(docs, quality_fm.train(docs, labels))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document for each text: that of the largest id."""
    release(spark)
    return exact_dedup.distinct_documents(docs, keep="largest")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document for each group of near copies: that of the smallest id."""
    release(spark)
    return simhash.one_of_each(docs, words_each=3, max_bits=3)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of sources takes them."""
    release(spark)
    return mixing.mixed_documents(docs, mixing.cyclic_weights(docs, MIX_CYCLE), cap=MIX_CAP, block_words=MIX_BLOCK,
                                  shard_docs=MIX_SHARD, seed=MIX_SEED)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 4096 tokens."""
    release(spark)
    return packing.pack(docs, tokenizer_file(), end_id=2)


STAGES = [("quality_classifier", classify), ("exact_dedup", exact), ("simhash_dedup", near), ("mix_sources", mix),
          ("pack", pack)]

# The classifier is trained, and fingerprints are XXH64 counts: SQL expresses neither.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over all documents."""
    configure(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
