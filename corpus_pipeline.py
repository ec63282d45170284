"""The training-data pipeline: five operators, each on all that the one before kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
a stage's rows as Parquet and rereads them as the next one's documents.
"""

from __future__ import annotations

import public_tokenizers as P
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagecut.llm import op01_simhash, op02_bpe, op03_toxicity, op04_exact, op06_mix
from pagecut.llm.common import store, table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold (0.3), learnt from the labels that are not held out."""
    labels = op03_toxicity.learnable(table(spark, sf_dir, "labels"))
    return op03_toxicity.scored(docs, labels, docs.columns).where("score < 0.3").select("doc.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return op04_exact.drop_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the smallest doc_id."""
    return op01_simhash.drop_near_duplicates(docs, shingle=3, max_bits=2)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: a document's row stands as often as the mix takes it."""
    return op06_mix.take(docs, weights=(3, 1, 2), share=1.5, cap=2)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of their decoding."""
    encoded = op02_bpe.bpe_round_trip(docs, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    return op02_bpe.digests(encoded).withColumnRenamed("id", "doc_id")


STAGES = [("toxicity", toxicity), ("exact dedup", exact_dedup), ("SimHash near-dedup", near_dedup),
          ("mixing sources to target weights", mixing), ("byte-level BPE encoding and decoding", encoding)]

#: Viterbi decoding, fingerprints and merges are not expressible in SQL; the rows are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = store(stage(spark, docs, sf_dir), f"stage{i}")
    return docs
