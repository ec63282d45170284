"""The registered queries: each applies one operator to its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers as P
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagecut.llm import op01_simhash as op01, op02_bpe as op02, op03_toxicity as op03, op04_exact as op04
from pagecut.llm import op05_suffix as op05, op06_mix as op06, op07_count as op07, op08_lines as op08
from pagecut.llm import op09_pii as op09, op10_urls as op10, op11_align as op11
from pagecut.llm import op12_negatives as op12, op13_words as op13
from pagecut.llm.common import table
from pagecut.llm.sql import SQL

ENCODING = P.path("byte_bpe_multi_50k.tiktoken")
COUNTING = P.path("byte_bpe_50k.json")
PIECES = P.path("piece_bpe_32k.model")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = op01.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = op02.bpe_round_trip(table(spark, sf_dir, "documents"), ENCODING, P.PATTERN)
    return op02.digests(encoded).withColumnRenamed("id", "doc_id")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = op03.learnable(table(spark, sf_dir, "labels"))
    found = op03.scored(table(spark, sf_dir, "documents"), labels, ["doc_id"])
    return found.select("doc.doc_id", F.coalesce(op03.held_out(F.col("doc.doc_id")), F.lit(False)).alias("held_out"),
                        "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op4_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op04.exact_groups(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op5_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = op05.dedup_substrings(table(spark, sf_dir, "documents"), length=100)
    return found.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = op06.mix(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, cap=2)
    return found.select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                        (F.col("size") * F.col("copies")).alias("taken"))


def op7_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = op07.token_counts(table(spark, sf_dir, "documents"), COUNTING, P.PATTERN)
    return found.select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


def op8_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op08.line_quality(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op09.personal_data(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = op10.judge(table(spark, sf_dir, "pages"))
    return found.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict")


def op11_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = op11.align(table(spark, sf_dir, "documents"), COUNTING, PIECES, P.PATTERN, digest=True)
    return found.withColumnsRenamed({"id": "doc_id", "groups": "groups_sha256"})


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return op12.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


def op13_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = op13.bpe_round_trip(table(spark, sf_dir, "documents"), COUNTING, P.PATTERN, digest=True)
    return found.withColumnRenamed("id", "doc_id")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # beside the package; its stages import the operators in turn

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_simhash, op2_bpe, op3_toxicity, op4_exact, op5_suffix, op6_mix, op7_count,
                                   op8_lines, op9_pii, op10_urls, op11_align, op12_negatives, op13_words, pipeline)}
