"""Queries of the training-data operators, each over its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwright.llm import (
    bpe,
    centroid_clusters,
    conversation_repair,
    fingerprints,
    hnsw,
    jaccard_join,
    kd_shards,
    language,
    lempel_ziv_dedup,
    line_dedup,
    packing,
    secrets,
    suffix_dedup,
)
from tripwright.llm.vocabulary import BYTE_BPE, WORD_BPE, vocabulary


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), vocabulary(BYTE_BPE), with_ids=False)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.drop_repeated_bytes(table(spark, sf_dir, "documents")).drop("kept")


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.trained(docs))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lempel_ziv_dedup.drop_repeated_words(table(spark, sf_dir, "documents")).drop("kept")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary(WORD_BPE))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.linked_components(table(spark, sf_dir, "documents"))


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries are the rows whose id is divisible by 100."""
    vectors = table(spark, sf_dir, "embeddings")
    return hnsw.search(vectors, vectors.where(F.col("vec_id") % 100 == 0))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.summary(table(spark, sf_dir, "documents"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


def op11_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards.summary(table(spark, sf_dir, "documents"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clusters.summary(table(spark, sf_dir, "embeddings"))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.summary(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_language": op3_language,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_packing": op5_packing,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_nearest": op7_nearest,
    "op8_line_dedup": op8_line_dedup,
    "op9_secrets": op9_secrets,
    "op10_fingerprints": op10_fingerprints,
    "op11_kd_shards": op11_kd_shards,
    "op12_centroids": op12_centroids,
    "op13_repair": op13_repair,
}
ORACLES = {"op8_line_dedup": line_dedup.ORACLE}
