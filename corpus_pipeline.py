"""From raw documents to packed sequences: language, repeated lines, near duplicates, secrets, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwright.llm import jaccard_join, language, line_dedup, packing, secrets
from tripwright.llm.common import written
from tripwright.llm.vocabulary import WORD_BPE, vocabulary


def with_length(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``n_chars`` follows the text, where the table has it."""
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return docs.select(*(F.col(f"`{c}`") for c in columns))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a language that the labelled rows have; ``und`` goes. ``lang`` becomes the prediction."""
    found = language.tagged(docs, language.trained(docs)).where(F.col("lang") != language.UNKNOWN)
    return found.select(*((F.col("lang") if c == "lang" else F.col("row").getField(c)).alias(c) for c in docs.columns))


#: Near copies share four fifths of their runs of five words; op6's own query has other values.
NEAR_SHINGLE, NEAR_PERCENT = 5, 80


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that many documents repeat."""
    return with_length(line_dedup.drop_repeated(docs), docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the least id, once; a null id is the least."""
    near = jaccard_join.linked_components(docs, shingle=NEAR_SHINGLE, percent=NEAR_PERCENT)
    least = near.where("doc_id <=> component_id").select(F.col("doc_id").alias("least")).distinct()
    kept = docs.join(least, docs["doc_id"].eqNullSafe(least["least"]), "left_semi")
    return kept.dropDuplicates(["doc_id", "text"])


def mark_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with secrets replaced by a mark; no document goes."""
    return with_length(secrets.redact(docs), docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all texts with their places in sequences of 4096 tokens."""
    return packing.pack(docs, vocabulary(WORD_BPE))


STAGES = [
    ("language", identify_language),
    ("lines", drop_lines),
    ("near_copies", drop_near_copies),
    ("secrets", mark_secrets),
    ("packing", pack_sequences),
]
#: Language models and tokenizers have no SQL form; tests compare each stage with a plain Python one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each writes its table, which the next one reads."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
