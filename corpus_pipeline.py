"""Corpus pipeline: quality, line dedup, near-duplicates, mixing, token ids. Each stage reads what its predecessor kept.

All stages but the last return the columns of their input, whatever their names. A null text counts as empty, a null doc_id as an id
that comes first in the order of lines and last among near-duplicates; rows of one id are documents of their own, of equal rows
near-dedup keeps one. Empty and very long texts are documents like others; of tables without rows, rows or labels come no rows, or
none are rejected. Ties go by doc_id, then by a hash of the row, so that reruns agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notelake.llm import alike, lines, mixing, pieces, quality, simhash
from notelake.llm.common import stored
from notelake.llm.queries import model_path


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject; learnt from the labels of the table."""
    return quality.kept(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that came before; documents of which nothing is left go, and n_chars is counted anew."""
    left = lines.deduplicated(docs)
    before = docs.columns
    fresh = left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in before else left
    return fresh.where(F.col("text").isNull() | F.col("text").rlike("\\S")).select(*before)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of the smallest doc_id."""
    return simhash.kept(docs, alike.LEAST)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of sources takes them, to whole documents."""
    return mixing.rendered(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with an end id, and the text that they decode to."""
    coded = pieces.encoded(docs.select("doc_id", "source", "text"), model_path(), back="decoded")
    return coded.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality classifier", good), ("line dedup", unrepeated), ("SimHash near-dedup", distinct), ("mixing sources to target weights", mixed), ("SentencePiece encoding and decoding", tokens)]

#: The learnt classifier and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        docs = stored(docs, f"stage{k}") if k < len(STAGES) - 1 else docs
    return docs
