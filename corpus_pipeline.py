"""A corpus pipeline of the training-data operators, stage by stage.

Language ID drops texts without a known or clear language; SimHash keeps one
row (the smallest doc_id) of each group of near copies; substring dedup
cuts passages that a document with a smaller doc_id has, and drops documents
with nothing left; decontamination drops documents that hold a benchmark
item; SentencePiece encodes and decodes what is left. Null texts go in the
first stage; an empty table stays empty. SimHash and decontamination judge
rows, told apart by doc_id and text: rows that share a doc_id don't stand for
each other, and a row with a null doc_id goes only if it is a near copy (it
comes last in its group) or holds an item itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bondmart.llm.common import shared_path, table
from bondmart.llm.decontaminate import find_rows
from bondmart.llm.language import UNKNOWN, learn, with_language
from bondmart.llm.sentencepiece_op import encode_decode
from bondmart.llm.simhash import first_rows
from bondmart.llm.substring_dedup import remove_repeats


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a known language that isn't ambiguous."""
    found = with_language(docs, learn(docs))
    return found.where((F.col("__lang") != UNKNOWN) & ~F.col("__ambiguous")).select(*docs.columns)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: the smallest doc_id, of that the least text."""
    first = first_rows(docs).select(F.col("doc_id").alias("__id"), F.col("row_key").alias("__key"), F.col("part").alias("__part"))
    rows = docs.join(first, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__key")))
    least = F.min(F.struct("text", *[c for c in docs.columns if c != "text"])).alias("row")
    return rows.groupBy("__part").agg(least).select(*[F.col(f"row.{c}").alias(c) for c in docs.columns])


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their repeated passages; those left empty go."""
    cut = remove_repeats(docs).where("n_left is null or n_left > 0")
    length = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", length).select(*docs.columns)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no item of benchmark."""
    bad = find_rows(docs, table(spark, sf_dir, "benchmark")).select(
        F.col("doc_id").alias("__id"), F.col("row_key").alias("__key")).distinct()
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__key")), "left_anti")


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of what is left."""
    return encode_decode(docs)


STAGES = [
    ("language_id", language_stage),
    ("simhash", simhash_stage),
    ("substring_dedup", substring_stage),
    ("decontamination", decontaminate_stage),
    ("sentencepiece", encode_stage),
]

#: The stages learn models and tokenise, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet to the shared
    folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
