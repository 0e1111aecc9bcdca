"""The corpus pipeline: from documents to packed training sequences.

STAGES are applied in order; each result is written and read again before the next
stage, so a lost executor costs one stage at most. All stages but the last return the
columns of documents (doc_id, text, lang, source, n_chars); n_chars follows the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectorloom.llm import minhash, packing, quality_model, secret_scan, substring
from vectorloom.llm.common import written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
SHINGLE, PERCENT, WINDOW, MASK, END_ID, CAPACITY = 5, 80, 13, "[secret]", 2, 1024


def columns(docs: DataFrame) -> DataFrame:
    """COLUMNS, with the length of the text as it is."""
    return docs.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality classifier accepts, each by its own text. Documents without an id cannot be judged and go."""
    return quality_model.accepted(docs.select(*COLUMNS).filter("doc_id is not null"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, of the smallest id, of each group of near duplicates.

    Rows with one id are one document: the row of the least text stays. Rows without an id have no links and stay.
    """
    docs = docs.select(*COLUMNS)
    kept = minhash.near_duplicates(docs, SHINGLE, PERCENT).filter("kept and doc_id is not null").select("doc_id").distinct()
    rest = [c for c in COLUMNS if c != "doc_id"]
    one = docs.join(kept, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(F.col("text").isNull(), *rest)).alias("row"))
    return one.select("doc_id", *(f"row.{c}" for c in rest)).select(*COLUMNS).union(docs.filter("doc_id is null"))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that a document with a smaller id has; untouched texts stay as they are."""
    return columns(substring.without_repeats(docs.select(*COLUMNS), WINDOW))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every secret replaced by MASK."""
    return columns(secret_scan.masked(docs.select(*COLUMNS), MASK))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of CAPACITY tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, END_ID, CAPACITY)


STAGES = [
    ("quality classifier", quality),
    ("minhash near-dedup", near_duplicates),
    ("substring dedup", repeated_passages),
    ("secret scans", secrets),
    ("best-fit packing", packed),
]
#: Trained models and MinHash have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies STAGES to documents, writing each result into the shared checkpoint folder and reading it again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        docs = written(docs) if number + 1 < len(STAGES) else docs
    return docs
