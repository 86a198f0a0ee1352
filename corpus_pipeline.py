"""The training-data pipeline: quality, line dedup, near-dedup, decontamination, encoding.

Every stage takes what its predecessor kept. All but the last return the columns of documents; n_chars follows the text.

- A null text passes the quality stage (nothing speaks against it), is a copy of empty ones for near-dedup, holds no
  benchmark window and encodes to no ids. Null ids stay; a class of copies keeps the least id, nulls last, and the first
  of rows that repeat it. Ties with a threshold stay.
- Rows that repeat are documents of their own until near-dedup, which keeps one. Very long texts are never cut.
- An empty table of documents, labels or benchmark items gives what the operators say: no rows, no rejections, no hits.
- Other columns of documents are dropped by the first stage, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterloom.llm import byte_bpe, decontaminate, kn_quality, line_dedup, near_dup
from rosterloom.llm.chunks import forget, made
from rosterloom.sources.shared import delete, scratch, shared_dir, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is within their language's quantile of trusted text; those above go."""
    return kn_quality.accepted(docs.select(COLUMNS), _table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the lines that ten or more of these documents share. All documents stay, some of them empty."""
    out = line_dedup.dedup_lines(docs.select(COLUMNS), out="_kept")
    changed = F.col("n_dropped") > 0
    return out.select("doc_id", F.when(changed, F.col("_kept")).otherwise(F.col("text")).alias("text"), "lang", "source", F.when(changed, F.char_length("_kept").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least doc_id, of each class of near copies."""
    return near_dup.keep_one(docs.select(COLUMNS))


def clean_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark window; those that hold one go whole."""
    return decontaminate.decontaminate(docs.select(COLUMNS), _table(spark, sf_dir, "benchmark")).where(~F.col("contaminated")).select(COLUMNS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and token_ids of each document, and the SHA-256 of the bytes that the ids decode to."""
    out = byte_bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, back=True)
    return out.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids", "decoded_sha256")


STAGES = [("quality", quality), ("line_dedup", lines), ("near_dedup", near_copies), ("decontamination", clean_of_benchmarks), ("byte_bpe", encoded)]

#: The model's perplexities and the samples can't be expressed in SQL; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents, each written to the shared folder and read again by the next.

    What a stage writes on its way, and what the one before it gave, goes when its result is written; the former also when it fails.
    """
    docs, last = _table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        since, path = made(), shared_dir(spark, name)
        with scratch(spark):
            try:
                docs = written(stage(spark, docs, sf_dir), path=path)
            finally:
                forget(spark, since)
        if last:
            delete(spark, last)
        last = path
    return docs
