"""The corpus pipeline: quality rules, near duplicates, benchmark contamination, secrets, SentencePiece ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next one's
docs. All but the last return the columns of documents, and extra columns pass through them; the last has columns of its own.
Null and empty texts fail the quality rules. Null ids and repeated rows pass each stage or are dropped by their text alone. An empty
table gives no rows. Texts are taken whole, however long.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.llm import contamination, near_duplicates, quality, secret_scan, sentence_pieces
from ledgerwatch.llm.common import Scratch, documents


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the base rule or the decision list learned from the labels rejects."""
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each group linked at a similarity of 0.8 of five-word shingles."""
    return near_duplicates.deduplicated(docs, n=5, percent=80)


def contamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item within a fifth of its words of edits."""
    return contamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts a mark in the place of each secret and counts the characters anew."""
    return secret_scan.redacted(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text instead of the text, their number, and whether they decode to it; extra columns end here. A null text has none."""
    rows = sentence_pieces.encoded(docs, back_col="back")
    return rows.select("doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"), (F.col("back") == F.translate("text", sentence_pieces.SPACE, " ")).alias("lossless"))


STAGES = [
    ("quality rules", quality_stage),
    ("near duplicates", near_duplicate_stage),
    ("benchmark contamination", contamination_stage),
    ("secrets", secret_stage),
    ("sentence pieces", token_stage),
]

#: Learned rules and tokenizers can't be expressed in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = documents(spark, sf_dir), Scratch(spark)
    for _, stage in STAGES[:-1]:
        before, docs = docs, scratch.write(stage(spark, docs, sf_dir))
        scratch.drop(before)
    return STAGES[-1][1](spark, docs, sf_dir)
