"""From raw documents to token ids: five stages, each stored in the shared folder before the next one reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapwright.llm import bpe, decontamination, line_dedup, quality_classifier, simhash, word_sets
from lapwright.llm.common import stored, table
from lapwright.llm.registry import WORD_BPE


def good(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    scored = quality_classifier.classify(docs, table(spark, folder, "labels"))
    return scored.filter("predicted = 1").select(*docs.columns)


def without_copied_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without later copies of long line runs; n_chars follows, and a document that was nothing else goes."""
    done = line_dedup.deduplicate(docs)
    cut = F.size("removed") > 0
    left = done.withColumn("n_chars", F.when(cut, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return left.filter(~cut | F.col("text").rlike(r"[^\x20\x09-\x0D]")).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of every group of near-duplicates, by fingerprints or by four fifths of their five-word runs."""
    return simhash.keep_one(docs, similarity=word_sets.SIMILARITY)


def uncontaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents in which no passage of a benchmark item occurs."""
    return decontamination.keep_clean(docs, table(spark, folder, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """doc_id, ids, n_tokens and the decoded text of every document that is left."""
    return bpe.decode(bpe.encode(docs.select("doc_id", "text"), WORD_BPE).drop("text"), WORD_BPE)


STAGES = [
    ("quality_classifier", good),
    ("line_dedup", without_copied_lines),
    ("simhash_near_dedup", one_of_each_group),
    ("benchmark_decontamination", uncontaminated),
    ("bpe_encoding", encoded),
]

# A fitted classifier and a tokenizer are beyond SQL; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """Apply all stages to the documents."""
    docs = table(spark, folder, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, folder))
    return STAGES[-1][1](spark, docs, folder)
