"""Registered queries of the operators, with production parameters, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (
    bpe, decontamination, hard_negatives, html_text, line_dedup, quality_classifier, quality_rules, secrets, simhash, sql,
    token_counts, url_filter, vector_codes, warc,
)

Query = Callable[[SparkSession, str], DataFrame]

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def queries() -> dict[str, Query]:
    return {
        "op1_secret_scan": secrets.scan,
        "op2_bpe_round_trip": lambda spark, folder: bpe.round_trip(spark, folder, WORD_BPE),
        "op3_simhash_groups": simhash.groups,
        "op4_line_dedup": line_dedup.report,
        "op5_token_counts": lambda spark, folder: token_counts.counts(spark, folder, BYTE_BPE),
        "op6_quality_rules": quality_rules.verdicts,
        "op7_decontamination": decontamination.report,
        "op8_html_text": html_text.texts,
        "op9_warc_archive": warc.archive,
        "op10_quality_scores": quality_classifier.scores,
        "op11_hard_negatives": hard_negatives.negatives,
        "op12_url_filter": url_filter.verdicts,
        "op13_vector_codes": vector_codes.codes,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_line_dedup": sql.LINE_DEDUP,
        "op6_quality_rules": sql.quality_rules(),
        "op7_decontamination": sql.DECONTAMINATION,
        "op11_hard_negatives": sql.HARD_NEGATIVES,
        "op13_vector_codes": sql.vector_codes(),
    }
