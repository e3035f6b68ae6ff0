"""Queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from muster.llm import (
    byte_bpe,
    chat,
    decontamination,
    hard_negatives,
    line_dedup,
    minhash_dedup,
    periodic_runs,
    quality_rules,
    sharding,
    substring_dedup,
    token_counts,
    url_filter,
    warc,
)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_substring_dedup": substring_dedup.op1_substring_dedup,
        "op2_url_filter": url_filter.op2_url_filter,
        "op3_chat_formatting": chat.op3_chat_formatting,
        "op4_minhash_dedup": minhash_dedup.op4_minhash_dedup,
        "op5_line_dedup": line_dedup.op5_line_dedup,
        "op6_token_counts": token_counts.op6_token_counts,
        "op7_decontamination": decontamination.op7_decontamination,
        "op8_sharding": sharding.op8_sharding,
        "op9_byte_bpe": byte_bpe.op9_byte_bpe,
        "op10_quality_rules": quality_rules.op10_quality_rules,
        "op11_periodic_runs": periodic_runs.op11_periodic_runs,
        "op12_warc": warc.op12_warc,
        "op13_hard_negatives": hard_negatives.op13_hard_negatives,
    }


def statements() -> dict[str, str]:
    return {
        "op2_url_filter": url_filter.sql(),
        "op3_chat_formatting": chat.sql(),
        "op5_line_dedup": line_dedup.sql(),
        "op12_warc": warc.sql(),
        "op13_hard_negatives": hard_negatives.sql(),
    }
