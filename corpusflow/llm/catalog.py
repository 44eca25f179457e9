"""Registered queries of this package: one per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    op1_pieces, op2_quality, op3_spots, op4_language, op5_minhash, op6_pii, op7_lines, op8_packing, op9_rollup, op10_repeats, op11_negatives,
    op12_alignment, op13_bytes)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_sentencepiece": op1_pieces.query,
        "op2_quality_rules": op2_quality.query,
        "op3_spotsigs": op3_spots.query,
        "op4_language_id": op4_language.query,
        "op5_minhash": op5_minhash.query,
        "op6_pii": op6_pii.query,
        "op7_line_dedup": op7_lines.query,
        "op8_packing": op8_packing.query,
        "op9_token_counts": op9_rollup.query,
        "op10_suffix_dedup": op10_repeats.query,
        "op11_hard_negatives": op11_negatives.query,
        "op12_alignment": op12_alignment.query,
        "op13_byte_bpe": op13_bytes.query,
    }


def oracle_sql() -> dict[str, str]:
    """None yet: SQL cannot express tokenizer ids, forests or packings; the tests
    hold these queries against brute force instead."""
    return {}
