"""Queries and oracle SQL of the operators in this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chronomark.llm.chat_format import op3_chat_windows
from chronomark.llm.decontaminate import OP8_SQL, op8_benchmark_decontamination
from chronomark.llm.lm_scoring import op10_lm_scoring
from chronomark.llm.multiset_hash import op4_multiset_fingerprints
from chronomark.llm.packing import op2_best_fit_packing
from chronomark.llm.pii import op6_surrogate_generation
from chronomark.llm.quality import op9_quality_classifier
from chronomark.llm.simhash import op7_simhash_near_dedup
from chronomark.llm.substring_dedup import op1_substring_dedup
from chronomark.llm.warc import OP5_SQL, op5_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_chat_windows": op3_chat_windows,
    "op4_multiset_fingerprints": op4_multiset_fingerprints,
    "op5_warc": op5_warc,
    "op6_surrogate_generation": op6_surrogate_generation,
    "op7_simhash_near_dedup": op7_simhash_near_dedup,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_lm_scoring": op10_lm_scoring,
}

ORACLE_SQL: dict[str, str] = {
    "op5_warc": OP5_SQL,
    "op8_benchmark_decontamination": OP8_SQL,
}
