"""Corpus pipeline: quality, near copies, benchmark passages, personal data, packing; every stage is one operator of chronomark.llm.

``run`` writes each stage's rows as Parquet in the shared folder and rereads them as the next one's documents. All stages
but the last return the columns of ``documents``. No SQL: the stages are checked against brute force in tests/llm.

Every stage takes any columns beside doc_id, text, lang and n_chars, whatever their names, and passes them on; null and empty
texts are texts without words; a null doc_id is an id; repeated rows are rows; an empty table gives an empty one; a very long
text is handled whole. What a stage makes of these cases is said at the stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chronomark.llm._common import materialize, table
from chronomark.llm.decontaminate import decontaminate
from chronomark.llm.near_dedup import keep_one_near_copy
from chronomark.llm.packing import pack_digests
from chronomark.llm.pii import pseudonymize
from chronomark.llm.quality import filter_quality

ORACLE_SQL: str | None = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity or toxicity is over their language's threshold go; so do texts without words (null, empty, blank).

    Repeated rows get the same verdict; a null lang is the language ""; without labels all texts with words stay."""
    return filter_quality(docs, table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every class of near copies the document of least doc_id stays, a null one last. Links: op 7's fingerprints at two bits or fewer; five-word shingles at a similarity of 0.8.

    Ties of the id: the least hash of the text, then of all columns; repeated rows leave one; texts without words are one class."""
    return keep_one_near_copy(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of test items are cut out; documents that are mostly such passages go.

    Null and empty texts have no passages and stay as they are; an empty benchmark changes nothing."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pii_surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets are replaced by keyed surrogates, the same ones in repeated rows; null and empty texts stay."""
    return pseudonymize(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents, placed in sequences; a null or empty text is one piece of one token, repeated rows are pieces each."""
    return pack_digests(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pii_surrogates", pii_surrogates),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
