"""The stages of the corpus pipeline: five steps over documents, each written and read again before the next.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept. All but the last return the columns of
documents. Null texts fail the quality rules, so the later stages see none unless run alone, where they have the
results that their operators state. Empty tables pass through every stage; extra columns are carried to the last stage, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from terminus.llm import language, nearcopies, packing, quality, repeats
from terminus.llm.common import delete, gathered, materialize, table, written

#: A document stays if it is in one of the learned languages with this probability.
LEAST_SCORE = 0.5


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the learned decision list (operator 4)."""
    return gathered(quality.passed(docs, table(spark, sf_dir, "labels")), docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language (operator 9)."""
    return gathered(language.passed(docs, LEAST_SCORE), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity of 0.8 or more) the row with the smallest doc_id (operator 7's stage)."""
    return nearcopies.first_copies(docs)


def repeat_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of over 50 words (strings of `repeats.PASSAGE` bytes) that start elsewhere too (operator 10)."""
    return repeats.cleaned(docs, repeats.PASSAGE)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents packed into sequences (operator 2)."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("simhash_near_dedup", near_dedup),
    ("suffix_array_dedup", repeat_dedup),
    ("best_fit_packing", best_fit_packing),
]

#: Learned rules, fingerprints and tokenizers are not for SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage has written beside its result is deleted when the result stands."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before = set(written(spark))
        docs = materialize(stage(spark, docs, sf_dir), name)
        delete(spark, [p for p in written(spark) if p not in before and p != docs._terminus_path])
    return STAGES[-1][1](spark, docs, sf_dir)
