"""A training corpus from raw documents, in stages that each call one of the text operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from plumbline.llm import decontaminate, dedup, langid, packing, pii
from plumbline.llm.common import Scratch, table

#: The similarity of five-word shingle sets from which the stage links documents, as a fraction.
NEAR = (80, 100)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised: texts without a letter and ambiguous ones go.

    Null, empty and blank texts have no letter. Repeated rows stay or go together; no rows in, no rows out.
    """
    return langid.recognised(docs, langid.train(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicate texts at a similarity of 0.8: that of the least doc_id, if it has any.

    Null and blank texts are near nothing: such rows stay, but for repeated ones of one doc_id. No rows in, no rows out.
    """
    return dedup.survivors(docs, *NEAR)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found.

    Null, empty and blank texts hold none. Without items all documents stay; no rows in, no rows out.
    """
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind in brackets and n_chars counted again.

    Null texts stay null and empty ones empty; repeated rows repeat; no rows in, no rows out.
    """
    return pii.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and the sequences they lie in.

    Null and empty texts are the one id that ends a document. Repeated rows repeat; no rows in, no rows out.
    """
    return packing.sequences(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", pack),
]

#: SQL can't express the trained classifier, the aligned windows and the differencing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents; each one's result is written to the shared folder and read again."""
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark, "pipeline")
    for _, stage in STAGES[:-1]:
        docs = scratch.cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
