"""The corpus pipeline: documents to packed training sequences, in stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and reread as the next stage's ``docs``. All but the last
return the columns of ``documents``: doc_id, text, lang, source, n_chars.

Every stage takes those columns by their exact names, so extra ones may clash
with anything; an empty table gives an empty result. Repeated rows are rows of
their own until the near-duplicates go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dimfold.llm import best_fit_packing, language_id, quality_rules, simhash_dedup, source_mixing
from dimfold.llm.common import read, stage_table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines leave the texts; documents that fail the rules go.

    Null and empty texts fail; a null source is a host of its own; n_chars is counted anew.
    """
    return quality_rules.keep_clean(docs)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of no clear language go; ``lang`` becomes the predicted one.

    Texts without a letter go; a null lang is learned from by no one and gets its prediction.
    """
    return language_id.keep_known(docs)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, that of the smallest doc_id.

    Of rows that repeat it one stays; a null doc_id stands only for a group that has no other.
    """
    return simhash_dedup.keep_one(docs, shingle=4, max_distance=4)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are repeated or thinned to their target; a text may be there several times, and once in part.

    A null source is the last one; texts without words are never taken; equal rows take their turns.
    """
    return source_mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in the training sequences; null ids and repeated rows are packed too."""
    return best_fit_packing.pack(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("language ID", language_stage),
    ("SimHash near-dedup", dedup_stage),
    ("mixing sources", mixing_stage),
    ("best-fit packing", packing_stage),
]

#: Language ID and the tokens of packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written before the next reads them."""
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stage_table(docs)
    return docs
