"""Documents made into training sequences: five stages, each over all that the last one kept.

Language identification drops documents without a language, near-duplicates (four fifths of
the shingles shared) are reduced to one of each group, documents that hold benchmark items go, personal data is replaced, and
what is left is packed into sequences. Between the stages stands a Parquet table in the
shared folder, so that a lost executor costs no more than a part of one stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from newspipe.llm import forest, language, leaks, packing, surrogates
from newspipe.llm.queries import SURROGATE_KEY, VOCABULARY, table
from newspipe.llm.store import ship_package, stored

SIMILARITY = 80  # percent of the shingles, at least

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that have no letter."""
    ship_package(spark)
    return language.drop_unidentified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    ship_package(spark)
    return forest.drop_near_duplicates(docs, SIMILARITY)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold a benchmark item, exactly or edited."""
    ship_package(spark)
    return leaks.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with surrogates for personal data."""
    ship_package(spark)
    return surrogates.replace_entities(docs, SURROGATE_KEY)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences."""
    ship_package(spark)
    return packing.pack_documents(docs, VOCABULARY)


STAGES: list[tuple[str, Stage]] = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("personal_data", replace_personal_data),
    ("packing", pack),
]

# Models, alignment and the tokenizer are beyond SQL; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
