"""The operators as queries over the given tables, with production parameters."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    forest,
    language,
    leaks,
    licences,
    packing,
    page_diff,
    phrases,
    quality,
    slots,
    suffixes,
    surrogates,
    transducer,
    turns,
)
from .store import ship_package

Query = Callable[[SparkSession, str], DataFrame]
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
# Stands for a secret that a real run gets from its own store.
SURROGATE_KEY = "a key for the test tables"
REGISTRY: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(run: Query) -> Query:
    @functools.wraps(run)
    def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return run(spark, sf_dir)

    REGISTRY[run.__name__] = shipped
    return shipped


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_nearest_url_difference(spark, sf_dir):
    """Main text of every page."""
    return page_diff.extract_pages(table(spark, sf_dir, "pages"))


@query
def op2_virtual_slots(spark, sf_dir):
    """Every document's shard among 40, and its place there."""
    return slots.shard_documents(table(spark, sf_dir, "documents"), 40)


@query
def op3_sentence_rules(spark, sf_dir):
    """Known licence sentences and licences of every document."""
    return licences.scan_licences(table(spark, sf_dir, "documents"))


ORACLE["op3_sentence_rules"] = licences.oracle_sql("documents")


@query
def op4_lsh_forest(spark, sf_dir):
    """Component of near-duplicates of every document."""
    return forest.near_duplicates(table(spark, sf_dir, "documents")).drop("__k1", "__k2")


@query
def op5_two_stage_suffixes(spark, sf_dir):
    """What is left of every document without strings of 400 bytes that repeat."""
    found = suffixes.remove_repeats(table(spark, sf_dir, "documents"))
    # A cut may part a character; its bytes show as replacement characters.
    text = F.call_function("make_valid_utf8", F.col("kept").cast("string"))
    return found.withColumn("text", text).drop("kept")


@query
def op6_rare_seeds(spark, sf_dir):
    """Every document that holds a benchmark item, exactly or edited, with the item."""
    return leaks.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op7_weak_supervision(spark, sf_dir):
    """Measures and verdict of every document."""
    return quality.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "posterior",
    )


@query
def op8_vector_packing(spark, sf_dir):
    """Pieces of all documents in sequences of 2048 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), VOCABULARY)


@query
def op9_keyed_surrogates(spark, sf_dir):
    """Every document with surrogates for the personal data found."""
    return surrogates.report(table(spark, sf_dir, "documents"), SURROGATE_KEY)


@query
def op10_byte_network(spark, sf_dir):
    """Language of every document."""
    return language.identify(table(spark, sf_dir, "documents"))


@query
def op11_multikey_phrases(spark, sf_dir):
    """Each language's best collocations."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


@query
def op12_auction_repair(spark, sf_dir):
    """Damaged conversations, their faults and cheapest repair."""
    return turns.repaired(table(spark, sf_dir, "conversations"))


@query
def op13_bounded_lookahead(spark, sf_dir):
    """Tokens of every document, and what they decode to, as digests."""
    return transducer.round_trip(table(spark, sf_dir, "documents"), WORD_VOCABULARY)
