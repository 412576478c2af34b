"""The flows a user runs, wired from the operators."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BinaryType, DataType, StructField, StructType

from ..operators.analyze import count_rows, key_union, sample
from ..operators.articles import extract_lenient, extract_strict
from ..operators.links import extract_links, resolve_links
from ..operators.messages import (
    PUBLISH_QUERY,
    filter_news,
    from_wire,
    judged_wire,
    limit_messages,
    project_news,
    to_wire,
)
from ..operators.normalize import flatten_raw
from ..profiles import CHILD_CHAIN, CLASS_TOKENS
from ..schemas import LENIENT_ARTICLE, NEWS_SOURCE_ITEM, STRICT_ARTICLE, STRICT_CSV_NAMES
from ..sinks.csv import stream_csv, write_csv, write_raw_csv
from ..sinks.kafka import stream_kafka
from ..sources.kafka import read_kafka
from ..sources.responses import explode_results, landed_pages, read_api_pages
from ..streaming.appends import Appender, Budget, budgeted_stream
from ..streaming.runs import stream_judged, stream_parquet, stream_table

T = TypeVar("T")


def collect_links(listings: DataFrame, strict: bool = False) -> DataFrame:
    """Absolute article addresses found on listing pages, which may set a base."""
    rule, base = CLASS_TOKENS if strict else CHILD_CHAIN, "__base"
    return resolve_links(extract_links(listings, rule, base), base).drop(base)


def articles_to_csv(
    pages: DataFrame,
    path: str,
    strict: bool = False,
    max_records_per_file: int | None = None,
    max_bytes_per_file: int | None = None,
) -> None:
    """Stored article pages to CSV files."""
    if strict:
        articles, columns, rename = extract_strict(pages), STRICT_ARTICLE.names, STRICT_CSV_NAMES
    else:
        articles, columns, rename = extract_lenient(pages), LENIENT_ARTICLE.names, None
    write_csv(
        articles,
        path,
        columns,
        rename=rename,
        max_records_per_file=max_records_per_file,
        max_bytes_per_file=max_bytes_per_file,
    )


def publish_articles(
    pages: DataFrame, send: Callable[[DataFrame], T], strict: bool = False
) -> T:
    """Pages, a batch or a stream, to article messages.

    ``send`` takes the frame of ``value`` to its sink, see ``to_table`` and ``to_kafka``.
    """
    articles = extract_strict(pages) if strict else extract_lenient(pages)
    return send(to_wire(articles))


def to_table(
    topic: str, checkpoint: str, trigger: dict | None = None
) -> Callable[[DataFrame], StreamingQuery]:
    """Sends a stream of messages to a topic kept as a table of ``value``."""
    return lambda wire: stream_parquet(wire, topic, checkpoint, trigger)


def to_kafka(
    servers: str, topic: str, checkpoint: str, trigger: dict | None = None
) -> Callable[[DataFrame], StreamingQuery]:
    """Sends a stream of messages to a Kafka topic."""
    return lambda wire: stream_kafka(wire, servers, topic, checkpoint, trigger)


def read_topic(spark: SparkSession, topic: str, max_bytes: int | None = None) -> DataFrame:
    """The messages of a topic kept as a table, as a stream in steps of ``max_bytes``."""
    return stream_table(spark, topic, StructType([StructField("value", BinaryType())]), max_bytes)


def consume_to_csv(
    wire: DataFrame,
    schema: StructType,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    max_records_per_file: int | None = None,
) -> StreamingQuery:
    """A stream of messages to CSV files; unreadable messages are left out.

    A step writes a file for each of its tasks at most, so that the bound on what a step
    reads, set at the source, bounds the files too.
    """
    return stream_csv(
        from_wire(wire, schema), path, checkpoint, schema.names, trigger, max_records_per_file
    )


def consume_topic_to_csv(
    spark: SparkSession,
    servers: str,
    topic: str,
    schema: StructType,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    max_records_per_file: int | None = None,
    **settings,
) -> StreamingQuery:
    """A Kafka topic, from its earliest message on, to CSV files."""
    wire = read_kafka(spark, servers, topic, **settings)
    return consume_to_csv(wire, schema, path, checkpoint, trigger, max_records_per_file)


def publish_continuously(
    spark: SparkSession,
    landing: str,
    send: Callable[[DataFrame], T],
    item: DataType = NEWS_SOURCE_ITEM,
    max_messages: int | None = None,
    max_files: int | None = None,
    **asked: str,
) -> T:
    """Responses as they land, to messages of the items that fit the publisher's question.

    ``asked`` overrides parts of ``PUBLISH_QUERY``; ``max_files`` bounds a step.
    """
    options = {"maxFilesPerTrigger": max_files} if max_files else {}
    pages = landed_pages(spark, landing, item, stream=True, **options)
    items = filter_news(explode_results(pages), **(PUBLISH_QUERY | asked))
    return publish_news(items, send, max_messages)


def news_messages(items: DataFrame, max_messages: int | None = None) -> DataFrame:
    """API items as messages ready to send; batch input keeps its arrival order."""
    order = () if items.isStreaming else ("fetch_seq", "pos")
    return to_wire(project_news(limit_messages(items, max_messages, order)))


def publish_news(
    items: DataFrame, send: Callable[[DataFrame], T], max_messages: int | None = None
) -> T:
    """Send API items as messages; ``send`` takes the frame of ``value`` to its sink."""
    return send(news_messages(items, max_messages))


def publish_budgeted(
    items: DataFrame,
    topic: str,
    ledger: str,
    max_messages: int,
    checkpoint: str,
    trigger: dict | None = None,
    run: str = "run",
) -> StreamingQuery:
    """A stream of API items to a topic kept as a table, exactly ``max_messages`` in all.

    The budget holds over all steps, restarts and later runs that share the ledger; 0 is no
    bound. Wait for it with ``finish_budget``.
    """

    def send(rows: DataFrame, path: str) -> None:
        to_wire(project_news(rows)).write.mode("overwrite").parquet(path)

    budget = Budget(ledger, max_messages, Appender(topic, send, run), ("fetch_seq", "pos"), run)
    return budgeted_stream(items, budget, checkpoint, trigger)


def consume_judged(
    wire: DataFrame, schema: StructType, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """A stream of messages to a table that holds records and rejects apart, from one parse.

    ``read_judged(spark, path, "readable", True)`` gives the records.
    """
    return stream_judged(judged_wire(wire, schema), "readable", path, checkpoint, trigger)


def append_news(
    messages: DataFrame,
    path: str | None,
    max_records_per_file: int | None = None,
    max_bytes_per_file: int | None = None,
) -> None:
    """Add messages to a folder of CSV files, the last incomplete batch included."""
    write_csv(
        messages,
        path,
        mode="append",
        max_records_per_file=max_records_per_file,
        max_bytes_per_file=max_bytes_per_file,
    )


@dataclass
class FetchReport:
    """What a batch fetch prints, as lazy tables."""

    total: DataFrame
    first: DataFrame
    keys: DataFrame


def fetch_report(pages: DataFrame, count: int = 5) -> FetchReport:
    """Total, first items and key set of the raw items of a batch fetch."""
    items = read_api_pages(pages)
    return FetchReport(count_rows(items), sample(items, count), key_union(items, "raw"))


def fetch_to_csv(pages: DataFrame, path: str, max_keys: int | None = None, **bounds) -> list[str]:
    """Raw items of a batch fetch to CSV under the union of their keys.

    ``bounds`` are those of the files.
    """
    return write_raw_csv(read_api_pages(pages), "raw", path, max_keys=max_keys, **bounds)


def typed_news(pages: DataFrame) -> DataFrame:
    """Raw items of a batch fetch as the typed table."""
    return flatten_raw(read_api_pages(pages), "raw")
