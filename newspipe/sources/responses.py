"""Landed responses of a cursor-paginated API.

A response is ``fetch_seq, error, results, nextPage``; ``results`` holds structs or
raw JSON text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

from ..functions.plan import computed_once
from ..operators.messages import filter_news
from ..schemas import api_page
from .cursors import ordered_by_cursor


def landed_pages(
    spark: SparkSession, path: str, item: DataType | None = None, stream: bool = False, **options
) -> DataFrame:
    """Responses landed as JSON lines; without ``item`` each result stays raw JSON."""
    reader = spark.readStream if stream else spark.read
    return reader.schema(api_page(item or StringType())).options(**options).json(path)


def landed_items(spark: SparkSession, path: str, **options) -> DataFrame:
    """Items landed as JSON lines under the columns that their keys give.

    Types are inferred, which reads the files once more; a ``samplingRatio`` among the
    options makes that cheaper, at the risk of missing rare keys.
    """
    return spark.read.options(**options).json(path)


def explode_results(pages: DataFrame) -> DataFrame:
    """One row ``(fetch_seq, pos, item fields…)`` per result; no results, no rows."""
    results = F.coalesce(F.col("results"), F.array())
    items = pages.select("fetch_seq", F.posexplode(results).alias("pos", "item"))
    element = pages.schema["results"].dataType
    if isinstance(element, ArrayType) and isinstance(element.elementType, StructType):
        return items.select("fetch_seq", "pos", "item.*")
    return items.select("fetch_seq", "pos", F.col("item").alias("raw"))


def collected_pages(pages: DataFrame) -> DataFrame:
    """The responses a fetch loop collects: up to the first page without a next one.

    A failed page ends the loop too; what came before it is kept. A page without error
    flag has not failed. The end is found by a one-row aggregate over the narrow columns
    and enters the filter as a scalar subquery, so there is no join. A landed line that is
    no JSON has no place in the order; it neither ends the loop nor gives items. Responses
    without ``fetch_seq`` are put in the order of their cursors first.
    """
    if "fetch_seq" not in pages.columns:
        pages = ordered_by_cursor(pages)
    failed = F.coalesce(F.col("error"), F.lit(False))
    last = failed | (F.coalesce(F.col("nextPage"), F.lit("")) == "")
    ends = pages.filter(last).agg(F.min("fetch_seq"))
    stop = F.coalesce(ends.scalar(), F.lit(2**63 - 1))
    return pages.filter((F.col("fetch_seq") <= stop) & ~failed)


def read_api_pages(
    pages: DataFrame,
    country: str | None = None,
    category: str | None = None,
    language: str | None = None,
) -> DataFrame:
    """All items a batch fetch returns, duplicates kept, with their arrival order.

    The values are what the API was asked for. Responses that were landed with the same
    question fit already and need none; raw items are looked into if there are any.
    """
    items = explode_results(collected_pages(pages))
    wanted = {"country": country, "category": category, "language": language}
    if "raw" in items.columns and any(v is not None for v in wanted.values()):
        fields = "country array<string>, category array<string>, language string"
        opened = computed_once(
            items, *[F.col(c) for c in items.columns], F.from_json("raw", fields).alias("fields")
        )
        found = filter_news(opened.select(*items.columns, "fields.*"), **wanted)
        return found.select(*items.columns)
    return filter_news(items, **wanted)
