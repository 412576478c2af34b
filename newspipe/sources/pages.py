"""Stored web pages and the addresses of section pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.charsets import page_text
from ..schemas import PAGE


def scan_pages(spark: SparkSession, path: str) -> DataFrame:
    """Table of stored pages, ``page_id, url, html``."""
    return spark.read.schema(PAGE).parquet(path)


def decoded_pages(
    pages: DataFrame, content: str = "content", charset: str | None = None
) -> DataFrame:
    """Pages stored as bytes, with their text as ``html`` in place of the bytes."""
    kept = [c for c in pages.columns if c not in (content, "html")]
    return pages.select(*kept, page_text(F.col(content), charset).alias("html"))


def add_section_urls(bases: DataFrame, base_url: str, pages: Column | int = 2) -> DataFrame:
    """One row ``(…, page, section_url)`` per section page of each base address.

    Page 1 is the base itself, page n is ``base + "page/n/"``. There is always a
    first page, also for ``pages`` below 1.
    """
    pages = pages if isinstance(pages, Column) else F.lit(pages)
    numbers = F.sequence(F.lit(1), F.greatest(pages.cast("int"), F.lit(1)))
    page, base = F.col("page"), F.col(base_url)
    numbered = F.concat(base, F.lit("page/"), page, F.lit("/"))
    return bases.select("*", F.explode(numbers).alias("page")).withColumn(
        "section_url", F.when(page == 1, base).otherwise(numbered)
    )


def section_urls(spark: SparkSession, base_url: str, pages: int = 2) -> DataFrame:
    """``page, section_url`` for one section."""
    base = spark.range(1).select(F.lit(base_url).alias("base"))
    return add_section_urls(base, "base", pages).select("page", "section_url")
