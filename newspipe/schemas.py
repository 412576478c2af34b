"""Record layouts. All fields are nullable text unless noted."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def text_fields(*names: str) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


PAGE = StructType([StructField("page_id", LongType()), *text_fields("url", "html").fields])

# Column names and their order in the outputs.
LENIENT_ARTICLE = text_fields("url", "headline", "author", "publish_time", "article_content")
STRICT_ARTICLE = text_fields("url", "headline", "date_published", "article_content")
NEWS_MESSAGE = StructType(
    [
        *text_fields("title", "content", "pubDate", "link").fields,
        StructField("category", ArrayType(StringType())),
    ]
)
NEWS_ITEM = StructType(
    [
        *text_fields(
            "article_id", "title", "link", "keywords", "creator", "video_url",
            "description", "content", "pubDate", "pubDateTZ", "image_url", "source_id",
            "source_priority", "source_name", "source_url", "source_icon", "language",
            "country", "category", "ai_tag", "sentiment", "sentiment_stats", "ai_region",
            "ai_org",
        ).fields,
        StructField("duplicate", BooleanType()),
    ]
)

# What a publisher needs of an API item as it was landed.
NEWS_SOURCE_ITEM = StructType(
    [
        *text_fields("title", "description", "pubDate", "link", "language").fields,
        StructField("category", ArrayType(StringType())),
        StructField("country", ArrayType(StringType())),
    ]
)

# The batch CSV of the strict site spells its date column with spaces.
STRICT_CSV_NAMES = {"date_published": "date of published"}


def api_page(item) -> StructType:
    """One landed API response; ``item`` is the type of a result."""
    return StructType(
        [
            StructField("fetch_seq", LongType()),
            StructField("error", BooleanType()),
            StructField("results", ArrayType(item)),
            StructField("nextPage", StringType()),
        ]
    )
