"""Articles out of stored pages.

Plan shape: scan, one cheap filter on the raw page, one projection. Nothing here
shuffles and nothing runs in a Python worker.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions.plan import computed_once, let
from ..profiles import LENIENT, STRICT, LenientProfile, StrictProfile


def visible_pages(pages: DataFrame) -> DataFrame:
    """``url, page``: what the rules look at."""
    page = let(H.visible(F.col("html")), H.shown)
    return computed_once(pages, F.col("url"), page.alias("page"))


def _mentions(pages: DataFrame, *tags: str) -> DataFrame:
    """Pages whose raw text has all of these tags; a cheap look before the real one."""
    for tag in tags:
        pages = pages.filter(F.col("html").rlike(rf"(?i)<{re.escape(tag)}[\s/>]"))
    return pages


def _has(tag: str) -> Column:
    return F.col("page").rlike(H.tag_pattern(tag))


def _headline_html(tag: str) -> Column:
    return F.regexp_extract("page", rf"{H.tag_pattern(tag)}(.*?)(?:</{re.escape(tag)}\s*>|\z)", 2)


def is_lenient(profile: LenientProfile = LENIENT) -> Column:
    """Whether ``extract_lenient`` gives a row for a visible page."""
    return _has(profile.headline_tag)


def is_strict(profile: StrictProfile = STRICT) -> Column:
    """Whether ``extract_strict`` gives a row for a visible page."""
    content = _joined(H.marked_texts(_wrapper(profile))[0], profile)
    return _has(profile.headline_tag) & _has(profile.time_tag) & (content != "")


def extract_lenient(pages: DataFrame, profile: LenientProfile = LENIENT) -> DataFrame:
    """``url, headline, author, publish_time, article_content`` of each page.

    A page without headline element gives no row. Author and time are null where the
    page has none. The content joins the non-empty paragraphs inside any container
    and may be ``''``; such rows stay.
    """
    page, texts = F.col("page"), F.col("texts")
    author = H.attribute_pattern("class", profile.author_class_part, "contains")
    published = H.attribute_pattern("property", profile.published_property)
    found = visible_pages(_mentions(pages, profile.headline_tag)).filter(_has(profile.headline_tag))
    parts = found.select(
        "url",
        "page",
        H.inner_html(page, author, profile.author_class_part).alias("author"),
    ).select(
        "url",
        "page",
        F.col("author").isNotNull().alias("has_author"),
        H.marked_texts(
            _headline_html(profile.headline_tag),
            F.col("author"),
            H.inside_all(page, profile.container),
        ).alias("texts"),
    )
    content = F.filter(H.paragraphs_of(texts[2]), lambda t: t != "")
    return parts.select(
        "url",
        H.lines_of(texts[0]).alias("headline"),
        F.when(F.col("has_author"), H.lines_of(texts[1])).alias("author"),
        F.when(
            page.contains(profile.published_property),
            H.attribute(H.first_tag(page, published), "content"),
        ).alias("publish_time"),
        F.array_join(content, profile.joiner).alias("article_content"),
    )


def _wrapper(profile: StrictProfile) -> Column:
    """Inner HTML of the first wrapper class present, even if another holds more.

    Null if no wrapper is present.
    """
    patterns = {name: H.attribute_pattern("class", name, "has") for name in profile.wrapper_classes}
    return F.coalesce(*[H.inner_html(F.col("page"), p, name) for name, p in patterns.items()])


def _joined(marked: Column, profile: StrictProfile) -> Column:
    return F.array_join(H.paragraphs_of(marked), profile.joiner).alias("article_content")


def extract_strict(pages: DataFrame, profile: StrictProfile = STRICT) -> DataFrame:
    """``url, headline, date_published, article_content`` of each complete page.

    Dropped: no headline, no time element, no known wrapper, or empty content. A time
    element without date attribute stays with a null date. Empty paragraphs take part
    in the join, so two of them give a single space, which counts as content.
    """
    tags = profile.headline_tag, profile.time_tag
    found = visible_pages(_mentions(pages, *tags)).filter(_has(tags[0]) & _has(tags[1]))
    texts = H.marked_texts(_headline_html(profile.headline_tag), _wrapper(profile))
    full = computed_once(
        found.select("url", "page", texts.alias("texts")),
        F.col("url"),
        H.first_tag(F.col("page"), H.tag_pattern(profile.time_tag)).alias("time"),
        F.col("texts")[0].alias("headline"),
        _joined(F.col("texts")[1], profile),
    )
    return full.filter("article_content <> ''").select(
        "url",
        H.lines_of(F.col("headline")).alias("headline"),
        H.attribute(F.col("time"), profile.time_attribute).alias("date_published"),
        "article_content",
    )


def extract_rejects(pages: DataFrame, profile: StrictProfile = STRICT) -> DataFrame:
    """``url, reason`` of each page that ``extract_strict`` leaves out.

    The reason is the first that applies: ``no_h1``, ``no_time``, ``no_content``. A
    missing page counts as an empty one.
    """
    content = _joined(H.marked_texts(_wrapper(profile))[0], profile)
    reason = (
        F.when(F.col("page").isNull() | ~_has(profile.headline_tag), "no_h1")
        .when(~_has(profile.time_tag), "no_time")
        .when(content == "", "no_content")
    )
    found = computed_once(visible_pages(pages), F.col("url"), reason.alias("reason"))
    return found.filter("reason is not null")


def judge_strict(pages: DataFrame, profile: StrictProfile = STRICT) -> DataFrame:
    """Every page once: the columns of ``extract_strict``, or the ``reason`` it is left out.

    What ``extract_strict`` and ``extract_rejects`` give together, from one extraction.
    """
    page = F.col("page")
    read = computed_once(
        visible_pages(pages),
        F.col("url"),
        (page.isNotNull() & _has(profile.headline_tag)).alias("has_headline"),
        H.first_tag(page, H.tag_pattern(profile.time_tag)).alias("time"),
        H.marked_texts(_headline_html(profile.headline_tag), _wrapper(profile)).alias("texts"),
    )
    full = computed_once(
        read,
        *[F.col(c) for c in ("url", "has_headline", "time", "texts")],
        _joined(F.col("texts")[1], profile),
    )
    reason = (
        F.when(~F.coalesce("has_headline", F.lit(False)), "no_h1")
        .when(F.col("time") == "", "no_time")
        .when(F.col("article_content") == "", "no_content")
    )
    fields = {
        "headline": H.lines_of(F.col("texts")[0]),
        "date_published": H.attribute(F.col("time"), profile.time_attribute),
        "article_content": F.col("article_content"),
    }
    judged = full.withColumn("reason", reason)
    kept = F.col("reason").isNull()
    return judged.select("url", *[F.when(kept, c).alias(n) for n, c in fields.items()], "reason")
