"""Links out of stored listing pages."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions.plan import folded, let
from ..functions.urls import base_url, resolve_href
from ..profiles import ChildChain, ClassTokens

# Block elements also close a paragraph that is still open.
_CLOSED_BY_SIBLING = tuple(f"<{tag}>" for tag in H.CLOSED_BY_SIBLING)
_CLOSING_P = tuple(f"<{tag}>" for tag in H.BLOCK_TAGS)


def _chain_tags(page: Column, names: tuple[str, ...]) -> Column:
    """Open tags at the end of a chain of direct children, in page order.

    Walks the tags once, from the first that can start a chain, keeping the open
    elements, but not what is found, as text such as ``<section><div><article>``. A closing tag cuts that path
    at its last opening.
    """
    void = "|".join(H.VOID_TAGS)
    part = F.regexp_extract(page, rf"(?is)<{re.escape(names[0])}[\s/>].*", 0)
    tokens = F.regexp_extract_all(
        part, F.lit(rf"(?i)<(?!(?:{void})[\s/>])/?[a-z]{H.REST}>"), F.lit(0)
    )
    parents = "".join(f"<{n}>" for n in names[:-1])

    def opened(path: Column, element: Column, closed: Column) -> Column:
        sibling = element.isin(*_CLOSED_BY_SIBLING) & path.endswith(element)
        return (
            F.when(sibling | (element == "<a>"), closed)
            .when(element.isin(*_CLOSING_P), F.regexp_replace(path, "<p>$", ""))
            .otherwise(path)
        )

    def step(path: Column, token: Column) -> tuple[Column, Column]:
        name = F.lower(F.regexp_extract(token, r"^</?([^\s/>]+)", 1))

        def advance(element: Column) -> Column:
            closed = H.cut_path(path, element)
            before = F.when(token.startswith("</"), closed).otherwise(opened(path, element, closed))
            return let(
                before,
                lambda b: F.when(
                    token.startswith("</"), F.struct(b.alias("path"), F.lit(False).alias("hit"))
                ).otherwise(
                    F.struct(
                        F.concat(b, element).alias("path"),
                        ((element == f"<{names[-1]}>") & b.endswith(parents)).alias("hit"),
                    )
                ),
            )

        now = let(F.concat(F.lit("<"), name, F.lit(">")), advance)
        return now["path"], F.when(now["hit"], token)

    return folded(tokens, F.lit(""), step)


def _token_tags(page: Column, tokens: tuple[str, ...]) -> Column:
    """Open tags of any element that carry all the classes, in page order."""
    tags = F.regexp_extract_all(
        page, F.lit(H.attribute_pattern("class", tokens[0], "has")), F.lit(0)
    )

    def all_present(tag: Column) -> Column:
        classes = F.split(H.attribute(tag, "class"), r"\s+")
        return reduce(
            lambda a, b: a & b, [F.array_contains(classes, t) for t in tokens]
        )

    return F.filter(tags, all_present)


def _likely(rule: ChildChain | ClassTokens) -> Column:
    """A cheap look at the raw page before the real one."""
    if isinstance(rule, ChildChain):
        found = [F.col("html").rlike(rf"(?i)<{re.escape(n)}[\s/>]") for n in rule.names[:-1]]
    else:
        found = [F.col("html").contains(t) for t in rule.tokens]
    return reduce(lambda a, b: a & b, found, F.lit(True))


def _hrefs(page: Column, rule: ChildChain | ClassTokens) -> Column:
    tags = _chain_tags(page, rule.names) if isinstance(rule, ChildChain) else _token_tags(page, rule.tokens)
    return F.filter(F.transform(tags, lambda t: H.attribute(t, "href")), lambda h: h != "")


def count_links(rule: ChildChain | ClassTokens) -> Column:
    """How many links ``extract_links`` finds on a page."""
    found = F.size(_hrefs(H.visible(F.col("html")), rule))
    return F.when(_likely(rule), found).otherwise(0)


def extract_links(
    pages: DataFrame, rule: ChildChain | ClassTokens, base: str | None = None
) -> DataFrame:
    """One row ``(…, pos, href)`` per link; all columns of ``pages`` but ``html`` stay.

    Links without or with an empty ``href`` are left out, duplicates are kept, and
    ``pos`` counts the links of a page from 0 in page order. ``base`` names a further
    column for the address that the page's links are relative to.
    """
    kept = [c for c in pages.columns if c != "html"]
    page = F.col("page")
    bases = [base_url(page, F.col("url")).alias(base)] if base else []
    return (
        pages.filter(_likely(rule))
        .select(*kept, H.visible(F.col("html")).alias("page"))
        .select(*kept, *bases, F.posexplode(_hrefs(page, rule)).alias("pos", "href"))
    )


def resolve_links(links: DataFrame, base: str = "url") -> DataFrame:
    """The same links with ``href`` made absolute against the address in ``base``."""
    return links.withColumn("href", resolve_href(F.col("href"), F.col(base)))
