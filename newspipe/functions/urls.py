"""Resolving link targets against the page they stand on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import html as H
from .plan import let

_ORIGIN = r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+)"


def _without_dots(path: Column) -> Column:
    """Drop ``.`` segments and let each ``..`` remove the segment before it."""

    def step(kept: Column, part: Column) -> Column:
        up = F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(1)))
        return F.when(part == "..", up).when(part == ".", kept).otherwise(
            F.concat(kept, F.array(part))
        )

    def finish(kept: Column) -> Column:
        # A path that ends in a dot segment names a directory.
        closed = F.when(path.rlike(r"/\.\.?\z"), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
        return F.array_join(closed, "/")

    parts = F.split(path, "/")
    reduced = F.aggregate(F.slice(parts, 2, F.size(parts)), F.slice(parts, 1, 1), step, finish)
    return F.when(path.rlike(r"/\.\.?(?:/|\z)"), reduced).otherwise(path)


def resolve_href(href: Column, page_url: Column) -> Column:
    """Absolute form of ``href`` as a browser on ``page_url`` would report it.

    For a page that sets a base, ``page_url`` is that base, see ``base_url``.
    """
    origin = F.regexp_extract(page_url, _ORIGIN, 1)
    scheme = F.regexp_extract(page_url, r"^([a-zA-Z][a-zA-Z0-9+.-]*):", 1)
    query = F.regexp_extract(page_url, r"^[^?#]*(\?[^#]*)?", 1)
    path = F.regexp_replace(F.regexp_extract(page_url, r"^([^?#]*)", 1), _ORIGIN, "")
    path = F.when(path == "", "/").otherwise(path)
    directory = F.regexp_extract(path, r"^(.*/)", 1)

    def rooted(target: Column) -> Column:
        split = let(
            target,
            lambda t: F.concat(
                _without_dots(F.regexp_extract(t, r"^([^?#]*)", 1)),
                F.regexp_extract(t, r"^[^?#]*(.*)", 1),
            ),
        )
        return F.concat(origin, split)

    return let(
        F.regexp_replace(href, r"\A\s+|\s+\z", ""),
        lambda h: F.when(h.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), h)
        .when(h.startswith("//"), F.concat(scheme, F.lit(":"), h))
        .when(h.startswith("/"), rooted(h))
        .when(h == "", F.concat(origin, path, query))
        .when(h.startswith("?"), F.concat(origin, path, h))
        .when(h.startswith("#"), F.concat(origin, path, query, h))
        .otherwise(rooted(F.concat(directory, h))),
    )


def base_url(page: Column, page_url: Column) -> Column:
    """What relative links of a page refer to: its first ``<base href>``, or its own address.

    The base may itself be relative to the page's address. Bases without ``href`` are passed
    over, and so is one that holds data or script, as nothing can be relative to it.
    """
    tags = F.regexp_extract_all(page, F.lit(H.tag_pattern("base")), F.lit(0))
    hrefs = F.filter(F.transform(tags, lambda t: H.attribute(t, "href")), lambda h: h.isNotNull())

    def usable(href: Column) -> Column:
        return F.when(href.isNotNull() & ~href.rlike(r"(?i)^\s*(?:data|javascript):"), resolve_href(href, page_url))

    found = let(F.try_element_at(hrefs, F.lit(1)), usable)
    return F.coalesce(F.when(page.rlike(rf"(?i)<base{H.STOP}"), found), page_url)
