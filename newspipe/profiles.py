"""Site profiles: what to look for on the pages of one kind of site."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class LenientProfile:
    """Fields may be missing; only a page without headline is dropped."""

    # What the pages of this kind of site use.
    headline_tag: str = "h1"
    author_class_part: str = "author"
    published_property: str = "article:published_time"
    container: str = "article"
    joiner: str = "\n"


@dataclass(frozen=True)
class StrictProfile:
    """Headline, time and content are required; the first wrapper present counts."""

    headline_tag: str = "h1"
    time_tag: str = "time"
    time_attribute: str = "datetime"
    # Content wrappers in order of preference.
    wrapper_classes: tuple[str, ...] = (
        "dable-content-wrapper",
        "entry-content",
        "article-content",
    )
    joiner: str = " "


@dataclass(frozen=True)
class ChildChain:
    """Links that are the last step of a chain of direct children."""

    names: tuple[str, ...] = ("section", "article", "a")


@dataclass(frozen=True)
class ClassTokens:
    """Links on elements that carry all of these classes."""

    # The classes of a teaser link.
    tokens: tuple[str, ...] = (
        "penci-link-post",
        "penci-image-holder",
        "penci-disable-lazy",
    )


LENIENT = LenientProfile()
STRICT = StrictProfile()
CHILD_CHAIN = ChildChain()
CLASS_TOKENS = ClassTokens()
