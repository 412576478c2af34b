"""Reading text and attributes out of stored HTML with native column expressions.

Every function takes and returns a Column, so extraction runs inside the JVM on
batch and streaming frames alike. Repeated groups in the patterns are possessive:
Java runs those in a loop, so a page with thousands of tags cannot overflow the
stack or backtrack exponentially.

Approximations, against a real browser: of CSS only what a tag itself says about display
and visibility is applied, and optional closing tags are only inferred where noted below.
"""

from __future__ import annotations

import re
from html.entities import html5, name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from .plan import folded, let

# While a text is cut up, a tag that matters is written as OPEN + name + CLOSE, and
# NEXT parts one piece from another. HIDDEN stands before a tag that shows nothing. Pages are
# cleared of these characters first.
OPEN = "\u0001"
CLOSE = "\u0002"
NEXT = "\u0003"
HIDDEN = "\u0004"

# Elements that HTML renders on lines of their own, and elements
# that never have content.
BLOCK_TAGS = (
    "address", "article", "aside", "blockquote", "dd", "details", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5",
    "h6", "header", "hr", "li", "main", "menu", "nav", "ol", "pre", "section", "table",
    "td", "th", "tr", "ul",
)
VOID_TAGS = (
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
    "source", "track", "wbr",
)

# No tag reaches from one piece into the next.
_VALUE = rf"""(?:"[^"{NEXT}]*"|'[^'{NEXT}]*'|[^\s"'>{NEXT}][^\s>{NEXT}]*)"""
REST = rf"(?:[^>={NEXT}]++|=\s*{_VALUE}|=)*+"  # up to the end of an open tag
_ATTR = rf"[^\s=>/]++(?:\s*=\s*{_VALUE})?+"
STOP = r"(?=[\s/>])"

# Elements with optional closing tags and the tags that end them.
_ENDED_BY = {
    "p": rf"(?i)<(?:/?(?:{'|'.join((*BLOCK_TAGS, 'p'))}|/body|/html)){STOP}",
    "li": rf"(?i)<(?:li|/(?:li|ul|ol|menu)){STOP}",
    "dt dd": rf"(?i)<(?:d[td]|/(?:d[tdl])){STOP}",
    "td th": rf"(?i)<(?:t[dhr]|tbody|tfoot|/(?:t[dhr]|table|thead|tbody|tfoot)){STOP}",
    "tr": rf"(?i)<(?:tr|tbody|tfoot|/(?:tr|table|thead|tbody|tfoot)){STOP}",
    "option": rf"(?i)<(?:option|optgroup|/(?:option|optgroup|select)){STOP}",
}

_UNSEEN = (
    r"(?is)<(?=[!sSnNtT])(?:!--(?:[^-]++|-(?!->))*+(?:-->)?+"
    rf"|(script|style|noscript|template|title){STOP}[^<]*+(?:<(?!/\1\s*>)[^<]*+)*+(?:</\1\s*>)?+)"
)
_TAG = rf"(?i)<(?:(p|br|/?(?:p|{'|'.join(BLOCK_TAGS)})){STOP}|/?[a-z]|[!?]){REST}>"
_EDGE = f"{OPEN}[^{CLOSE}]*{CLOSE}"
# Hidden tags still end paragraphs, and paragraphs without text count; only breaks do not.
_HIDDEN_BREAK = rf"(?i){HIDDEN}<br{STOP}{REST}>"
_HIDDEN_EDGE = f"{HIDDEN}{_EDGE}"


def _without(text: Column, *literals: str, put: str = "") -> Column:
    for literal in literals:
        text = F.replace(text, F.lit(literal), F.lit(put))
    return text


def _rarely(text: Column, *literals: str, put: str) -> Column:
    """As ``_without``, for literals most texts lack: looking is cheaper than replacing."""

    def guarded(literal: str):
        return lambda t: F.when(t.contains(literal), _without(t, literal, put=put)).otherwise(t)

    for literal in literals:
        text = let(text, guarded(literal))
    return text


def visible(html: Column) -> Column:
    """The page without comments, scripts and styles (and without our own marks)."""
    marked = html.rlike(f"[{OPEN}{CLOSE}{NEXT}{HIDDEN}]")
    clean = F.when(marked, _without(html, OPEN, CLOSE, NEXT, HIDDEN)).otherwise(html)
    return F.regexp_replace(clean, _UNSEEN, "")


# --- hidden elements --------------------------------------------------------

# Elements that the next one of their name closes.
CLOSED_BY_SIBLING = ("p", "li", "dt", "dd", "tr", "td", "th", "option")
_HIDES = r"(?i)<[a-z][^<>]*(?:\shidden|display\s*:|visibility\s*:)"
_MARKUP = rf"(?is)</?[a-z]{REST}>|<[!?/][^>]*>|<|[^<]+"
# In a path of open elements, what one says about itself: not rendered, invisible, visible.
_GONE, _UNSEEABLE, _SEEABLE = "!", "~", "+"


def cut_path(path: Column, element: Column) -> Column:
    """A path of open elements up to the last opening of this one; unchanged if it is not open."""
    after = F.call_function("substring_index", path, element, F.lit(-1))
    size = F.length(path) - F.length(after) - F.length(element)
    return F.when(F.contains(path, element), F.left(path, size)).otherwise(path)


def _declared(style: Column, name: str, values: str) -> Column:
    """What a style attribute says about a property last, important ones before others."""
    one = rf"(?is)^(?:.*;)?\s*{name}\s*:\s*({values})\s*"
    urgent = F.regexp_extract(style, one + r"!\s*important\s*(?:;.*)?$", 1)
    return F.lower(F.when(urgent != "", urgent).otherwise(F.regexp_extract(style, one + r"(?:;.*)?$", 1)))


def _flags(tag: Column) -> Column:
    """What an open tag says about showing itself; an own display overrides ``hidden``."""

    def told(style: Column) -> Column:
        display = _declared(style, "display", r"[a-z-]+(?:\s+[a-z-]+)*")
        visibility = _declared(style, "visibility", "visible|hidden|collapse")
        gone = (display == "none") | ((display == "") & written_attribute(tag, "hidden").isNotNull())
        return F.concat(
            F.when(gone, _GONE).otherwise(""),
            F.when(visibility == "", "").when(visibility == "visible", _SEEABLE).otherwise(_UNSEEABLE),
        )

    # Few tags say anything, and looking is cheaper than reading attributes.
    return F.when(tag.rlike(_HIDES), let(F.coalesce(written_attribute(tag, "style"), F.lit("")), told)).otherwise("")


def shown(page: Column) -> Column:
    """The page with no text in hidden elements, their tags marked as hidden.

    Walks the tags once, keeping the path of open elements as text such as ``<div><p>!``. An
    element that is not rendered shows neither text nor breaks; an invisible one keeps its
    breaks, and descendants may be visible again. Tags stay, as an element that is looked
    up may be hidden; its text is empty then. Pages without any such mark are not walked.
    """
    void = F.array(*map(F.lit, VOID_TAGS))
    siblings = F.array(*map(F.lit, CLOSED_BY_SIBLING))
    blocks = F.array(*map(F.lit, BLOCK_TAGS))

    def hides(path: Column) -> Column:
        return path.contains(_GONE)

    def invisible(path: Column) -> Column:
        last = F.regexp_extract(path, rf"([{_UNSEEABLE}{_SEEABLE}])[^{_UNSEEABLE}{_SEEABLE}]*$", 1)
        return hides(path) | (last == _UNSEEABLE)

    def marked(token: Column, hidden: Column) -> Column:
        return F.when(hidden, F.concat(F.lit(HIDDEN), token)).otherwise(token)

    def closing(path: Column, name: Column, token: Column) -> Column:
        element = F.concat(F.lit("<"), name, F.lit(">"))

        def closed(rest: Column) -> Column:
            # The tag is hidden if the element it closes was.
            gone = F.substring(path, F.length(rest) + 1, F.lit(_MAX))
            own = F.regexp_extract(gone, rf"^<[^>]*>{_GONE}", 0) != ""
            hidden = F.when(rest == path, hides(path)).otherwise(hides(rest) | own)
            return F.struct(rest.alias("path"), marked(token, hidden).alias("put"))

        return let(cut_path(path, element), closed)

    def opening(path: Column, name: Column, token: Column) -> Column:
        element = F.concat(F.lit("<"), name, F.lit(">"))
        last = F.regexp_extract(path, rf"<([^<>]*)>[{_GONE}{_UNSEEABLE}{_SEEABLE}]*$", 1)
        before = (
            F.when(((last == name) & F.array_contains(siblings, name)) | (name == "a"), cut_path(path, element))
            .when((name == "p") | F.array_contains(blocks, name), cut_path(path, F.lit("<p>")))
            .otherwise(path)
        )

        def opened(rest: Column) -> Column:
            def told(own: Column) -> Column:
                hidden = hides(rest) | own.contains(_GONE)
                inner = F.when(F.array_contains(void, name), rest).otherwise(F.concat(rest, element, own))
                return F.struct(inner.alias("path"), marked(token, hidden).alias("put"))

            return let(_flags(token), told)

        return let(before, opened)

    def step(path: Column, token: Column) -> tuple[Column, Column]:
        name = F.lower(F.regexp_extract(token, r"^</?([a-zA-Z][^\s/>]*)", 1))

        def by_kind(n: Column) -> Column:
            return (
                F.when(n == "", F.struct(path.alias("path"), F.when(~invisible(path), token).alias("put")))
                .when(token.startswith("</"), closing(path, n, token))
                .otherwise(opening(path, n, token))
            )

        now = let(name, by_kind)
        return now["path"], now["put"]

    tokens = F.regexp_extract_all(page, F.lit(_MARKUP), F.lit(0))
    walked = F.array_join(folded(tokens, F.lit(""), step), "")
    return F.when(page.rlike(_HIDES), walked).otherwise(page)


# --- entities ---------------------------------------------------------------

# Frequent references come first, as the lookup goes through them in order.
_NAMED = {
    "amp": "&", "nbsp": "\u00a0", "#8217": "’", "quot": '"', "#39": "'", "#039": "'", "lt": "<",
    "gt": ">", "#8220": "“", "#8221": "”", "#8216": "‘", "#8211": "–", "#8230": "…", "apos": "'",
}
_OLD = {name: chr(code) for name, code in name2codepoint.items()}
_NEW = {name[:-1]: text for name, text in html5.items() if name.endswith(";")}
_NAMED = _NAMED | {name: text for name, text in (_OLD | _NEW).items() if name not in _NAMED}
# One literal, which the optimizer folds into a map.
_NAMED_TEXT = NEXT.join(f"{name}={text}" for name, text in _NAMED.items())
_LEGACY = {name: html5[name] for name in html5 if not name.endswith(";")}
_LEGACY_TEXT = NEXT.join(f"{name}={text}" for name, text in _LEGACY.items())
_LEGACY_NAME = rf"^(?:{'|'.join(sorted(_LEGACY, key=lambda n: (-len(n), n)))})"
_NUMBER = r"^#(?:0*([0-9]+)|[xX]0*([0-9a-fA-F]+));?"
_MAX = 2**31 - 1
# Code points 128-159 stand for the windows-1252 characters in HTML.
_C1 = "".join(chr(c) for c in range(128, 160))
_C1_SHOWN = "".join(bytes([c]).decode("cp1252", "ignore") or chr(c) for c in range(128, 160))


def _character(code: Column) -> Column:
    """The character of a code point; control characters show nothing, illegal ones U+FFFD."""
    legal = code.between(32, 0xD7FF) | code.between(0xE000, 0x10FFFF) | code.isin(9, 10, 12, 13)
    char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return (
        F.when(legal, F.translate(char, _C1, _C1_SHOWN))
        .when(code.between(1, 31), "")
        .otherwise("\ufffd")
    )


def decode_entities(text: Column, in_attribute: bool = False) -> Column:
    """Decode character references in one pass, so ``&amp;lt;`` gives ``&lt;``.

    Old names such as ``&copy`` also count without a semicolon, though not inside
    attribute values, where ``?a=1&copy=2`` has to stay as it is.
    """

    def table(pairs: str) -> Column:
        return F.str_to_map(F.lit(pairs), F.lit(NEXT), F.lit("="))

    def rest(part: Column, used: Column) -> Column:
        return F.substring(part, used + 1, F.lit(_MAX))

    def known(part: Column) -> Column:
        """References that the table lists, which is nearly all there are."""
        return let(
            F.substring_index(F.left(part, F.lit(33)), ";", 1),
            lambda name: F.concat(
                F.try_element_at(table(_NAMED_TEXT), name), rest(part, F.length(name) + 1)
            ),
        )

    def number(part: Column) -> Column:
        decimal, hexadecimal = F.regexp_extract(part, _NUMBER, 1), F.regexp_extract(part, _NUMBER, 2)
        # No code point takes more digits than this.
        code = F.when(F.length(decimal) + F.length(hexadecimal) > 7, F.lit(-1)).otherwise(
            F.when(hexadecimal != "", F.conv(hexadecimal, 16, 10)).otherwise(decimal).cast("bigint")
        )
        used = F.length(F.regexp_extract(part, _NUMBER, 0))
        return let(code, lambda c: F.concat(_character(c), rest(part, used)))

    def legacy(part: Column) -> Column:
        return let(
            F.regexp_extract(part, _LEGACY_NAME, 0),
            lambda name: F.concat(
                F.try_element_at(table(_LEGACY_TEXT), name), rest(part, F.length(name))
            ),
        )

    def piece(part: Column, i: Column) -> Column:
        forms = [known(part), F.when(part.rlike(_NUMBER), number(part))]
        if not in_attribute:
            forms.append(legacy(part))
        return F.when(i == 0, part).otherwise(
            F.coalesce(*forms, F.concat(F.lit("&"), part))
        )

    return let(
        text,
        lambda t: F.when(
            t.contains("&"), F.array_join(F.transform(F.split(t, "&"), piece), "")
        ).otherwise(t),
    )


# --- text -------------------------------------------------------------------


def _marked(html: Column) -> Column:
    """The text with breaks as newlines, blocks and paragraphs as marks, no other tags.

    Tags are rewritten in one pass over the whole piece.
    """
    flat = _rarely(_without(html, "\n", put=" "), "\t", "\r", "\f", put=" ")
    flat = let(
        flat,
        lambda t: F.when(t.contains(HIDDEN), F.regexp_replace(t, _HIDDEN_BREAK, "")).otherwise(t),
    )
    flat = _without(F.regexp_replace(flat, _TAG, f"{OPEN}$1{CLOSE}"), OPEN + CLOSE)
    breaks = [f"{OPEN}{name}{CLOSE}" for name in ("br", "BR", "Br", "bR")]
    # White space that was written as a reference collapses like any other.
    flat = _rarely(decode_entities(flat), "\n", "\t", "\r", "\f", put=" ")
    flat = _rarely(flat, *breaks, put="\n")
    flat = let(
        flat,
        lambda t: F.when(t.contains("  "), F.regexp_replace(t, "  +", " ")).otherwise(t),
    )
    return _without(flat, " \n", "\n ", put="\n")


def marked_texts(*pieces: Column) -> Column:
    """The marked texts of several pieces of HTML, worked out together."""
    joined = F.concat_ws(NEXT, *[F.coalesce(piece, F.lit("")) for piece in pieces])
    return F.split(_marked(joined), NEXT)


def _trimmed(text: Column) -> Column:
    """Trim ends; non-breaking spaces are kept and come out as plain spaces."""
    return _without(F.btrim(text, F.lit(" \n")), "\u00a0", put=" ")


def lines_of(marked: Column) -> Column:
    """A marked text with each block on a line of its own."""
    lines = let(
        marked,
        lambda t: F.when(
            t.contains(HIDDEN), _without(F.regexp_replace(t, _HIDDEN_EDGE, ""), HIDDEN)
        ).otherwise(t),
    )
    lines = F.regexp_replace(lines, f" ?(\n?) ?(?:{_EDGE} ?)+", f"$1{CLOSE}")
    return _trimmed(_without(_without(lines, "\n" + CLOSE, put="\n"), CLOSE, put="\n"))


def paragraphs_of(marked: Column) -> Column:
    """Texts of all ``p`` elements in a marked text, in order, empty ones included.

    A paragraph ends at its closing tag, at the next ``p``, at any block tag and at
    the end of the text, which also covers paragraphs that are never closed. A closing
    tag without an open paragraph makes an empty one, as it does in a browser. Only
    the cut and the trim run per paragraph.
    """
    end = f"{OPEN}/[pP]{CLOSE}"

    def strays(text: Column) -> Column:
        count = F.when(text.rlike(end), F.regexp_count(text, F.lit(end))).otherwise(0)
        return F.array_repeat(F.lit(""), count)

    def piece(part: Column, i: Column) -> Column:
        text = F.array(_trimmed(F.substring_index(part, OPEN, 1)))
        # What comes first ends the paragraph, whichever tag it is.
        after = F.substring(part, F.instr(part, CLOSE) + 1, F.lit(_MAX))
        after = F.when(part.contains(CLOSE), after).otherwise("")
        return F.when(i == 0, strays(part)).otherwise(F.concat(text, strays(after)))

    clean = _rarely(marked, HIDDEN, put="")
    return F.flatten(F.transform(F.split(clean, f"{OPEN}[pP]{CLOSE}"), piece))


def element_text(html: Column) -> Column:
    """The text of an element's inner HTML: breaks and blocks become lines."""
    return lines_of(_marked(shown(html)))


def paragraphs(html: Column) -> Column:
    """Texts of all ``p`` elements of a piece of HTML."""
    return paragraphs_of(_marked(shown(html)))


# --- attributes and elements ------------------------------------------------


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of an open tag; null if the tag does not have it."""
    return let(
        written_attribute(tag, name),
        lambda v: F.when(v.isNotNull(), decode_entities(v, in_attribute=True)),
    )


def written_attribute(tag: Column, name: str) -> Column:
    """The same as it is written, with references as they are."""
    name = re.escape(name)
    front = (
        rf"(?is)^<[a-z][^\s/>]*+(?:[\s/]++(?!{name}[\s=/>]){_ATTR})*+[\s/]++{name}"
        r"""(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*))|(?=[\s/>]))"""
    )
    value = F.regexp_replace(tag, front + r".*\z", "$1$2$3")
    return F.when(tag.rlike(front), value)


def tag_pattern(name: str) -> str:
    """Pattern of an open tag by element name."""
    return rf"(?is)<({re.escape(name)}){STOP}{REST}>"


def attribute_pattern(name: str, value: str, how: str = "is") -> str:
    """Pattern of any open tag by attribute; values compare case-sensitively.

    ``how`` is ``is`` (equal), ``has`` (one of the space-separated words) or
    ``contains`` (anywhere in the value). Group 1 is the element name.
    """
    word, name = rf"(?-i:{re.escape(value)})", re.escape(name)
    forms = {
        "is": (word, word, rf"{word}(?=[\s>])"),
        "has": (
            rf"(?:[^\"]*\s)?{word}(?:\s[^\"]*)?",
            rf"(?:[^']*\s)?{word}(?:\s[^']*)?",
            rf"{word}(?=[\s>])",
        ),
        "contains": (rf"[^\"]*?{word}[^\"]*", rf"[^']*?{word}[^']*", rf"[^\s\"'>]*?{word}[^\s>]*"),
    }
    double, single, bare = forms[how]
    return (
        rf"(?is)<([a-z][a-z0-9:-]*+)(?:[\s/]++(?!{name}\s*=){_ATTR})*+[\s/]++{name}\s*=\s*"
        rf"(?:\"{double}\"|'{single}'|{bare}){REST}>"
    )


def first_tag(html: Column, pattern: str) -> Column:
    """First open tag that fits the pattern, ``''`` if there is none."""
    return F.regexp_extract(html, pattern, 0)


def _openings(html: Column, name: Column) -> Column:
    return F.regexp_count(html, F.concat(F.lit("(?i)<"), name, F.lit(STOP)))


def _closings(name: Column) -> Column:
    return F.concat(F.lit("(?i)</"), name, F.lit(r"\s*>"))


def inner_html(html: Column, pattern: str, literal: str) -> Column:
    """Inner HTML of the first element that fits; null if there is none.

    The element ends where its closing tags outnumber the openings of the same name
    since its start, so nested elements of that name do not cut it short. If it is
    never closed it runs to the end of the page. Elements whose closing tag is optional
    end at the first tag that closes them, nested lists and tables included, and elements
    that never have content are empty. ``literal`` is text that any fitting tag contains;
    pages without it are not searched.
    """

    def balanced(element: Column) -> Column:
        tag = element["name"]

        def step(state: Column, part: Column) -> Column:
            return F.when(state["depth"] <= 0, state).otherwise(
                F.struct(
                    (state["depth"] + _openings(part, tag) - 1).alias("depth"),
                    (state["parts"] + 1).alias("parts"),
                )
            )

        start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("parts"))
        return let(
            F.split(element["after"], _closings(tag)),
            lambda parts: F.call_function(
                "array_join",
                F.slice(parts, 1, F.aggregate(parts, start, step, lambda s: s["parts"])),
                F.concat(F.lit("</"), tag, F.lit(">")),
            ),
        )

    def opened(found: Column) -> Column:
        name = F.lower(F.regexp_extract(found, r"(?i)^<([a-z][a-z0-9:-]*)", 1))
        after = F.regexp_extract(found, rf"(?s)^<{REST}>(.*)", 1)
        element = F.struct(name.alias("name"), after.alias("after"))
        return F.when(found != "", let(element, content))

    def content(element: Column) -> Column:
        by_name = F.when(element["name"].isin(*VOID_TAGS), "")
        for names, stop in _ENDED_BY.items():
            by_name = by_name.when(
                element["name"].isin(*names.split()),
                let(
                    F.regexp_instr(element["after"], F.lit(stop)),
                    lambda at: F.when(at == 0, element["after"]).otherwise(
                        F.left(element["after"], at - 1)
                    ),
                ),
            )
        return by_name.otherwise(balanced(element))

    # The only search; what follows starts at the tag it found.
    found = F.regexp_extract(html, pattern + ".*", 0)
    return F.when(html.contains(literal), let(found, opened))


def inside_all(html: Column, name: str) -> Column:
    """Everything that lies inside any element of this name, nested ones included."""
    tag = F.lit(name)
    opening = tag_pattern(name) + "(.*)"

    def step(depth: Column, part: Column) -> tuple[Column, Column]:
        kept = F.when(depth > 0, part).otherwise(F.regexp_extract(part, opening, 2))
        return F.greatest(depth + _openings(part, tag) - 1, F.lit(0)), kept

    kept = folded(F.split(html, rf"(?i)</{re.escape(name)}\s*>"), F.lit(0), step)
    return F.array_join(kept, f"</{name}>")
