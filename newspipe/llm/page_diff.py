"""Main text of web pages: differences to the pages with the nearest URLs, checked by element rules.

A page is read into lines, one per block element. Lines in menus, side bars, notices,
adverts, forms, comments and the like are dropped. Each of the others is in an element that
says it is the article, in one that says it is the main part, or in neither.

All pages of a host are put in the order of their paths, each is paired with the nearest
ones before and after it, two pages' lines are aligned by a longest common subsequence, and
a line that at least half of the pages beside it share is template. A page that shares
nearly all prose lines is a copy of the article, such as its print version, and has no say
in that. What is not template is the page's own.

Template is deleted. On a page that marks its article, marks check what is left: the article
is the marked elements with lines of their own, and in these, passages that the page has in
common with others are put back. Marked elements that are template throughout, such as a
teaser on every page, go. Around the article only own lines stay, those in the main part and those
from a title on that stands before an article without one.

Null, empty and textless pages give an empty text. A page without host or with a null URL
has no neighbour, and pages alike line by line count as one; without a neighbour that differs
no line is template. Very long pages are read whole.
Equal URLs are ordered by page id, repeated rows are extracted each. An empty table gives
an empty result. Columns other than ``page_id``, ``url`` and ``html`` are not looked at.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .bitmaps import maybe_in
from .store import map_frames, ranked, stored
from .words import U, run_hashes

# Element names by what HTML makes of them.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea xmp iframe noembed noframes".split())
BLOCK = set(
    "address article aside blockquote body center details dialog dd div dl dt fieldset figcaption"
    " figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre"
    " section summary table tbody td tfoot th thead tr ul caption head".split()
)
HIDDEN = set(
    "script style title textarea xmp iframe noembed noframes noscript template svg canvas object"
    " audio video select option button input label fieldset datalist head nav aside footer form"
    " menu dialog map".split()
)
# Start tags that end an open element of the names given, up to the elements of the third column.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
SCOPES = set(
    "article aside body dialog div footer form header main nav section table td th ul ol dl html"
    " blockquote figure details fieldset".split()
)
# Words of class, id and role that tell what an element is for.
CLUTTER = set(
    "ad ads adv advert adverts advertisement advertising adsbygoogle sponsor sponsored promo"
    " promotion banner nav navbar navigation menu breadcrumb breadcrumbs sidebar footer masthead"
    " topbar toolbar cookie cookies consent gdpr notice notices notification alert popup modal"
    " overlay newsletter subscribe subscription signup login share sharing social related"
    " recommended comment comments disqus respond replies pagination pager widget search skip"
    " complementary contentinfo".split()
)
NOT_CLUTTER = set("no has with without main article content body".split())
ARTICLE = re.compile(
    r"(?:^|\s)(?:(?:article|entry|post|story)[-_]?(?:body|content|text)|articlebody)(?:\s|$)"
)
MAIN = re.compile(r"(?:^|\s)main(?:\s|$)")

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
NAMES = re.compile(
    r"(?:^|\s)(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I
)
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I) for name in RAW}


def _purpose(name: str, attributes: str) -> tuple[bool, str]:
    """Whether an element is clutter, and whether it says that it is the article or the main part."""
    mark = name if name in ("article", "main") else ""
    if name in ("html", "body") or not attributes:
        return False, mark
    values = [a or b or c for a, b, c in NAMES.findall(attributes)]
    for value in values:
        if mark != "article" and ARTICLE.search(value.lower()):
            mark = "article"
        elif not mark and MAIN.search(value.lower()):
            mark = "main"
    for value in values:
        spaced = re.sub(r"(?<=[a-z])(?=[A-Z])", " ", value)
        for token in spaced.lower().split():
            parts = set(re.split(r"[-_:]+", token))
            if parts & CLUTTER and not parts & NOT_CLUTTER:
                return True, mark
    return False, mark


def lines(page: str) -> list[tuple[str, int, bool]]:
    """Text, marked element, and whether a title, of every line but clutter.

    Marked elements are numbered: articles from 1 upwards, whatever is marked within them,
    main parts from -1 downwards, 0 is for lines that are in neither.
    """
    out: list[tuple[str, int, bool]] = []
    # name, hidden, marked, title; what holds for an element holds for all it contains
    stack: list[tuple[str, bool, int, bool]] = [("", False, 0, False)]
    marks = 0
    count: dict[str, int] = {}
    text: list[str] = []

    def flush() -> None:
        if text:
            line = " ".join("".join(text).split())
            if line:
                out.append((line, stack[-1][2], stack[-1][3]))
            text.clear()

    def close(depth: int) -> None:
        for name, *_ in stack[depth:]:
            count[name] -= 1
        del stack[depth:]

    def close_implied(names: tuple[str, ...], until: tuple[str, ...]) -> None:
        if not any(count.get(n) for n in names):
            return
        found = None
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth][0] in names:
                found = depth
            elif stack[depth][0] in until:
                break
        if found:
            close(found)

    at, end = 0, len(page)
    while at < end:
        tag = TAG.search(page, at)
        stop = tag.start() if tag else end
        if stop > at and not stack[-1][1]:
            text.append(references.unescape(page[at:stop]))
        if not tag:
            break
        at = tag.end()
        name = (tag[2] or tag[5] or "").lower()
        if not name:
            continue
        if tag[1] or tag[4]:
            if name in BLOCK:
                flush()
            if count.get(name):
                depth = len(stack) - 1
                while stack[depth][0] != name:
                    if stack[depth][0] in SCOPES and name not in SCOPES:
                        depth = 0
                        break
                    depth -= 1
                if depth:
                    close(depth)
            continue
        attributes = tag[3] if tag[2] else tag[6]
        if name == "br":
            text.append(" ")
        if name in BLOCK:
            flush()
            if name != "p" or count.get("p"):
                close_implied(("p",), ("article", "section", "div", "td", "th", "li", "blockquote"))
            if name in CLOSES:
                close_implied(*CLOSES[name])
        if name in VOID:
            continue
        if name in RAW:
            closing = RAW_END[name].search(page, at)
            at = closing.end() if closing else end
            continue
        if attributes.endswith("/") and name in ("svg", "path"):
            continue
        clutter, mark = _purpose(name, attributes)
        _, hidden, marked, _ = stack[-1]
        if name == "article" and marked and any(s[0] == "article" for s in stack):
            clutter = True  # an article within an article is a comment on it
        if name in ("article", "main") and hidden and all(
            s[0] in ("form", "fieldset", "label") or not s[1] for s in stack
        ):
            hidden = False  # forms around whole pages
        hidden = hidden or clutter or name in HIDDEN or (name == "header" and not marked)
        if mark and not hidden and (not marked or (marked < 0 and mark == "article")):
            marks += 1
            marked = marks if mark == "article" else -marks
        stack.append((name, hidden, marked, name == "h1"))
        count[name] = count.get(name, 0) + 1
    flush()
    return out


def common(a: list[int], b: list[int]) -> list[bool]:
    """Which elements of ``a`` are in a longest common subsequence with ``b``.

    Equal ends are taken off; the rest is halved around the best cut (Hirschberg), the
    lengths of which come from rows of bits, so that memory stays in proportion to length.
    """
    keep = [False] * len(a)

    def lengths(x: list[int], y: list[int]) -> np.ndarray:
        """Length for ``x`` and each prefix of ``y``."""
        places: dict[int, int] = {}
        for j, value in enumerate(y):
            places[value] = places.get(value, 0) | 1 << j
        full = (1 << len(y)) - 1
        row = full
        for value in x:
            hit = row & places.get(value, 0)
            row = ((row + hit) | (row - hit)) & full
        bits = np.unpackbits(
            np.frombuffer(row.to_bytes(len(y) // 8 + 1, "little"), np.uint8), bitorder="little"
        )[: len(y)]
        return np.concatenate(([0], np.cumsum(bits == 0)))

    work = [(0, len(a), 0, len(b))]
    while work:
        i, m, j, n = work.pop()
        while i < m and j < n and a[i] == b[j]:
            keep[i] = True
            i, j = i + 1, j + 1
        while i < m and j < n and a[m - 1] == b[n - 1]:
            keep[m - 1] = True
            m, n = m - 1, n - 1
        if i == m or j == n:
            continue
        if m - i == 1:
            keep[i] = a[i] in b[j:n]
            continue
        half = (i + m) // 2
        left = lengths(a[i:half], b[j:n])
        right = lengths(a[half:m][::-1], b[j:n][::-1])[::-1]
        cut = j + int((left + right).argmax())
        work += [(i, half, j, cut), (half, m, cut, n)]
    return keep


def _hashes(texts: list[str]) -> list[int]:
    data = [t.encode() for t in texts]
    ends = np.cumsum([len(d) for d in data], dtype=np.int64)
    symbols = np.frombuffer(b"".join(data), np.uint8)
    found = run_hashes(symbols, ends - [len(d) for d in data], ends) if data else np.empty(0, U)
    return found.view(np.int64).tolist()


def parsed(pages: DataFrame) -> DataFrame:
    """Every page with all its lines but clutter: ``lines`` with the ``marked`` element each is in,
    whether ``titles``, their ``sizes`` and ``hashes``.

    ``stay`` has the lines that stay if none is template, null for all of them.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for page in frame["html"]:
                found = lines(page) if page else []
                texts, marked, titles = ([x[k] for x in found] for k in range(3))
                sizes = [len(line) for line in texts]
                stay = article(marked, titles, sizes, np.zeros(len(texts), bool))
                all_stay = stay == list(range(len(texts)))
                out.append((texts, marked, titles, sizes, _hashes(texts), None if all_stay else stay))
            names = ["lines", "marked", "titles", "sizes", "hashes", "stay"]
            table = pd.DataFrame(out, columns=names, index=frame.index)
            yield frame.drop(columns="html").join(table)

    # What comes before the path: scheme and host, without the port.
    host = F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]+)", 1))
    source = pages.select(
        "page_id",
        "url",
        F.coalesce(host, F.lit("")).alias("host"),
        F.regexp_extract("url", r"^[^:/?#]+://[^/?#]*([^?#]*)", 1).alias("path"),
        "html",
    )
    return map_frames(
        source,
        run,
        "url string, host string, path string, lines array<string>, marked array<int>,"
        " titles array<boolean>, sizes array<int>, hashes array<bigint>, stay array<int>",
        ("page_id",),
    )


BESIDE = 2  # pages before and after that a page is compared with
PIECE = 1024  # pages of the order that a window looks at
COPY = 0.8  # of the lines of the shorter page
PROSE = 25  # characters of a line, on average; menus have shorter ones


def template(sizes: list[int], own: list[int], others: list[list[int]]) -> np.ndarray:
    """Which lines of a page, given by their hashes, the pages beside it share."""
    votes, voters = np.zeros(len(own), int), 0
    for other in {tuple(o): o for o in others if o and o != own}.values():
        shared = np.array(common(own, other), bool)
        n = int(shared.sum())
        size = int(np.array(sizes)[shared].sum())
        if n > COPY * min(len(own), len(other)) and size >= PROSE * n:
            continue
        votes += shared
        voters += 1
    return (2 * votes >= voters) & (voters > 0)


def article(
    marked: list[int], titles: list[bool], sizes: list[int], shared: np.ndarray
) -> list[int]:
    """Which lines make up the main text, given which are template."""
    if not any(marked):
        return np.flatnonzero(~shared).tolist()
    own: Counter[int] = Counter()
    for m, size, same in zip(marked, sizes, shared.tolist(), strict=True):
        if m and not same:
            own[m] += size
    # Where all is template, nothing tells which is not the article.
    kept = set(own) or set(marked) - {0}
    # A main part with less of its own than the articles beside it or in it is not the article.
    rest = {m for m in own if m < 0 and own[m] < sum(n for k, n in own.items() if k > 0)}
    out = [i for i, m in enumerate(marked) if m in kept and not (m in rest and shared[i])]
    if not any(titles[i] for i in out):
        before = [i for i in range(out[0]) if not marked[i] and not shared[i]]
        heads = [i for i in before if titles[i]]
        out = [i for i in before if heads and i >= heads[-1]] + out
    return out


def neighbours(rows: DataFrame) -> DataFrame:
    """Pages in the order of their hosts and paths, with the hashes of those beside each.

    They are read off by windows over pieces of the order, of fixed size however large a host;
    pages next to a piece are sent to it as well.
    """
    order = ranked(
        rows.select("row", "host", "path", "page_id", "marked", "titles", "sizes", "hashes"),
        "host", "path", "page_id", name="pages_in_order",
    )
    pieces = max(1, -(-order.count() // PIECE))
    piece = F.floor(F.col("rank") / PIECE)
    near = F.array_distinct(F.array(*[F.floor((F.col("rank") + s) / PIECE) for s in (-BESIDE, 0, BESIDE)]))
    sent = order.withColumn("piece", F.explode(near)).withColumn("guest", F.col("piece") != piece)
    beside = Window.partitionBy("piece").orderBy("rank").rowsBetween(-BESIDE, BESIDE)
    seen = F.collect_list(F.struct("rank", "host", "hashes")).over(beside)
    same_host = F.filter("seen", lambda x: (x["host"] == F.col("host")) & (x["rank"] != F.col("rank")))
    return (
        sent.repartition(pieces, "piece")
        .withColumn("seen", seen)
        .filter(~F.col("guest") & (F.col("host") != ""))
        .withColumn("others", F.transform(same_host, lambda x: x["hashes"]))
        .select("row", "marked", "titles", "sizes", "hashes", "others")
    )


def differences(rows: DataFrame) -> DataFrame:
    """``row, stay``: the lines that stay, of pages with lines that are template."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for page in frame.itertuples(index=False):
                own, others = page.hashes.tolist(), [o.tolist() for o in page.others]
                shared = template(page.sizes.tolist(), own, others)
                if shared.any():
                    out.append((page.row, article(page.marked.tolist(), page.titles.tolist(), page.sizes.tolist(), shared)))
            yield pd.DataFrame(out, columns=["row", "stay"])

    # A page without any line of those beside it has no template.
    meets = F.arrays_overlap("hashes", F.flatten("others"))
    return map_frames(neighbours(rows).filter(meets), run, "row bigint, stay array<int>", ids=())


def extract_pages(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    rows = stored(parsed(pages).withColumn("row", F.monotonically_increasing_id()), "parsed_pages")
    changed = stored(differences(rows), "differences")
    # Lines of other pages need not be sent to where the differences are.
    key = F.xxhash64("row")
    hit = maybe_in(changed.select(key.alias("key")), "key", key)
    some = rows.filter(hit).join(changed.withColumnRenamed("stay", "__stay"), "row", "left")
    rest = rows.filter(~hit).withColumn("__stay", F.lit(None).cast("array<int>"))
    stay = F.coalesce("__stay", "stay")
    parts = F.transform(stay, lambda i: F.element_at("lines", i + 1))
    text = F.array_join(F.when(stay.isNull(), F.col("lines")).otherwise(parts), "\n")
    columns = ["page_id", "url", "lines", "stay", "__stay"]
    return (
        some.select(columns)
        .unionByName(rest.select(columns))
        .select("page_id", "url", text.alias("text"))
        .withColumn("n_chars", F.length("text").cast("long"))
    )
