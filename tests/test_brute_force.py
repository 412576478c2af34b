"""Random markup against a plain event-by-event reading of the same pages."""

import re
from html.parser import HTMLParser

from hypothesis import Phase, given, settings
from hypothesis import strategies as st

from newspipe import CHILD_CHAIN, extract_lenient, extract_links, extract_strict
from newspipe.functions.html import BLOCK_TAGS, CLOSED_BY_SIBLING, VOID_TAGS

TOKENS = [
    "<p>", "<p class='a>b'>", "</p>", "<P>", "</P>", "<b>", "</b>", "<br>", "<BR/>", "<div>", "</div>",
    "<ul><li>", "</li></ul>", "<h2>", "</h2>", "<!-- <p>x</p> -->", "<script>'<p>'</script>",
    "<p hidden>", "<div hidden>", "<span style='display:none'>", "<span>", "</span>", "<I STYLE='Visibility: hidden'>",
    "<i style=\"visibility:visible\">", "</i>", "<p hidden style='display:block'>", "<ul style='display: none'><li>",
    "<b class=hidden style=color:red>", "<br hidden>", "a", "b c", "d", " ", "  ", "\n", "\t", "&amp;", "&amp;lt;", "&nbsp;", "&#8217;", "&#x41;", "&copy", "&", "é",
]


class Paragraphs(HTMLParser):
    """Texts of paragraphs, opened and closed one event after the other.

    ``stack`` holds open elements, each with whether it and all around it is rendered, and
    whether it is visible.
    """

    def __init__(self, html):
        super().__init__(convert_charrefs=True)
        self.done, self.open, self.script, self.stack = [], None, False, []
        self.feed(html)
        self.close()
        self.end()

    def end(self):
        if self.open is not None:
            lines = [re.sub("[ \t\n\r\f]+", " ", part) for part in "".join(self.open).split("\0")]
            text = "\n".join(line.strip(" ") for line in lines).strip(" \n")
            self.done.append(text.replace(" ", " "))
            self.open = None

    def pop(self, tag):
        if tag in [name for name, *_ in self.stack]:
            while self.stack.pop()[0] != tag:
                pass

    def state(self):
        return self.stack[-1][1:] if self.stack else (True, True)

    def handle_starttag(self, tag, attrs):
        self.script = tag == "script"
        if tag == "p" or tag in BLOCK_TAGS:
            self.end()
            if self.stack and self.stack[-1][0] == tag and tag in CLOSED_BY_SIBLING:
                self.pop(tag)
            else:
                self.pop("p")
        if tag == "p":
            self.open = []
        rendered, visible = self.state()
        attrs = dict(attrs)
        said = dict(re.findall(r"([a-z]+)\s*:\s*([a-z]+)", (attrs.get("style") or "").lower()))
        if said.get("display") == "none" or ("display" not in said and "hidden" in attrs):
            rendered = False
        visible = {"hidden": False, "visible": True}.get(said.get("visibility"), visible)
        if tag not in VOID_TAGS and tag != "script":
            self.stack.append((tag, rendered, visible))
        if tag == "br" and self.open is not None and rendered:
            self.open.append("\0")

    def handle_endtag(self, tag):
        self.script = False
        if tag == "p" and self.open is None:
            self.done.append("")
        elif tag == "p" or tag in BLOCK_TAGS:
            self.end()
        self.pop(tag)

    def handle_data(self, data):
        if self.open is not None and not self.script and all(self.state()):
            self.open.append(data)


BODIES = st.lists(st.lists(st.sampled_from(TOKENS), max_size=25).map("".join), min_size=10, max_size=40)


@settings(max_examples=8, deadline=None, phases=[Phase.generate])
@given(BODIES)
def test_paragraphs(spark, bodies):
    rows = [
        (str(i), f"<h1>t</h1><time>x</time><article class='entry-content'>{b}</article>after<p>z</p>")
        for i, b in enumerate(bodies)
    ]
    df = spark.createDataFrame(rows, "url string, html string").coalesce(1)
    want = {str(i): Paragraphs(b).done for i, b in enumerate(bodies)}
    lenient = {r.url: r.article_content for r in extract_lenient(df).collect()}
    assert lenient == {u: "\n".join(t for t in texts if t) for u, texts in want.items()}
    strict = {r.url: r.article_content for r in extract_strict(df).collect()}
    assert strict == {u: " ".join(texts) for u, texts in want.items() if " ".join(texts)}


class Children(HTMLParser):
    """Targets of ``section > article > a``, with a stack of open elements."""

    def __init__(self, html):
        super().__init__()
        self.stack, self.found = [], []
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        if tag in VOID_TAGS:
            return
        if tag == "a" and "a" in self.stack:
            self.pop("a")
        elif tag in ("p", "li") and self.stack[-1:] == [tag]:
            self.stack.pop()
        elif tag in BLOCK_TAGS and self.stack[-1:] == ["p"]:
            self.stack.pop()
        href = dict(attrs).get("href")
        if tag == "a" and self.stack[-2:] == ["section", "article"] and href:
            self.found.append(href)
        self.stack.append(tag)

    def handle_endtag(self, tag):
        if tag in self.stack:
            self.pop(tag)

    def pop(self, tag):
        while self.stack.pop() != tag:
            pass


NESTING = [
    "<section>", "</section>", "<article>", "</article>", "<ARTICLE class=x>", "<div>", "</div>", "<p>", "</p>",
    "<li>", "</li>", "<img src=i>", "<br>", "text", "<a href='1'>", "<a href=2>", "<A HREF=\"/3\" class='y'>",
    "<a href=''>", "<a>", "</a>", "<section><article>", "</article></section>",
]


@settings(max_examples=8, deadline=None, phases=[Phase.generate])
@given(st.lists(st.lists(st.sampled_from(NESTING), max_size=30).map("".join), min_size=10, max_size=40))
def test_child_links(spark, bodies):
    # The walk starts at the first section, so that is where the pages start.
    bodies = ["<section>" + b for b in bodies]
    rows = [(str(i), b) for i, b in enumerate(bodies)]
    df = spark.createDataFrame(rows, "url string, html string").coalesce(1)
    got = {}
    for row in extract_links(df, CHILD_CHAIN).collect():
        got.setdefault(row.url, []).append((row.pos, row.href))
    want = {str(i): list(enumerate(Children(b).found)) for i, b in enumerate(bodies)}
    assert got == {url: found for url, found in want.items() if found}
