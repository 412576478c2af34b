import time
"""Links and their addresses on hand-made listings."""

from urllib.parse import urljoin

from pyspark.sql import functions as F

from newspipe import CHILD_CHAIN, CLASS_TOKENS, extract_links, resolve_href
from newspipe.plans import flows

TOKENS = "penci-link-post penci-image-holder penci-disable-lazy"


def hrefs(spark, rule, bodies):
    rows = [(i, name, html) for i, (name, html) in enumerate(bodies.items())]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {name: [] for name in bodies}
    for row in extract_links(df, rule).orderBy("url", "pos").collect():
        assert row.pos == len(got[row.url])
        got[row.url].append(row.href)
    return got


def test_child_chain(spark):
    got = hrefs(
        spark,
        CHILD_CHAIN,
        {
            "plain": "<section><article><a href=/1>x</a></article></section>",
            "several": "<section><h2>n</h2><article><a href='1'>x</a><a href='2'>x</a></article>"
            "<article><img src=i><p>t</p><a href='3'></a></article></section>",
            "not direct": "<section><div><article><a href='1'></a></article></div></section>",
            "inner div": "<section><article><div><a href='1'></a></div></article></section>",
            "no section": "<article><a href='1'></a></article>",
            "closed section": "<section></section><article><a href='1'></a></article>",
            "after nested": "<section><article><div><br></div><a href='1'></a></article></section>",
            "empty and none": "<section><article><a href=''></a><a></a><a href='1'></a></article></section>",
            "twice": "<section><article><a href='1'></a><a href='1'></a></article></section>",
            "open p": "<section><p>intro<article><a href='1'></a></article></section>",
            "open a": "<section><article><a href='1'>x<a href='2'>y</article></section>",
            "upper": "<SECTION><Article class=x><A HREF='/Up'>x</A></Article></SECTION>",
            "comment": "<section><!--<article><a href='0'></a></article>--><article><a href='1'></a></article></section>",
            "svg": "<section><article><svg><path d='m'/></svg><a href='1'></a></article></section>",
        },
    )
    assert got == {
        "plain": ["/1"],
        "several": ["1", "2", "3"],
        "not direct": [],
        "inner div": [],
        "no section": [],
        "closed section": [],
        "after nested": ["1"],
        "empty and none": ["1"],
        "twice": ["1", "1"],
        "open p": ["1"],
        "open a": ["1", "2"],
        "upper": ["/Up"],
        "comment": ["1"],
        "svg": ["1"],
    }


def test_class_tokens(spark):
    got = hrefs(
        spark,
        CLASS_TOKENS,
        {
            "all": f"<a class='{TOKENS}' href='1'>x</a>",
            "order and more": f"<a href='1' class=\"y {' '.join(reversed(TOKENS.split()))}  z\">x</a>",
            "two of three": "<a class='penci-link-post penci-image-holder' href='1'>x</a>",
            "longer token": f"<a class='{TOKENS}s' href='1'>x</a>",
            "any element": f"<span class='{TOKENS}' href='1'>x</span>",
            "no target": f"<a class='{TOKENS}'>x</a><a class='{TOKENS}' href=''>x</a>",
            "twice": f"<a class='{TOKENS}' href='1'>x</a>" * 2,
            "entity": f"<a class='{TOKENS}' href='/?a=1&amp;b=2'>x</a>",
        },
    )
    assert got == {
        "all": ["1"],
        "order and more": ["1"],
        "two of three": [],
        "longer token": [],
        "any element": ["1"],
        "no target": [],
        "twice": ["1", "1"],
        "entity": ["/?a=1&b=2"],
    }


def test_resolving_agrees_with_the_standard_library(spark):
    bases = [
        "https://a.example.org",
        "https://a.example.org/",
        "http://a.example.org/x/y/z.html?q=1/2#top",
        "https://a.example.org:8080/x/y/",
    ]
    targets = [
        "/p", "p", "p/q?r=../s", "./p", "../p", "../../../p", "/a/./b/../c", "..", ".", "x/..",
        "//b.example.org/p", "https://b.example.org/p", "mailto:me@example.org", "?n=2", "#f",
        "/p#../f", "/…é",
    ]
    df = spark.createDataFrame([(b, t) for b in bases for t in targets], "b string, t string")
    rows = df.withColumn("got", resolve_href(F.col("t"), F.col("b"))).collect()
    for row in rows:
        base = row.b + "/" * (row.b.count("/") == 2)  # a browser always has a path
        want = urljoin(base, row.t)
        assert row.got == want, (row.b, row.t)


def test_collected_links_are_absolute(spark):
    df = spark.createDataFrame(
        [("https://a.example.org/n/", f"<a class='{TOKENS}' href=' ../p '>x</a>")],
        "url string, html string",
    )
    assert flows.collect_links(df, strict=True).first().href == "https://a.example.org/p"


def test_a_page_with_many_links(spark):
    link = "<section><article><a href='/x'>x</a></article></section>"
    df = spark.createDataFrame([("u", link * 16_000)], "url string, html string")
    start = time.perf_counter()
    assert extract_links(df, CHILD_CHAIN).count() == 16_000
    assert time.perf_counter() - start < 20


def test_document_base(spark):
    """What a page's links refer to, against the standard library's joining of addresses."""
    url = "https://www.example.org/news/2024/list.html?page=2#top"
    bases = {
        "none": ("", url),
        "absolute": ("<base href='https://cdn.example/b/'>", "https://cdn.example/b/"),
        "relative": ("<BASE HREF=../img/x>", urljoin(url, "../img/x")),
        "root": ('<base target=_top><base href="/one/"><base href="/two/">', urljoin(url, "/one/")),
        "blanks": ("<base href='  //other.example/q?r#s '>", "https://other.example/q?r#s"),
        "hidden": ("<!-- <base href='/no/'> --><script>'<base href=/no/>'</script><base href='/yes/'>", urljoin(url, "/yes/")),
        "data": ("<base href='data:text/plain,x'>", url),
        "empty": ("<base href=''>", url),
        "reference": ("<base href='/a&amp;b/'>", urljoin(url, "/a&b/")),
        "named alike": ("<basefont href='/no/'>", url),
    }
    links = ["z.html", "/z", "?z", "../z", "//h.example/z", "https://h.example/z", "./"]
    anchors = "".join(f"<section><article><a href='{x}'>x</a></article></section>" for x in links)
    rows = [(i, url, f"<head>{tag}</head>{anchors}") for i, (tag, _) in enumerate(bases.values())]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    got = {}
    for row in flows.collect_links(pages).orderBy("page_id", "pos").collect():
        got.setdefault(row.page_id, []).append(row.href)
    for i, (name, (_, base)) in enumerate(bases.items()):
        assert got[i] == [urljoin(base, x) for x in links], name
    plain = extract_links(pages, CHILD_CHAIN)
    assert plain.columns == ["page_id", "url", "pos", "href"]
