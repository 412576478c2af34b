"""Extraction rules on hand-made pages, one per branch."""

import time

import pytest
from pyspark.sql import functions as F

from newspipe import extract_lenient, extract_rejects, extract_strict
from newspipe.functions import html as H


def pages(spark, bodies):
    rows = [(i, name, html) for i, (name, html) in enumerate(bodies.items())]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def by_url(df, column):
    return {row["url"]: row[column] for row in df.collect()}


LENIENT = {
    "empty paragraph": "<h1>t</h1><article><p>a</p><p></p><p>b</p></article>",
    "no paragraph": "<h1>t</h1><article></article>",
    "outside": "<h1>t</h1><p>no</p><article><p>yes</p></article><p>no</p>",
    "two articles": "<h1>t</h1><article><p>a</p></article><p>x</p><article><p>b</p></article>",
    "nested": "<h1>t</h1><article><p>a</p><article><p>b</p></article><p>c</p></article><p>x</p>",
    "unclosed": "<h1>t</h1><article><p>a<p><b>b<br>c<p>d",
    "block ends it": "<h1>t</h1><article><p>a<ul><li>x</li></ul>y<p>b</p></div>z</article>",
    "script": "<h1>t</h1><script>var s='<article><p>no</p>'</script><article><p>a</p></article>",
    "comment": "<!-- <h1>old</h1> --><h1>t</h1><article><!--<p>x</p>--><p>a</p></article>",
    "spaces": "<h1>t</h1><article>\n<p>\n  a \t<b> b</b>\r\n <br/> c </p>\n<p> </p></article>",
    "hard space": "<h1>t</h1><article><p>&nbsp;</p><p>a&nbsp;&nbsp;b</p></article>",
    "entities": "<h1>t</h1><article><p>&amp;lt; &lt;b&gt; &#8217;&#x41; &copy 1 &bogus; a&b &#0;</p></article>",
    "upper case": "<H1>t</H1><ARTICLE><P CLASS='x'>a<BR>b</P></ARTICLE>",
    "attributes": "<h1>t</h1><article data-x='a>b'><p title=\"<p>\">a</p><p data-y='</p>'>b</p></article>",
    "pre is no p": "<h1>t</h1><article><pre>x</pre><param><p>a</p></article>",
}
LENIENT_CONTENT = {
    "empty paragraph": "a\nb",
    "no paragraph": "",
    "outside": "yes",
    "two articles": "a\nb",
    "nested": "a\nb\nc",
    "unclosed": "a\nb\nc\nd",
    "block ends it": "a\nb",
    "script": "a",
    "comment": "a",
    "spaces": "a b\nc",
    "hard space": " \na  b",
    "entities": "&lt; <b> ’A © 1 &bogus; a&b \ufffd",
    "upper case": "a\nb",
    "attributes": "a\nb",
    "pre is no p": "a",
}


def test_lenient_content(spark):
    assert by_url(extract_lenient(pages(spark, LENIENT)), "article_content") == LENIENT_CONTENT


def test_lenient_fields(spark):
    head = "<meta content='2025' property='article:published_time'>"
    rows = extract_lenient(
        pages(
            spark,
            {
                "none": "<h1>A <i>b</i></h1>",
                "no headline": "<h2>a</h2><article><p>a</p></article>",
                "commented headline": "<!--<h1>a</h1>-->",
                "empty headline": "<h1></h1>",
                "two headlines": "<h1>one</h1><h1>two</h1>",
                "h10": "<h10>a</h10><h1 class=x>b</h1>",
                "all": head + "<h1>t</h1><div class='x coauthored'>By <span>Me</span> x</div>",
                "nested": "<h1>t</h1><div class=author><div>A</div><div>B</div></div>C",
                "case": "<h1>t</h1><i class='Author'>no</i>",
                "empty author": "<h1>t</h1><i class='author'></i><i class='author'>no</i>",
                "no content": "<h1>t</h1><meta property='article:published_time'>",
                "value elsewhere": "<h1>t</h1><i title='class=author'>no</i>",
            },
        )
    ).collect()
    got = {r.url: (r.headline, r.author, r.publish_time) for r in rows}
    assert got == {
        "none": ("A b", None, None),
        "empty headline": ("", None, None),
        "two headlines": ("one", None, None),
        "h10": ("b", None, None),
        "all": ("t", "By Me x", "2025"),
        "nested": ("t", "A\nB", None),
        "case": ("t", None, None),
        "empty author": ("t", "", None),
        "no content": ("t", None, None),
        "value elsewhere": ("t", None, None),
    }


def test_a_broken_field_leaves_the_others_alone(spark):
    html = (
        "<h1>a <i x=\"1</h1><b class='author'>b <i </b>"
        "<article><p title=\"2\">c > d</p><p>e</p></article>"
    )
    row = extract_lenient(pages(spark, {"u": html})).first()
    assert (row.headline, row.author, row.article_content) == ('a <i x="1', "b <i", "c > d\ne")


def wrapped(inner, name="entry-content"):
    return f"<h1>t</h1><time datetime='d'>x</time><div class='{name}'>{inner}</div><p>after</p>"


STRICT = {
    "two empty": wrapped("<p></p><p></p>"),
    "one empty": wrapped("<p></p>"),
    "joined": wrapped("<p>a</p><p></p><p>b</p>"),
    "nested div": wrapped("<div><p>a</p></div><div>x<div><p>b</p></div></div><p>c</p>"),
    "unclosed": "<h1>t</h1><time>x</time><div class='entry-content'><p>a<p>b",
    "stray ends": wrapped("</p><p>a<div>x</div></p><p>b</p></P>"),
    "second token": wrapped("<p>a</p>", "wide entry-content"),
    "longer token": wrapped("<p>a</p>", "entry-contents"),
    "case": wrapped("<p>a</p>", "Entry-Content"),
    "first present": wrapped("", "dable-content-wrapper") + wrapped("<p>a</p>"),
    "later first": wrapped("<p>b</p>", "article-content") + wrapped("<p>a</p>"),
    "other element": "<h1>t</h1><time>x</time><section class=entry-content><p>a</p></section>",
    "no wrapper": wrapped("<p>a</p>", "x"),
    "no time": "<h1>t</h1><div class='entry-content'><p>a</p></div>",
    "no headline": "<time>x</time><div class='entry-content'><p>a</p></div>",
    "neither": "<div class='entry-content'><p>a</p></div>",
}


def test_strict_content_and_rejects(spark):
    df = pages(spark, STRICT)
    assert by_url(extract_strict(df), "article_content") == {
        "two empty": " ",
        "joined": "a  b",
        "nested div": "a b c",
        "unclosed": "a b",
        "stray ends": " a  b ",
        "second token": "a",
        "later first": "a",
        "other element": "a",
    }
    assert by_url(extract_rejects(df), "reason") == {
        "one empty": "no_content",
        "longer token": "no_content",
        "case": "no_content",
        "first present": "no_content",
        "no wrapper": "no_content",
        "no time": "no_time",
        "no headline": "no_h1",
        "neither": "no_h1",
    }


def test_strict_date(spark):
    body = "<div class='entry-content'><p>a</p></div>"
    rows = extract_strict(
        pages(
            spark,
            {
                "none": "<h1>t</h1><time>x</time>" + body,
                "first": "<h1>t</h1><time>x</time><time datetime='d'>x</time>" + body,
                "set": "<h1>t</h1><time class=a datetime=\"2025-04-10T00:00\">x</time>" + body,
            },
        )
    )
    assert by_url(rows, "date_published") == {"none": None, "first": None, "set": "2025-04-10T00:00"}


def test_page_with_null_html_gives_no_article(spark):
    df = spark.createDataFrame([(1, "u", None)], "page_id long, url string, html string")
    assert extract_lenient(df).count() == 0
    assert extract_strict(df).count() == 0


def test_duplicate_pages_give_duplicate_rows(spark):
    df = pages(spark, {"a": "<h1>t</h1>"})
    assert extract_lenient(df.union(df)).count() == 2


def test_broken_pages_neither_overflow_nor_stall(spark):
    n = 20_000
    bodies = {
        "open tags": "<h1>t</h1><article>" + "<b x=1 " * n + "<p>a</p></article>",
        "attributes": "<h1>t</h1><i " + "a b='c' " * n + "><article><p>a</p></article>",
        "quotes": "<h1>t</h1><article><p>" + "<a href=\"" * 2000 + "</p></article>",
        "paragraphs": "<h1>t</h1><article>" + "<p>x" * n + "</article>",
        "angles": "<h1>t</h1><article><p>" + "a < b " * n + "</p></article>",
        "comments": "<h1>t</h1><article><p>a</p></article>" + "<!--" * n,
        "articles": "<h1>t</h1>" + "<article><p>a</p></article>" * 2000,
    }
    lengths = by_url(
        extract_lenient(pages(spark, bodies)).withColumn("n", F.length("article_content")), "n"
    )
    assert set(lengths) == set(bodies)
    assert lengths["paragraphs"] == 2 * n - 1
    assert lengths["articles"] == 2 * 2000 - 1
    assert lengths["angles"] == len("a < b " * n) - 1


@pytest.mark.parametrize(
    "text, want",
    [
        ("&#146;", "’"),
        ("&#x1F600;", "😀"),
        ("&#55296;", "\ufffd"),
        ("&#99999999;", "\ufffd"),
        ("&hellip;&eacute;", "…é"),
        ("&amp;amp;", "&amp;"),
        ("&amp &ampx", "& &x"),
        ("&#0000000000039;&#x00000041;", "'A"),
        ("&", "&"),
        ("", ""),
    ],
)
def test_entities(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(H.decode_entities(F.col("t"))).first()[0] == want


def test_attribute_values_keep_bare_references(spark):
    tag = "<a rel=x HREF = '/?a=1&copy=2&amp;b' href='/second' data-href=z>"
    df = spark.createDataFrame([(tag,)], "t string")
    row = df.select(
        H.attribute(F.col("t"), "href").alias("href"),
        H.attribute(F.col("t"), "rel").alias("rel"),
        H.attribute(F.col("t"), "id").alias("id"),
    ).first()
    assert tuple(row) == ("/?a=1&copy=2&b", "x", None)


def test_our_own_marks_in_a_page_do_no_harm(spark):
    html = "<h1>t\u0001h1\u0002</h1><article><p>a\u0003b\u0001p\u0002c</p><p>\u0002d</p></article>"
    row = extract_lenient(pages(spark, {"u": html})).first()
    assert (row.headline, row.article_content) == ("th1", "abpc\nd")


def test_unseen_parts(spark):
    bodies = {
        "case": "<H1>t</H1><SCRIPT>'<p>'</Script ><article><p>a</p></article>",
        "unclosed script": "<h1>t</h1><article><p>a</p><script>x<p>b</p>",
        "unclosed comment": "<h1>t</h1><article><p>a</p><!-- x<p>b</p>--",
        "dashes": "<h1>t</h1><article><p>a</p><!-- - -- ---><p>b</p></article>",
        "longer names": "<h1>t</h1><article><scripts><p>a</p></scripts></article>",
        "other end": "<h1>t</h1><style>p</script>q</style><article><p>a</p></article>",
    }
    got = by_url(extract_lenient(pages(spark, bodies)), "article_content")
    assert got == dict.fromkeys(bodies, "a") | {"dashes": "a\nb"}


@pytest.mark.parametrize(
    "body, want",
    [
        ('<img class="author-avatar"><nav>n</nav><article><p>x</p></article>', ""),
        ('<link class="author" href="a"><p>x</p>', ""),
        ('<ul><li class="author">By A<li>Share</ul><p>x</p>', "By A"),
        ('<p class="author">By A<div>x</div>', "By A"),
        ('<dl><dt class="author">By A<dd>x</dl>', "By A"),
        ('<table><tr><td class="author">By A<td>x</table>', "By A"),
        ('<div class="author">By <div>A</div> B</div>x', "By\nA\nB"),
    ],
)
def test_author_ends_where_its_element_does(spark, body, want):
    df = pages(spark, {"u": "<h1>t</h1>" + body})
    assert by_url(extract_lenient(df), "author") == {"u": want}


def test_a_wrapper_without_content_rejects_the_page(spark):
    df = pages(spark, {"u": '<h1>t</h1><time>x</time><input class="entry-content"><p>x</p>'})
    assert extract_strict(df).count() == 0
    assert by_url(extract_rejects(df), "reason") == {"u": "no_content"}


@pytest.mark.parametrize(
    "text, want",
    [
        ("a&#10;b&#9;c", "a b c"),
        ("x&#13;&#10;y", "x y"),
        ("a&NewLine;&Tab;b", "a b"),
        ("a<br>&#10; b", "a\nb"),
        ("&#8212 z", "— z"),
        ("&#x110000;", "\ufffd"),
        ("&#0;q", "\ufffdq"),
        ("&#xD800;", "\ufffd"),
        ("&#00000000000000065;&#x00000000041;", "AA"),
        ("&#99999999999999999999;", "\ufffd"),
        ("&hearts;&CounterClockwiseContourIntegral;&NotEqualTilde;&equals;", "♥∳≂̸="),
        ("&#x;&#;", "&#x;&#;"),
    ],
)
def test_references_in_text(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(H.element_text(F.col("t"))).first()[0] == want


def test_references_in_attributes_keep_their_white_space(spark):
    df = spark.createDataFrame([('<a href="a&#10;b&copy=1&#8212">',)], "t string")
    assert df.select(H.attribute(F.col("t"), "href")).first()[0] == "a\nb&copy=1—"


@pytest.mark.parametrize("value", ["w-[10px]", "a+b", "x.y", "(z)", "a|b", "^$", "c*"])
def test_profile_values_are_no_patterns(spark, value):
    df = spark.createDataFrame([(f'<p class="q"><a class="u {value} v" href=h>',)], "t string")
    tag = H.first_tag(F.col("t"), H.attribute_pattern("class", value, "has"))
    assert df.select(H.attribute(tag, "href")).first()[0] == "h"


def test_time_grows_with_the_page(spark):
    def seconds(body):
        df = pages(spark, {"u": "<h1>t</h1>" + body})
        start = time.perf_counter()
        text = extract_lenient(df).first()["article_content"]
        assert text == "\n".join(["x"] * body.count("<article>"))
        return time.perf_counter() - start

    article = "<article><p>x</p></article>"
    seconds(article * 100)
    assert seconds(article * 16_000) < 8


def test_hidden_elements(spark):
    """Hidden text is not read, hidden elements still count, and breaks in them do not."""
    bodies = {
        "verdict": "<p hidden>secret</p><p style='display:none'>none</p><p>shown</p>",
        "around": "<div hidden><p>a</p><div>b</div></div><p>c<span hidden>x<br>y</span>d</p>",
        "invisible": "<div style='visibility:hidden'><p>a<br><b style='visibility:visible'>B</b>c</p></div>",
        "own display": "<p hidden style='display:block'>a</p><p style='display:none; display:block'>b</p>"
        "<p style='display:none !important; display:block'>c</p>",
        "ends": "<div><span hidden>x</div><p>y</p><p hidden>z<div>w</div><p>v</p>",
        "words": "<p class=hidden title='display:none'>hidden words, display: none</p>",
        "list": "<ul><li hidden><p>a</p><li><p>b</p></ul>",
    }
    wrapped = {k: f"<h1>t</h1><time>x</time><article class=entry-content>{b}</article>" for k, b in bodies.items()}
    wrapped["headline"] = "<h1>a<i hidden>b</i><div hidden>c</div>d<p style=display:none>e</p>f</h1><article><p>x</p></article>"
    wrapped["author"] = "<h1>t</h1><b class=author hidden>By Desk</b><article><p>x</p></article>"
    got = {r.url: r for r in extract_lenient(pages(spark, wrapped)).collect()}
    assert {k: got[k].article_content for k in bodies} == {
        "verdict": "shown", "around": "cd", "invisible": "B", "own display": "a\nb", "ends": "y\nv",
        "words": "hidden words, display: none", "list": "b",
    }
    assert got["headline"].headline == "adf" and got["author"].author == ""
    strict = by_url(extract_strict(pages(spark, wrapped)), "article_content")
    assert strict["verdict"] == "  shown" and strict["around"] == " cd"


def test_hidden_elements_take_time_in_proportion(spark):
    def seconds(n):
        body = "<div hidden><p>a<b>b</b></p></div><p>c</p>" * n
        df = pages(spark, {"x": f"<h1>t</h1><article>{body}</article>"})
        start = time.perf_counter()
        row = extract_lenient(df).first()
        assert row.article_content == "\n".join("c" * n)
        return time.perf_counter() - start

    seconds(10)
    assert seconds(4000) < 8 * max(seconds(1000), 0.5)


def test_judged_pages_are_articles_and_rejects(spark, sf_dir):
    from newspipe.operators.articles import judge_strict
    from newspipe.plans import views

    site = views.site_pages(spark, sf_dir)
    judged = judge_strict(site).collect()
    fields = ["url", "headline", "date_published", "article_content"]
    kept = sorted((tuple(r[f] for f in fields) for r in judged if r.reason is None), key=repr)
    assert kept == sorted(map(tuple, extract_strict(site).collect()), key=repr)
    left = sorted((r.url, r.reason) for r in judged if r.reason)
    assert left == sorted(map(tuple, extract_rejects(site).collect()))
    assert len(judged) == site.count()
