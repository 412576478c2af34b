"""Inputs derived from the given tables.

The tables hold plain pages and documents. These views put every case the operators
tell apart into them, row by row and over the whole table, without a shuffle.
``SITE_HTML`` and ``LISTING_HTML`` are plain SQL that other engines can run too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Paragraphs that a browser does not show, or shows in part, and what is left of them.
HIDDEN_HTML = (
    '<p hidden>secret</p><p style="color:red; display:none">none <b>deep</b></p>'
    '<p>a<span style="visibility:hidden">un<i style="visibility:visible">seen</i></span></p>'
)
SHOWN_HTML = "<p></p><p></p><p>aseen</p>"

SITE_HTML = f"""case page_id % 6
 when 0 then replace(html, '<article>', '<article><meta property="article:published_time" content="2025-04-09T08:00:00Z"><span class="post-author">By Desk</span>{HIDDEN_HTML}')
 when 1 then replace(replace(html, '<article>', '<time datetime="2025-04-10">x</time><div class="entry-content">{HIDDEN_HTML}'), '</article>', '</div>')
 when 2 then replace(replace(html, '<article>', '<time datetime="2025-04-11">x</time><div class="dable-content-wrapper"></div><div class="entry-content">'), '</article>', '</div>')
 when 3 then replace(replace(html, '<article>', '<time>x</time><div class="article-content wide">'), '</article>', '</div>')
 when 4 then replace(replace(html, '<h1>', '<h2>'), '</h1>', '</h2>')
 else replace(html, '<article>', '<img class="author-avatar" src="a.png"><article>') end"""

LISTING_HTML = """case page_id % 3
 when 0 then replace(replace(html, '<li><a href=', '<section><article><a href='), '</a></li>', '</a></article></section>')
 when 1 then replace(html, '<li><a href=', '<li><a class="x penci-link-post penci-image-holder penci-disable-lazy" href=')
 else replace(html, '<a href="/the,"', '<a') end"""

# Listings that set the address their links are relative to, and those that do not.
BASE_HTML = """case page_id % 4
 when 1 then replace(html, '<head>', '<head><base href="https://cdn.example.org/b/c">')
 when 2 then replace(html, '<head>', '<head><base href="sub/x?y">')
 when 3 then replace(html, '<head>', '<head><base target="_top"><base href="/one/"><base href="/two/">')
 else html end"""

HREF_FORMS = """case pos % 5
 when 0 then href
 when 1 then substring(href, 2)
 when 2 then concat('//cdn.example.org', href)
 when 3 then concat('https://www.example.org', href)
 else concat('?next=', substring(href, 2)) end"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def site_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article pages: author and time, three wrappers, no headline, an empty author."""
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", "url", F.expr(SITE_HTML).alias("html"))


def byte_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article pages as bytes: UTF-8 and UTF-16 with byte-order mark, Latin-1 as far as a
    page can be written in it, and plain UTF-8."""
    html, form = F.col("html"), F.pmod("page_id", F.lit(5))
    mark = F.unhex(F.lit("EFBBBF"))
    latin = F.replace(html, F.lit("charset=\"utf-8\""), F.lit("charset=\"ISO-8859-1\""))
    content = (
        F.when(form == 0, F.concat(mark, F.encode(html, "UTF-8")))
        .when(
            (form == 1) & html.rlike(r"\A[\x00-\x7F\xA0-\xFF]*\z"),
            F.encode(F.regexp_replace(latin, r"[^\x00-\xFF]", "?"), "ISO-8859-1"),
        )
        .when(form == 2, F.concat(F.unhex(F.lit("FFFE")), F.encode(html, "UTF-16LE")))
        .when(form == 3, F.concat(F.unhex(F.lit("FEFF")), F.encode(html, "UTF-16BE")))
        .otherwise(F.encode(html, "UTF-8"))
    )
    return site_pages(spark, sf_dir).select("page_id", "url", content.alias("content"))


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing pages: nested links, links marked by classes, links without target."""
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", "url", F.expr(LISTING_HTML).alias("html"))


def news_items(spark: SparkSession, sf_dir: str, labelled: bool = False) -> DataFrame:
    """One API item per document; lists are null, empty or filled.

    Labelled items also have the ``duplicate`` flag. ``labels`` may grow with
    ``documents``, so how to join them is left to the optimizer and to adaptive
    execution; queries that do not look at the flag save the join.
    """
    items = table(spark, sf_dir, "documents")
    if labelled:
        labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
        items = items.join(labels, "doc_id", "left")
    return items.selectExpr(
        "cast(doc_id as string) as article_id",
        "substring(text, 1, 80) as title",
        "text as description",
        "concat('https://news.example.org/', doc_id) as link",
        "lang as language",
        """case when doc_id % 4 = 0 then null
                when doc_id % 4 = 1 then cast(array() as array<string>)
                else array(lang, source) end as keywords""",
        "array(case when doc_id % 2 = 0 then 'crime' else 'top' end, source) as category",
        "array(case when doc_id % 3 = 0 then 'us' else 'my' end) as country",
        "map('n', n_chars) as sentiment_stats",
        "doc_id div 100 as fetch_seq",
        "doc_id % 100 as pos",
        *(["toxic = 1 as duplicate"] if labelled else []),
    )


def raw_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same items as JSON text, null fields written out."""
    items = news_items(spark, sf_dir, labelled=True)
    text = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    return items.select(text.alias("raw"))


def api_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed API responses: one per document, one result per line of its text.

    Every 50th response has no results, every seventh no error flag, the last one no next
    page, and the one 80% of the way through failed.
    """
    documents = table(spark, sf_dir, "documents")
    item = F.transform(
        F.split("text", "\n"),
        lambda line, i: F.struct(
            F.concat_ws("-", "fetch_seq", i).alias("article_id"),
            F.left(line, F.lit(80)).alias("title"),
            line.alias("description"),
            F.concat(F.lit("https://news.example.org/"), "fetch_seq", F.lit("/"), i).alias("link"),
            F.col("lang").alias("language"),
            F.array(
                F.when((F.col("fetch_seq") + i) % 2 == 0, "crime").otherwise("top"), "source"
            ).alias("category"),
            F.array(F.when((F.col("fetch_seq") + i) % 3 == 0, "us").otherwise("my")).alias(
                "country"
            ),
        ),
    )
    # A one-row subquery; the scan that feeds it reads the key column only.
    last = documents.agg(F.max("doc_id")).scalar()
    landed = documents.withColumnRenamed("doc_id", "fetch_seq").withColumn("last", last)
    failed = F.col("fetch_seq") == F.floor(F.col("last") * 8 / 10)
    return landed.select(
        "fetch_seq",
        F.when(failed | (F.col("fetch_seq") % 7 != 3), failed).alias("error"),
        F.when(~failed & (F.col("fetch_seq") % 50 != 49), item).alias("results"),
        F.when(F.col("fetch_seq") < F.col("last"), (F.col("fetch_seq") + 1).cast("string")).alias(
            "nextPage"
        ),
    )


def cursor_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed responses without a number: each has the cursor it was fetched with."""
    landed = api_pages(spark, sf_dir)
    cursor = F.when(F.col("fetch_seq") != 0, F.col("fetch_seq").cast("string"))
    return landed.withColumn("cursor", cursor).drop("fetch_seq")


def event_messages(events: DataFrame, *more: Column) -> DataFrame:
    """Events as news messages, the record that travels on the wire."""
    return events.select(
        F.col("event_type").alias("title"),
        F.col("props").alias("content"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("pubDate"),
        F.concat(F.lit("https://news.example.org/"), "event_id").alias("link"),
        F.array("event_type", F.concat(F.lit("user "), "user_id")).alias("category"),
        *more,
    )
