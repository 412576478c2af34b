"""Every operator as a query over the given tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.values import label
from ..operators import analyze, articles, links, messages, normalize, ordered
from ..profiles import CHILD_CHAIN, CLASS_TOKENS
from ..schemas import NEWS_MESSAGE, STRICT_ARTICLE, STRICT_CSV_NAMES, text_fields
from ..session import scratch_dir
from ..sinks import csv
from ..sources import counter, pages, responses
from ..streaming import appends, runs
from . import flows, views

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

# Large enough that files stay worth opening, small enough to be read by one task.
BYTES_PER_FILE = 128 << 20
# What a step of a stream reads, so that a restart repeats no more than that.
BYTES_PER_STEP = 1 << 30


def query(run: Query) -> Query:
    REGISTRY[run.__name__] = run
    return run


# --- sources ----------------------------------------------------------------


@query
def scan_pages(spark, sf_dir):
    return pages.scan_pages(spark, f"{sf_dir}/pages.parquet")


@query
def section_urls(spark, sf_dir):
    """Section pages of every stored address, 0 to 3 of them asked for."""
    bases = views.table(spark, sf_dir, "pages").select(
        "page_id", F.regexp_extract("url", r"^([^?#]*)", 1).alias("base_url")
    )
    return pages.add_section_urls(bases, "base_url", F.col("page_id") % 4)


@query
def counter_source(spark, sf_dir):
    events = views.table(spark, sf_dir, "events")
    value = F.decode("value", "UTF-8").alias("value")
    return counter.counter_messages(events, "event_id").select(value)


# --- pages ------------------------------------------------------------------


@query
def links_child_chain(spark, sf_dir):
    return links.extract_links(views.listing_pages(spark, sf_dir), CHILD_CHAIN)


@query
def links_class_tokens(spark, sf_dir):
    return links.extract_links(views.listing_pages(spark, sf_dir), CLASS_TOKENS)


@query
def links_resolved(spark, sf_dir):
    """Links in five spellings, made absolute on pages with and without a base."""
    pages = views.listing_pages(spark, sf_dir).withColumn("html", F.expr(views.BASE_HTML))
    found = links.extract_links(pages, CLASS_TOKENS, base="base")
    spelled = found.withColumn("href", F.expr(views.HREF_FORMS))
    return links.resolve_links(spelled, base="base").drop("base")


@query
def extract_lenient(spark, sf_dir):
    return articles.extract_lenient(views.site_pages(spark, sf_dir))


@query
def extract_strict(spark, sf_dir):
    return articles.extract_strict(views.site_pages(spark, sf_dir))


@query
def extract_rejects(spark, sf_dir):
    return articles.extract_rejects(views.site_pages(spark, sf_dir))


@query
def extract_judged(spark, sf_dir):
    """Strict articles and the reasons of rejected pages, from one extraction."""
    return articles.judge_strict(views.site_pages(spark, sf_dir))


@query
def extract_from_bytes(spark, sf_dir):
    """Lenient articles of pages stored as bytes in four character sets."""
    return articles.extract_lenient(pages.decoded_pages(views.byte_pages(spark, sf_dir)))


@query
def count_scrape(spark, sf_dir):
    """How many links and articles each kind of site gives, in one pass for each view."""
    site, listing = views.site_pages(spark, sf_dir), views.listing_pages(spark, sf_dir)
    counts = [
        analyze.count_each(
            articles.visible_pages(site),
            {"lenient articles": articles.is_lenient(), "strict articles": articles.is_strict()},
        ),
        analyze.count_each(
            listing,
            {
                "lenient links": links.count_links(CHILD_CHAIN),
                "strict links": links.count_links(CLASS_TOKENS),
            },
        ),
    ]
    return reduce(DataFrame.unionByName, counts)


# --- API items --------------------------------------------------------------


@query
def api_fetch_all(spark, sf_dir):
    items = responses.read_api_pages(views.api_pages(spark, sf_dir))
    return normalize.flatten(items)


@query
def api_fetch_by_cursor(spark, sf_dir):
    """The same from responses that only name the next one."""
    return normalize.flatten(responses.read_api_pages(views.cursor_pages(spark, sf_dir)))


@query
def api_filter(spark, sf_dir):
    found = messages.filter_news(views.news_items(spark, sf_dir), **messages.BATCH_QUERY)
    return found.select("article_id", "title", "link", "language")


@query
def api_project(spark, sf_dir):
    return normalize.flatten(messages.project_news(views.news_items(spark, sf_dir)))


@query
def publish_limited(spark, sf_dir):
    """The first 12 messages in arrival order."""
    items = views.news_items(spark, sf_dir)
    first = messages.limit_messages(items, 12, order=("fetch_seq", "pos"))
    return normalize.flatten(messages.project_news(first))


@query
def publish_prefix(spark, sf_dir):
    """The first third of all messages in arrival order, too many for one task."""
    items = views.news_items(spark, sf_dir)
    first = ordered.first_rows(items, items.count() // 3, ("fetch_seq", "pos"), in_one_task=0)
    return normalize.flatten(messages.project_news(first))


@query
def sample_news(spark, sf_dir):
    first = analyze.sample(views.news_items(spark, sf_dir), 5)
    return first.select("fetch_seq", "pos", "article_id", "title", "link")


@query
def count_news(spark, sf_dir):
    return analyze.count_rows(responses.read_api_pages(views.api_pages(spark, sf_dir)))


@query
def key_union(spark, sf_dir):
    return analyze.key_union(views.raw_items(spark, sf_dir), "raw")


@query
def fill_missing(spark, sf_dir):
    items = views.news_items(spark, sf_dir)
    is_crime = F.coalesce(F.array_contains("category", "crime"), F.lit(False))
    crime, other = items.filter(is_crime), items.filter(~is_crime)
    return normalize.fill_missing(
        crime.select("article_id", "title", "fetch_seq"),
        other.select("article_id", "link", "language"),
    )


@query
def flatten_lists(spark, sf_dir):
    items = views.news_items(spark, sf_dir)
    return normalize.flatten(items.select("article_id", "keywords", "category", "country", "pos"))


@query
def flatten_dicts(spark, sf_dir):
    items = views.news_items(spark, sf_dir)
    nested = F.struct("title", "pos", F.array("language").alias("languages"))
    return normalize.flatten(
        items.select("article_id", "sentiment_stats", nested.alias("nested"))
    )


@query
def news_typed(spark, sf_dir):
    return normalize.flatten_raw(views.raw_items(spark, sf_dir), "raw")


@query
def headline_label(spark, sf_dir):
    documents = views.table(spark, sf_dir, "documents")
    return documents.select(
        "doc_id",
        label(F.col("text")).alias("saved"),
        label(F.col("text"), suffix="...").alias("sending"),
    )


# --- wire and files ---------------------------------------------------------


def _event_messages(spark, sf_dir):
    return views.event_messages(views.table(spark, sf_dir, "events"))


@query
def wire_encode(spark, sf_dir):
    wire = messages.to_wire(_event_messages(spark, sf_dir))
    return wire.select(F.decode("value", "UTF-8").alias("value"))


@query
def wire_decode(spark, sf_dir):
    """Messages whose category is a list, a plain text or an object."""
    events = views.table(spark, sf_dir, "events")
    form = F.coalesce(F.pmod("event_id", F.lit(3)), F.lit(0))
    spelled = {
        0: F.col("category"),
        1: F.col("title"),
        2: F.struct(F.col("title").alias("type")),
    }
    sent = views.event_messages(events, form.alias("form"))
    texts = NEWS_MESSAGE.names[:-1]
    values = [
        F.when(F.col("form") == k, messages.wire_value(*texts, category.alias("category")))
        for k, category in spelled.items()
    ]
    wire = sent.select(F.coalesce(*values).alias("value"))
    return normalize.flatten(messages.from_wire(wire, NEWS_MESSAGE))


@query
def wire_decode_rejects(spark, sf_dir):
    """Every third event arrives as a plain counter message."""
    events = views.table(spark, sf_dir, "events")
    plain = F.coalesce(F.pmod("event_id", F.lit(3)) == 0, F.lit(False))
    wire = messages.to_wire(views.event_messages(events.filter(~plain))).unionByName(
        counter.counter_messages(events.filter(plain), "event_id")
    )
    rejects = messages.wire_rejects(wire, NEWS_MESSAGE)
    return rejects.select(F.decode("value", "UTF-8").alias("value"))


@query
def csv_roundtrip_article(spark, sf_dir):
    """Documents as articles under the spaced date name; empty dates come back null."""
    documents = views.table(spark, sf_dir, "documents")
    path = scratch_dir(spark, "articles.csv")
    csv.write_csv(
        documents.select(
            F.concat(F.lit("https://news.example.org/"), "doc_id").alias("url"),
            F.left("text", F.lit(60)).alias("headline"),
            F.when(F.col("doc_id") % 2 == 0, "").otherwise(F.col("lang")).alias("date_published"),
            F.col("text").alias("article_content"),
        ),
        path,
        STRICT_ARTICLE.names,
        rename=STRICT_CSV_NAMES,
        max_bytes_per_file=BYTES_PER_FILE,
    )
    names = [STRICT_CSV_NAMES.get(name, name) for name in STRICT_ARTICLE.names]
    back = csv.read_csv(spark, path, text_fields(*names))
    return back.withColumnRenamed("date of published", "date_published")


@query
def csv_roundtrip_news(spark, sf_dir):
    """Raw items written under the union of their keys."""
    path = scratch_dir(spark, "news.csv")
    keys = csv.write_raw_csv(
        views.raw_items(spark, sf_dir), "raw", path, max_bytes_per_file=BYTES_PER_FILE
    )
    return csv.read_csv(spark, path, text_fields(*keys))


@query
def csv_marked(spark, sf_dir):
    """Event messages in CSV files that start with a byte-order mark."""
    path = scratch_dir(spark, "marked.csv")
    csv.write_csv(_event_messages(spark, sf_dir), path, byte_order_mark=True)
    return csv.read_csv(spark, path, text_fields(*NEWS_MESSAGE.names))


@query
def append_csv(spark, sf_dir):
    """Two appends to one folder, no matter which comes first."""
    path = scratch_dir(spark, "appended.csv")
    items = _event_messages(spark, sf_dir)
    for batch in (items.filter("title <=> 'click'"), items.filter("not title <=> 'click'")):
        flows.append_news(batch, path, max_bytes_per_file=BYTES_PER_FILE)
    return csv.read_csv(spark, path, text_fields(*NEWS_MESSAGE.names))


# --- streams ----------------------------------------------------------------


def _stream(spark, sf_dir, name):
    schema = views.table(spark, sf_dir, name).schema
    return runs.stream_table(spark, f"{sf_dir}/{name}.parquet", schema, BYTES_PER_STEP)


def _published_events(spark, sf_dir, base):
    """A topic of event messages that carry one key more than consumers expect."""
    events = _stream(spark, sf_dir, "events")
    wire = messages.to_wire(views.event_messages(events).withColumn("unexpected", F.lit(1)))
    runs.finish(runs.stream_parquet(wire, f"{base}/topic", f"{base}/publish"))
    return flows.read_topic(spark, f"{base}/topic", BYTES_PER_STEP)


@query
def stream_consume(spark, sf_dir):
    base = scratch_dir(spark, "consume")
    wire = _published_events(spark, sf_dir, base)
    records = normalize.flatten(messages.from_wire(wire, NEWS_MESSAGE))
    runs.finish(runs.stream_parquet(records, f"{base}/records", f"{base}/consume"))
    return spark.read.parquet(f"{base}/records")


@query
def stream_consume_csv(spark, sf_dir):
    base = scratch_dir(spark, "consume-csv")
    wire = _published_events(spark, sf_dir, base)
    runs.finish(flows.consume_to_csv(wire, NEWS_MESSAGE, f"{base}/csv", f"{base}/consume"))
    return csv.read_csv(spark, f"{base}/csv", text_fields(*NEWS_MESSAGE.names))


@query
def stream_append_csv(spark, sf_dir):
    """A stream and a batch that append to one folder, as files that any reader finds."""
    base = scratch_dir(spark, "append")
    path = f"{base}/csv"
    items = views.event_messages(_stream(spark, sf_dir, "events"))
    runs.finish(
        appends.append_csv_stream(
            items.filter("title <=> 'click'"), path, f"{base}/steps", max_records_per_file=None
        )
    )
    flows.append_news(_event_messages(spark, sf_dir).filter("not title <=> 'click'"), path)
    return csv.read_csv(spark, path, text_fields(*NEWS_MESSAGE.names))


@query
def stream_judged(spark, sf_dir):
    """Records and rejects of one topic side by side; every third message is plain text."""
    base = scratch_dir(spark, "judged")
    events = _stream(spark, sf_dir, "events")
    plain = F.coalesce(F.pmod("event_id", F.lit(3)) == 0, F.lit(False))
    sent = views.event_messages(events, plain.alias("plain"), F.col("event_id"))
    value = F.when(F.col("plain"), counter.counter_value(F.col("event_id"))).otherwise(
        messages.wire_value(*NEWS_MESSAGE.names)
    )
    judged = messages.judged_wire(sent.select(value.alias("value")), NEWS_MESSAGE)
    runs.finish(runs.stream_judged(judged, "readable", f"{base}/judged", f"{base}/steps"))
    both = runs.read_judged(spark, f"{base}/judged", "readable")
    return normalize.flatten(both.withColumn("value", F.decode("value", "UTF-8")))


@query
def stream_extract_strict(spark, sf_dir):
    """Pages to messages in one query, messages to records in a second one."""
    base = scratch_dir(spark, "strict")
    site = _stream(spark, sf_dir, "pages").select(
        "url", F.expr(views.SITE_HTML).alias("html")
    )
    send = flows.to_table(f"{base}/topic", f"{base}/publish")
    runs.finish(flows.publish_articles(site, send, strict=True))
    wire = flows.read_topic(spark, f"{base}/topic", BYTES_PER_STEP)
    records = messages.from_wire(wire, STRICT_ARTICLE)
    runs.finish(runs.stream_parquet(records, f"{base}/records", f"{base}/consume"))
    return spark.read.parquet(f"{base}/records")


@query
def stream_api_project(spark, sf_dir):
    """Landed responses as a stream; every page counts, there is no stop."""
    base = scratch_dir(spark, "api")
    landed = views.api_pages(spark, sf_dir)
    landed.write.json(f"{base}/landing")
    item = landed.schema["results"].dataType.elementType
    stream = responses.landed_pages(
        spark, f"{base}/landing", item, stream=True, maxBytesPerTrigger=BYTES_PER_STEP
    )
    news = normalize.flatten(messages.project_news(responses.explode_results(stream)))
    runs.finish(runs.stream_parquet(news, f"{base}/news", f"{base}/publish"))
    return spark.read.parquet(f"{base}/news")
