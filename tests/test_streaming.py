"""Streams give what batches give, resume where they stopped, and can be bounded."""

import json

import pytest
from pyspark.sql import functions as F

from newspipe import (
    RowsRead,
    extract_lenient,
    extract_strict,
    finish,
    from_wire,
    limit_messages,
    live_counter,
    read_csv,
    rows_read,
    scratch_dir,
    stream_parquet,
    stream_table,
    to_wire,
)
from newspipe.plans import flows, views
from newspipe.schemas import LENIENT_ARTICLE, NEWS_MESSAGE, PAGE
from newspipe.sources.counter import counter_messages
from newspipe.streaming.runs import every


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("extract", [extract_lenient, extract_strict])
def test_stream_equals_batch(spark, sf_dir, extract):
    base = scratch_dir(spark, "equal")
    views.site_pages(spark, sf_dir).repartition(6).write.parquet(f"{base}/pages")
    stream = spark.readStream.schema(PAGE).option("maxFilesPerTrigger", 2).parquet(f"{base}/pages")
    query = stream_parquet(extract(stream), f"{base}/out", f"{base}/checkpoint")
    finish(query)
    assert rows_read(query) == 250
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    assert rows(spark.read.parquet(f"{base}/out")) == rows(extract(spark.read.parquet(f"{base}/pages")))


def test_restart_repeats_nothing_and_new_checkpoint_reads_again(spark):
    base = scratch_dir(spark, "restart")
    source, topic = f"{base}/source", spark.range(5).selectExpr("id")

    def run(checkpoint):
        wire = to_wire(spark.readStream.schema("id long").parquet(source))
        finish(stream_parquet(wire, f"{base}/out-{checkpoint}", f"{base}/{checkpoint}"))
        return spark.read.parquet(f"{base}/out-{checkpoint}").count()

    topic.write.parquet(source)
    assert run("a") == 5
    assert run("a") == 5
    topic.write.mode("append").parquet(source)
    assert run("a") == 10
    assert run("b") == 10


def test_pages_to_messages_to_csv(spark, sf_dir):
    base = scratch_dir(spark, "flow")
    pages = views.site_pages(spark, sf_dir)
    pages.write.parquet(f"{base}/pages")
    stream = stream_table(spark, f"{base}/pages", PAGE, max_bytes=2**20)
    finish(flows.publish_articles(stream, flows.to_table(f"{base}/topic", f"{base}/a")))
    wire = flows.read_topic(spark, f"{base}/topic")
    finish(flows.consume_to_csv(wire, LENIENT_ARTICLE, f"{base}/csv", f"{base}/b"))
    texts = ["author", "article_content"]  # CSV has no empty texts
    back = read_csv(spark, f"{base}/csv", LENIENT_ARTICLE).fillna("", texts)
    assert rows(back) == rows(extract_lenient(pages).fillna("", texts))


def test_broken_messages_do_not_stop_the_stream(spark):
    base = scratch_dir(spark, "broken")
    good = to_wire(spark.createDataFrame([("u", "h", None, None, "c")], LENIENT_ARTICLE))
    good.unionByName(counter_messages(spark.range(20), "id")).write.parquet(f"{base}/topic")
    wire = flows.read_topic(spark, f"{base}/topic")
    finish(stream_parquet(from_wire(wire, LENIENT_ARTICLE), f"{base}/out", f"{base}/c"))
    assert rows(spark.read.parquet(f"{base}/out")) == [("u", "h", None, None, "c")]


@pytest.mark.parametrize("most, want", [(12, 12), (None, 50), (0, 50)])
def test_bounded_stream(spark, most, want):
    base = scratch_dir(spark, "bounded")
    spark.range(50).repartition(4).write.parquet(f"{base}/in")
    stream = spark.readStream.schema("id long").parquet(f"{base}/in")
    finish(stream_parquet(limit_messages(stream, most), f"{base}/out", f"{base}/c"))
    assert spark.read.parquet(f"{base}/out").count() == want


def test_table_stream_reads_a_file_and_a_folder(spark, sf_dir):
    base = scratch_dir(spark, "table")
    events = views.table(spark, sf_dir, "events")
    events.repartition(3).write.parquet(f"{base}/events.parquet")
    for name, path in (("file", f"{sf_dir}/events.parquet"), ("folder", f"{base}/events.parquet")):
        stream = stream_table(spark, path, events.schema).select("event_id")
        finish(stream_parquet(stream, f"{base}/{name}", f"{base}/c-{name}"))
        out = spark.read.parquet(f"{base}/{name}")
        assert out.count() == out.select(F.countDistinct("event_id")).first()[0] == events.count()


def test_live_forms_are_streams(spark):
    counter = live_counter(spark)
    assert counter.isStreaming and counter.schema.simpleString() == "struct<value:binary>"
    assert every(60) == {"processingTime": "60 seconds"}


def test_rows_are_counted_over_more_batches_than_reports_are_kept(spark):
    base = scratch_dir(spark, "progress")
    spark.range(80).repartition(20).write.parquet(f"{base}/in")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "5")
    try:
        stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
        query = stream_parquet(stream, f"{base}/out", f"{base}/c")
        rows = RowsRead(query)
        while not query.awaitTermination(timeout=0.05):
            rows.look()
        assert rows.total == 80
        with pytest.raises(RuntimeError):
            rows_read(query)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


@pytest.mark.parametrize("name", ["plain/", "a b.c", "x-(1)"])
def test_table_stream_takes_any_folder(spark, tmp_path, name):
    spark.range(3).write.parquet(f"{tmp_path}/{name}")
    stream = stream_table(spark, f"{tmp_path}/{name}", spark.range(0).schema, max_bytes=1 << 20)
    assert finish(stream_parquet(stream, f"{tmp_path}/out", f"{tmp_path}/c")) == 3


@pytest.mark.parametrize("name", ["a[1]", "b{c}", "d*e", "f?"])
def test_table_stream_refuses_names_that_are_patterns(spark, name):
    with pytest.raises(ValueError):
        stream_table(spark, f"/data/{name}", spark.range(0).schema)


def test_a_run_in_steps_equals_one_step(spark, sf_dir):
    base = scratch_dir(spark, "steps")
    events = views.event_messages(views.table(spark, sf_dir, "events"))
    to_wire(events).repartition(8).write.parquet(f"{base}/topic")
    wire = flows.read_topic(spark, f"{base}/topic", max_bytes=1)
    query = stream_parquet(from_wire(wire, NEWS_MESSAGE), f"{base}/out", f"{base}/c")
    assert finish(query) == events.count()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) > 1
    assert rows(spark.read.parquet(f"{base}/out")) == rows(events)


def test_publishing_continuously(spark, tmp_path):
    (tmp_path / "landing").mkdir()
    items = [
        {"title": "a", "category": ["crime"], "language": "en"},
        {"title": "b", "category": ["top"], "language": "en"},
        {"title": "c", "category": ["crime"], "language": "fr"},
    ]
    for i in range(3):
        page = {"fetch_seq": i, "results": items, "nextPage": "x"}
        (tmp_path / "landing" / f"{i}.json").write_text(json.dumps(page))
    send = flows.to_table(f"{tmp_path}/topic", f"{tmp_path}/c")
    assert finish(flows.publish_continuously(spark, f"{tmp_path}/landing", send, max_files=1)) == 3
    wire = spark.read.parquet(f"{tmp_path}/topic")
    assert [r.title for r in from_wire(wire, NEWS_MESSAGE).collect()] == ["a"] * 3


def test_kafka_flows_are_wired(monkeypatch, spark):
    sent = []
    monkeypatch.setattr(flows, "stream_kafka", lambda *a: sent.append(a))
    flows.publish_articles(
        spark.createDataFrame([("u", "<h1>t</h1>")], "url string, html string"),
        flows.to_kafka("host:1", "topic", "/c"),
    )
    assert sent[0][0].columns == ["value"] and sent[0][1:] == ("host:1", "topic", "/c", None)
    topic = to_wire(spark.readStream.format("rate").load())
    monkeypatch.setattr(flows, "read_kafka", lambda *a, **k: topic if a[1:] == ("host:1", "t") else None)
    monkeypatch.setattr(flows, "stream_csv", lambda df, *a: (df.columns, a))
    columns, rest = flows.consume_topic_to_csv(spark, "host:1", "t", NEWS_MESSAGE, "/p", "/c")
    assert columns == NEWS_MESSAGE.names and rest == ("/p", "/c", NEWS_MESSAGE.names, None, None)
