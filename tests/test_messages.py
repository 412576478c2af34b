"""API pages, message selection and the wire format."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from newspipe import (
    BATCH_QUERY,
    add_section_urls,
    collected_pages,
    counter_source,
    explode_results,
    filter_news,
    from_wire,
    get_session,
    landed_items,
    landed_pages,
    limit_messages,
    project_news,
    read_api_pages,
    section_urls,
    to_wire,
    wire_rejects,
)
from newspipe.plans import flows
from newspipe.schemas import LENIENT_ARTICLE, NEWS_MESSAGE
from newspipe.sinks.kafka import sink_options
from newspipe.sources.kafka import source_options


def landed(spark, tmp_path, pages):
    path = tmp_path / "landing"
    path.mkdir()
    (path / "a.json").write_text("\n".join(json.dumps(p) for p in pages))
    return landed_pages(spark, str(path))


def page(seq, titles, following, error=False):
    return {
        "fetch_seq": seq,
        "error": error,
        "results": None if titles is None else [{"title": t} for t in titles],
        "nextPage": following,
    }


@pytest.mark.parametrize(
    "pages, want",
    [
        ([page(0, "ab", "1"), page(1, "c", None), page(2, "d", "3")], "abc"),
        ([page(0, "ab", "1"), page(1, "c", ""), page(2, "d", None)], "abc"),
        ([page(0, "ab", "1"), page(1, "c", "2", error=True), page(2, "d", None)], "ab"),
        ([page(0, "ab", None, error=True)], ""),
        ([page(0, "ab", "1"), page(1, "c", "2")], "abc"),
        ([page(0, None, "1"), page(1, "", "2"), page(2, "aa", None)], "aa"),
        ([page(2, "c", None), page(0, "a", "1"), page(1, "a", "2")], "aac"),
    ],
)
def test_fetch_stops_where_the_loop_would(spark, tmp_path, pages, want):
    items = read_api_pages(landed(spark, tmp_path, pages))
    rows = items.orderBy("fetch_seq", "pos").collect()
    assert "".join(json.loads(r.raw)["title"] for r in rows) == want


def test_raw_items_can_be_asked_for_by_value(spark, tmp_path):
    items = [
        {"title": "a", "country": ["us"], "category": ["crime", "top"], "language": "en"},
        {"title": "b", "country": ["my"], "category": ["crime"], "language": "en"},
        {"title": "c", "country": None, "category": ["crime"], "language": "en"},
    ]
    df = landed(spark, tmp_path, [{"fetch_seq": 0, "error": False, "results": items}])
    assert [json.loads(r.raw)["title"] for r in read_api_pages(df, **BATCH_QUERY).collect()] == ["a"]
    assert read_api_pages(df, category="crime").columns == ["fetch_seq", "pos", "raw"]
    assert read_api_pages(df, category="crime").count() == 3


def test_publishing_hands_messages_to_the_sink(spark):
    df = spark.range(9).selectExpr("0 as fetch_seq", "id as pos", "string(id) as title")
    sent = flows.publish_news(df, lambda wire: wire.collect(), max_messages=2)
    assert [json.loads(bytes(r.value))["title"] for r in sent] == ["0", "1"]


def test_a_running_session_is_kept(spark):
    assert get_session("other", **{"spark.sql.shuffle.partitions": "99"}) is spark
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"


def test_a_missing_next_page_is_an_end(spark, tmp_path):
    df = landed(spark, tmp_path, [{"fetch_seq": 0, "results": []}, page(1, "a", None)])
    assert collected_pages(df).count() == 1
    assert explode_results(df).count() == 1


def test_a_missing_error_flag_is_no_failure(spark, tmp_path):
    pages = [page(0, "a", "1"), page(1, "b", "2"), page(2, "c", None), page(3, "d", None)]
    df = landed(spark, tmp_path, [{k: v for k, v in p.items() if k != "error"} for p in pages])
    assert [json.loads(r.raw)["title"] for r in read_api_pages(df).collect()] == ["a", "b", "c"]


def test_a_line_that_is_no_json_neither_ends_a_fetch_nor_gives_items(spark, tmp_path):
    df = landed(spark, tmp_path, [page(0, "a", "1"), page(1, "b", None)])
    path = str(tmp_path / "broken")
    df.select(F.to_json(F.struct("*")).alias("value")).union(
        spark.createDataFrame([("no json",)], "value string")
    ).coalesce(1).write.text(path)
    assert read_api_pages(landed_pages(spark, path)).count() == 2


def test_landed_items_get_the_columns_their_keys_give(spark, tmp_path):
    (tmp_path / "items.json").write_text('{"title": "a", "n": 1}\n{"title": "b", "tags": ["x"]}\n')
    df = landed_items(spark, str(tmp_path / "items.json"))
    assert dict(df.dtypes) == {"n": "bigint", "tags": "array<string>", "title": "string"}
    assert df.count() == 2


def test_every_json_object_is_a_record_and_nothing_else(spark):
    good = {
        '{"title":"x","category":"crime"}': ("x", ["crime"]),
        '{"title":"x","category":["a","b"]}': ("x", ["a", "b"]),
        '{"title":"x","category":{"k":1}}': ("x", ['{"k":1}']),
        '{"title":["a","b"],"category":null}': ("a, b", None),
        '{"title":{"k":1},"zz":2}': ('{"k": 1}', None),
        '{"title":"[Breaking] news"}': ("[Breaking] news", None),
        '{"title":"{x"}': ("{x", None),
        '{"title":5}': ("5", None),
        ' {} ': (None, None),
        '{"title":"a","title":"b"}': ("b", None),
    }
    bad = [
        "{'title':'single'}", '{"title":"trail"} junk', '{"a":1},{"b":2}', '{"a":1}]junk[', "[]",
        '["a"]', "null", "0 cats", "", '{"a":', '"text"', None,
    ]
    texts = [*good, *bad]
    wire = spark.createDataFrame([(t,) for t in texts], "value string").selectExpr(
        "cast(value as binary) value"
    )
    schema = StructType(
        [StructField("title", StringType()), StructField("category", ArrayType(StringType()))]
    )
    assert [(r.title, r.category) for r in from_wire(wire, schema).collect()] == list(good.values())
    rejected = [None if r.value is None else bytes(r.value).decode() for r in wire_rejects(wire, schema).collect()]
    assert rejected == bad


def test_fetch_report_and_typed_table(spark, tmp_path):
    df = landed(spark, tmp_path, [page(0, "abc", "1"), page(1, "de", None)])
    report = flows.fetch_report(df, count=4)
    assert report.total.first().n == 5
    assert [json.loads(r.raw)["title"] for r in report.first.collect()] == list("abcd")
    assert [r.key for r in report.keys.collect()] == ["title"]
    typed = flows.typed_news(df)
    assert len(typed.columns) == 25
    assert sorted(r.title for r in typed.collect()) == list("abcde")


def test_filters_are_optional_and_combine(spark):
    df = spark.createDataFrame(
        [
            (1, ["us"], ["crime", "top"], "en"),
            (2, ["my"], ["crime"], "en"),
            (3, ["us"], ["top"], "en"),
            (4, ["us"], ["crime"], None),
            (5, None, ["crime"], "en"),
        ],
        "id int, country array<string>, category array<string>, language string",
    )
    ids = lambda d: sorted(r.id for r in d.collect())
    assert ids(filter_news(df)) == [1, 2, 3, 4, 5]
    assert ids(filter_news(df, category="crime", language="en")) == [1, 2, 5]
    assert ids(filter_news(df, **BATCH_QUERY)) == [1]


def test_projection_takes_the_description_for_content(spark):
    df = spark.createDataFrame(
        [("t", "d", "own", ["c"])], "title string, description string, content string, category array<string>"
    )
    out = project_news(df)
    assert out.schema.names == NEWS_MESSAGE.names
    assert tuple(out.first()) == ("t", "d", None, None, ["c"])


@pytest.mark.parametrize("most, want", [(None, 30), (0, 30), (12, 12), (31, 30)])
def test_limit(spark, most, want):
    df = spark.range(30).repartition(4)
    ids = [r.id for r in limit_messages(df, most, ("id",)).orderBy("id").collect()]
    assert ids == list(range(want))


def test_negative_limit_is_refused(spark):
    with pytest.raises(ValueError):
        limit_messages(spark.range(3), -1)


def test_wire_keeps_nulls_and_text(spark):
    rows = [("u", "é😀\"\\\n/", None, None, ""), ("", " \t", "a", "b", "c")]
    df = spark.createDataFrame(rows, LENIENT_ARTICLE)
    wire = to_wire(df)
    assert wire.schema.simpleString() == "struct<value:binary>"
    sent = sorted((json.loads(bytes(r.value)) for r in wire.collect()), key=lambda d: d["url"])
    assert [tuple(d.values()) for d in sent] == sorted(rows)
    assert list(sent[0]) == LENIENT_ARTICLE.names
    assert sorted(map(tuple, from_wire(wire, LENIENT_ARTICLE).collect())) == sorted(rows)
    plain = to_wire(df, ascii_only=True)
    assert all(bytes(r.value).isascii() for r in plain.collect())
    assert sorted(map(tuple, from_wire(plain, LENIENT_ARTICLE).collect())) == sorted(rows)


def test_unreadable_messages_go_to_the_rejects(spark):
    good = [b'{"title":"a","zz":1}', b'{"category":["x"]}', b"{}", b' {"title":null}', b'{"category":5}']
    bad = [b"0 cats", b"", b"null", b"5", b'"x"', b"[]", b'[{"title":"a"}]', b'{"title":', b'{"title":"\xff"}']
    df = spark.createDataFrame([(bytearray(v),) for v in [*good, *bad, None] if v is not None], "value binary")
    records = from_wire(df, NEWS_MESSAGE)
    assert records.columns == NEWS_MESSAGE.names
    assert sorted((r.title or "", r.category or []) for r in records.collect()) == [
        ("", []), ("", []), ("", ["5"]), ("", ["x"]), ("a", []),
    ]
    assert sorted(bytes(r.value) for r in wire_rejects(df, NEWS_MESSAGE).collect()) == sorted(bad)


def test_news_messages_follow_arrival_order(spark):
    df = spark.range(30).selectExpr(
        "id div 10 as fetch_seq", "9 - id % 10 as pos", "string(id) as title"
    )
    wire = flows.news_messages(df.repartition(5), max_messages=3)
    assert sorted(json.loads(bytes(r.value))["title"] for r in wire.collect()) == ["7", "8", "9"]


@pytest.mark.parametrize("count, want", [(-1, 1), (0, 1), (1, 1), (2, 2), (3, 3)])
def test_section_urls(spark, count, want):
    base = "https://a.example.org/c/"
    urls = [r.section_url for r in section_urls(spark, base, count).orderBy("page").collect()]
    assert urls == [base, f"{base}page/2/", f"{base}page/3/"][:want]


def test_section_urls_per_row(spark):
    df = spark.createDataFrame([("a/", 0), ("b/", 2)], "base string, n int")
    rows = add_section_urls(df, "base", F.col("n")).collect()
    assert sorted(r.section_url for r in rows) == ["a/", "b/", "b/page/2/"]


def test_counter(spark):
    values = [bytes(r.value).decode() for r in counter_source(spark).collect()]
    assert values == [f"{n} cats" for n in range(20)]


def test_kafka_options():
    assert source_options("h:9092", "t") == {
        "kafka.bootstrap.servers": "h:9092",
        "subscribe": "t",
        "startingOffsets": "earliest",
    }
    more = source_options("h:9092", "t", group_id="g", max_per_trigger=100)
    assert more["kafka.group.id"] == "g" and more["maxOffsetsPerTrigger"] == "100"
    assert sink_options("h:9092", "t") == {"kafka.bootstrap.servers": "h:9092", "topic": "t"}
