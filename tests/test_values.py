"""Flattening, filling, typing and profiling of API items."""

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from newspipe import (
    conform,
    count_rows,
    counted,
    fill_missing,
    flatten,
    flatten_raw,
    key_list,
    key_union,
    label,
    sample,
)
from newspipe.functions.values import spaced_json
from newspipe.schemas import NEWS_ITEM


def test_flatten_lists(spark):
    df = spark.createDataFrame(
        [(1, []), (2, ["a"]), (3, ["a", "b"]), (4, None), (5, ["a", None])],
        "id int, v array<string>",
    )
    assert [r.v for r in flatten(df).orderBy("id").collect()] == [None, "a", "a, b", None, "a"]


def test_flatten_dicts_and_scalars(spark):
    df = spark.createDataFrame(
        [({}, (1, None), 2.5, True, "[x]"), ({"a": 1}, (2, "é"), None, None, None)],
        "m map<string,int>, s struct<x:int,y:string>, d double, b boolean, t string",
    )
    rows = [tuple(r) for r in flatten(df).collect()]
    assert rows == [
        ("{}", '{"x": 1, "y": null}', 2.5, True, "[x]"),
        ('{"a": 1}', '{"x": 2, "y": "é"}', None, None, None),
    ]


JSON_VALUES = st.recursive(
    st.none() | st.booleans() | st.integers(-(10**6), 10**6) | st.text(max_size=8),
    lambda v: st.lists(v, max_size=3) | st.dictionaries(st.text(max_size=4), v, max_size=3),
    max_leaves=8,
)


@settings(max_examples=15, deadline=None)
@given(st.lists(JSON_VALUES, min_size=1, max_size=20))
def test_spaced_json_is_the_usual_spacing(spark, values):
    compact = [(json.dumps(v, separators=(",", ":")),) for v in values]
    df = spark.createDataFrame(compact, "t string").coalesce(1)
    got = [r[0] for r in df.select(spaced_json(F.col("t"))).collect()]
    assert got == [json.dumps(v) for v in values]


def test_spaced_json_copes_with_long_strings(spark):
    value = {"a": 'x,:"\\' * 20_000, "b": ["," * 20_000]}
    df = spark.createDataFrame([(json.dumps(value, separators=(",", ":")),)], "t string")
    assert df.select(spaced_json(F.col("t"))).first()[0] == json.dumps(value)


def test_raw_items_are_told_apart_by_value(spark):
    items = [
        {"title": "[a]", "keywords": ["x", "y"], "sentiment_stats": {"z": 1.50, "a": {"q": [1, 2]}}},
        {"title": '["a"]', "keywords": "plain", "duplicate": True, "extra": 1},
        {"title": "true", "keywords": [], "source_priority": 12, "duplicate": "true"},
        {"title": None, "keywords": None, "source_priority": 1.0, "content": True, "duplicate": False},
        {"title": "", "keywords": [1, None, "b"], "source_priority": 1e30, "sentiment_stats": {}},
    ]
    df = spark.createDataFrame([(json.dumps(i),) for i in items], "raw string").coalesce(1)
    rows = flatten_raw(df, "raw").collect()
    assert rows[0].asDict().keys() == set(NEWS_ITEM.names)
    assert [r.title for r in rows] == ["[a]", '["a"]', "true", None, ""]
    assert [r.keywords for r in rows] == ["x, y", "plain", None, None, "1, b"]
    assert [r.source_priority for r in rows] == [None, None, "12", "1.0", "1.0E30"]
    assert [r.duplicate for r in rows] == [None, True, None, False, None]
    assert [r.sentiment_stats for r in rows] == [
        '{"z": 1.5, "a": {"q": [1, 2]}}', None, None, None, "{}",
    ]
    assert rows[3].content == "true" and rows[0].creator is None
    titled = flatten_raw(df, "raw", titled_booleans=True).collect()
    assert titled[3].content == "True" and titled[2].title == "true"


def test_raw_items_that_repeat_keys_or_are_broken(spark):
    raws = {
        '{"title":"a","title":"b","link":"x"}': ("b", "x", None, None, None),
        '{"link":"x","sentiment_stats":{"k":1,"k":2},"keywords":["a","b"],"duplicate":true}': (
            None, "x", "a, b", '{"k": 1, "k": 2}', True,
        ),
        '{"title":"cut': (None,) * 5,
        "[1]": (None,) * 5,
        '{"title":NaN,"link":"\\ud83d\\ude00"}': ("NaN", "😀", None, None, None),
    }
    df = spark.createDataFrame([(r,) for r in raws], "raw string").coalesce(1)
    rows = flatten_raw(df, "raw").select("title", "link", "keywords", "sentiment_stats", "duplicate")
    assert [tuple(r) for r in rows.collect()] == list(raws.values())


def test_raw_items_with_odd_keys(spark):
    raw = json.dumps({"a.b": 1, "c'd": ["x"], "e f": {"g": 2}, 'h"i': "j"})
    df = spark.createDataFrame([(raw,)], "raw string")
    keys = key_list(df, "raw")
    assert keys == sorted(["a.b", "c'd", "e f", 'h"i'])
    schema = StructType([StructField(k, StringType()) for k in keys])
    assert tuple(flatten_raw(df, "raw", schema).first()) == ("1", "x", '{"g": 2}', "j")


def test_conform(spark):
    df = spark.createDataFrame([("12", "x", True), ("a", None, None)], "n string, extra string, b boolean")
    schema = StructType(
        [
            StructField("b", BooleanType()),
            StructField("n", LongType()),
            StructField("gone", StringType()),
        ]
    )
    out = conform(df, schema)
    assert out.schema == schema
    assert [tuple(r) for r in out.collect()] == [(True, 12, None), (None, None, None)]


def test_fill_missing_keeps_duplicates(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([(1, "y"), (1, "y")], "id int, b string")
    out = fill_missing(a, b, a)
    assert out.columns == ["id", "a", "b"]
    assert sorted(map(tuple, out.collect()), key=repr) == [
        (1, "x", None), (1, "x", None), (1, None, "y"), (1, None, "y"),
    ]


def test_key_union_counts_null_values_and_skips_broken_items(spark):
    rows = [('{"a":1,"b":null}',), ('{"c":{"d":1}}',), ("broken",), (None,), ("{}",)]
    df = spark.createDataFrame(rows, "raw string")
    assert sorted(r.key for r in key_union(df, "raw").collect()) == ["a", "b", "c"]
    with pytest.raises(ValueError):
        key_list(df, "raw", at_most=2)


@pytest.mark.parametrize("text, want", [(None, None), ("x" * 59, "x" * 59), ("x" * 60, "x" * 60), ("é😀" * 31, "é😀" * 30)])
def test_label(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(label(F.col("t")).alias("a"), label(F.col("t"), suffix="...").alias("b")).first()
    assert got.a == want
    assert got.b == (None if want is None else want + "...")


def test_counts_and_sample(spark):
    df = spark.range(250).selectExpr("id div 100 as fetch_seq", "id % 100 as pos")
    assert count_rows(df).first().n == 250
    assert [(r.fetch_seq, r.pos) for r in sample(df, 3).collect()] == [(0, 0), (0, 1), (0, 2)]
    same, observed = counted(df, "seen")
    assert same.filter("pos < 10").count() == 30
    assert observed.get["rows"] == 250
