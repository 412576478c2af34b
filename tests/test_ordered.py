"""The first rows of an order, in one task and spread over many."""

import random

import pytest

import __spark_entry__ as contract
from newspipe import limit_messages
from newspipe.operators.ordered import first_rows


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    return [
        (rng.choice([None, *range(5)]), rng.choice([None, "a", "b", "ä"]), rng.choice(["x", "y", None]))
        for _ in range(700)
    ]


@pytest.mark.parametrize("count", [0, 1, 12, 350, 699, 700, 701, 10_000])
def test_spread_and_together_are_the_same(spark, rows, count):
    df = spark.createDataFrame(rows, "a int, b string, c string").repartition(7)
    together = rows_of(first_rows(df, count, ("a", "b")))
    assert rows_of(first_rows(df, count, ("a", "b"), in_one_task=0)) == together
    assert rows_of(first_rows(df.repartition(3), count, ("a", "b"), in_one_task=0)) == together
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())
    assert sorted(map(key, together)) == sorted(map(key, rows))[:count]


def test_a_hot_key_is_cut(spark):
    df = spark.range(5000).selectExpr("1 as k", "id % 3 as v")
    for count in (1, 1666, 2500, 4999):
        assert first_rows(df, count, ("k",), in_one_task=0).count() == count


def test_a_million_rows_stay_where_they_are(spark):
    df = spark.range(2_000_000).selectExpr("id div 7 as k", "id")
    first = first_rows(df, 1_000_000, ("k", "id"))
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" not in plan
    assert first.selectExpr("count(*)", "max(id)", "count(distinct id)").first() == (1_000_000, 999_999, 1_000_000)


def test_clashing_names(spark):
    df = spark.createDataFrame([(2, 1, 9), (1, 2, 8)], "part int, number int, k0 int")
    assert rows_of(first_rows(df, 1, ("part",), in_one_task=0)) == [(1, 2, 8)]


def test_messages_are_limited_by_it(spark, rows):
    df = spark.createDataFrame(rows, "a int, b string, c string")
    assert rows_of(limit_messages(df, 5, ("a", "b"))) == rows_of(first_rows(df, 5, ("a", "b")))


def test_query_uses_no_single_task(spark, sf_dir):
    df = contract.queries()["publish_prefix"](spark, sf_dir)
    assert "TakeOrderedAndProject" not in df._jdf.queryExecution().executedPlan().toString()
