"""Counts, key sets and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def count_rows(df: DataFrame, name: str = "n") -> DataFrame:
    """One row with the number of rows."""
    return df.agg(F.count(F.lit(1)).alias(name))


def count_each(df: DataFrame, amounts: dict[str, Column]) -> DataFrame:
    """A row ``what, n`` for each amount, summed over all rows in one pass.

    Conditions count the rows where they hold.
    """
    sums = [
        F.coalesce(F.sum(amount.cast("bigint")), F.lit(0)).alias(f"n{i}")
        for i, amount in enumerate(amounts.values())
    ]
    rows = [F.struct(F.lit(what).alias("what"), F.col(f"n{i}").alias("n")) for i, what in enumerate(amounts)]
    return df.agg(*sums).select(F.inline(F.array(*rows)))


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The same rows plus an observation that knows their number after an action."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def key_union(df: DataFrame, raw: str) -> DataFrame:
    """Distinct keys over all JSON objects; a key with a null value counts.

    Each task drops repeats before the shuffle, so only key names travel.
    """
    return df.select(F.explode(F.json_object_keys(F.col(raw))).alias("key")).distinct()


def key_list(df: DataFrame, raw: str, at_most: int | None = None) -> list[str]:
    """The key union in ascending order, as names for columns.

    With ``at_most`` more keys than that are an error, found before they are collected.
    """
    keys = key_union(df, raw).orderBy("key")
    if at_most is not None:
        keys = keys.limit(at_most + 1)
    keys = [row.key for row in keys.collect()]
    if at_most is not None and len(keys) > at_most:
        raise ValueError(f"more than {at_most} distinct keys; they cannot all be columns")
    return keys


def sample(df: DataFrame, count: int = 5, order: tuple[str, ...] = ("fetch_seq", "pos")) -> DataFrame:
    """The first rows in arrival order."""
    return df.orderBy(*order).limit(count)
