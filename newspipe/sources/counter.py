"""Numbered test messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def counter_value(number: Column) -> Column:
    """The UTF-8 bytes of ``"{n} cats"``."""
    return F.encode(F.concat(number.cast("string"), F.lit(" cats")), "UTF-8")


def counter_messages(numbers: DataFrame, column: str) -> DataFrame:
    """``value`` = the message of each number; works on batch and stream."""
    return numbers.select(counter_value(F.col(column)).alias("value"))


def counter_source(spark: SparkSession, count: int = 20) -> DataFrame:
    """The messages for 0 up to ``count``."""
    return counter_messages(spark.range(count), "id")


def live_counter(spark: SparkSession, per_second: int = 1) -> DataFrame:
    """The same as an endless stream."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", per_second).load()
    return counter_messages(ticks, "value")
