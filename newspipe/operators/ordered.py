"""The first rows of an order, however many are asked for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField
from pyspark.sql.window import Window

from ..session import scratch_dir

# Up to here the rows may meet in one task; beyond, they stay where they are.
IN_ONE_TASK = 100_000
_KEYS = "__order"


def _place(df: DataFrame, order: tuple[str, ...]) -> Column:
    """What rows are ordered by: the columns asked for, then a hash of the whole row, so that
    ties always come out the same. Rows without any difference are interchangeable."""
    def hashable(field: StructField) -> Column:
        column, kind = F.col(f"`{field.name}`"), field.dataType.simpleString()
        return F.to_json(F.struct(column)) if "map<" in kind or "variant" in kind else column

    whole = F.xxhash64(*[hashable(field) for field in df.schema.fields])
    return F.struct(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(order)], whole.alias("whole"))


def first_rows(
    df: DataFrame, count: int, order: tuple[str, ...], in_one_task: int = IN_ONE_TASK
) -> DataFrame:
    """The first ``count`` rows in ``order``; nulls come first, ties are broken by content.

    A small number is kept by every task and merged in one. For a large one only the order's
    keys are dealt out by ranges and sorted; rows counted for each range tell in which one the
    cut lies, and there the key of the last row is looked up. The rows up to that key are then
    read from the input, where they stand. So the input is read twice and has to be the same.
    """
    if count <= 0:
        return df.limit(0)
    place = _place(df, order)
    if count <= in_one_task:
        return df.withColumn(_KEYS, place).orderBy(_KEYS).limit(count).drop(_KEYS)
    spark, kept = df.sparkSession, scratch_dir(df.sparkSession, "order")
    number = F.monotonically_increasing_id().alias("number")
    (
        df.select(place.alias(_KEYS))
        .repartitionByRange(_KEYS)
        .sortWithinPartitions(_KEYS)
        .select(_KEYS, number)
        .write.parquet(kept)
    )
    keys = spark.read.schema(df.select(place.alias(_KEYS), number).schema).parquet(kept).withColumn(
        "part", F.shiftrightunsigned("number", 33)
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (  # a row for each range
        keys.groupBy("part")
        .agg(F.count("*").alias("rows"))
        .select("part", "rows", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))
    )
    cut = ranges.filter((F.col("before") < count) & (F.col("before") + F.col("rows") >= count)).first()
    if cut is None:
        return df  # fewer rows than asked for
    within = F.col("number").bitwiseAND((1 << 33) - 1)
    here = keys.filter(F.col("part") == cut["part"])
    last = here.filter(within == count - 1 - cut["before"]).select(_KEYS)
    # Rows that equal the last one in every way may lie on both sides of the cut.
    equal = here.join(F.broadcast(last), _KEYS, "left_semi")  # one row
    ahead = cut["before"] + equal.agg(F.min(within)).first()[0]
    rows = df.withColumn(_KEYS, place)
    end = last.scalar()
    sure = rows.filter(F.col(_KEYS) < end)
    same = rows.filter(F.col(_KEYS) == end).limit(count - ahead)
    return sure.unionByName(same).drop(_KEYS)
