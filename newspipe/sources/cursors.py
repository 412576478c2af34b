"""The order of responses that only name the next one.

A cursor-paginated API gives each response a pointer to the next. Landed responses that carry
the cursor they were fetched with, and no running number, form a linked list over all files.
It is ranked by pointer doubling: every round knows the first responses up to a power of two
and jumps by that power, and joining the two doubles both. So the rounds follow the logarithm
of the length, and every round is a join of narrow rows by their cursor. Their tables are as long
as the list, however small as files, so both sides are shuffled: broadcasts would
send the list through the driver several times a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir

FIRST = ""  # stands for the cursor of the first response, which has none
SHUFFLED = "merge"  # hint for joins of which no side may pass through the driver


def _kept(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    path = scratch_dir(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def cursor_order(links: DataFrame) -> DataFrame:
    """``cursor, place`` of all that is reached from the first response, from 0.

    ``links`` are ``cursor, next``, both texts, one row for a cursor. A list that leads back
    into itself, as one does that starts over at its first page, is followed up to there.
    Responses that nothing leads to have no place.
    """
    spark = links.sparkSession
    jump = _kept(spark, links.filter(F.col("next") != FIRST).select("cursor", "next"), "jumps")
    known = _kept(spark, links.filter(F.col("cursor") == FIRST).select("cursor", F.lit(0).cast("long").alias("place")), "places")
    reach, held = 1, known.count()
    while True:
        ahead = known.join(jump.hint(SHUFFLED), "cursor").select(F.col("next").alias("cursor"), (F.col("place") + reach).alias("place"))
        # Pointers past the last landed response lead nowhere.
        landed = ahead.join(links.select("cursor").hint(SHUFFLED), "cursor", "left_semi")
        # On a circle a response is met again and again; its first place counts.
        known = _kept(
            spark, known.unionByName(landed).groupBy("cursor").agg(F.min("place").alias("place")), "places"
        )
        now = known.count()
        if now == held:
            return known
        held, reach = now, 2 * reach
        far = jump.select(F.col("cursor").alias("next"), F.col("next").alias("far"))
        jump = _kept(spark, jump.join(far.hint(SHUFFLED), "next").select("cursor", F.col("far").alias("next")), "jumps")


def ordered_by_cursor(pages: DataFrame, cursor: str = "cursor") -> DataFrame:
    """Landed responses with ``fetch_seq``, the order in which a fetch loop meets them.

    The first response has no cursor. What the loop never meets is left out. If a response was
    landed several times, the copy with the least next cursor and content counts. Null and
    empty cursors are the same.
    """
    key = F.coalesce(F.col(cursor), F.lit(FIRST))
    target = F.coalesce(F.col("nextPage"), F.lit(FIRST))
    rows = pages.select("*", key.alias("__key"), F.struct(target.alias("next"), F.xxhash64(*pages.columns)).alias("__copy"))
    one = _kept(pages.sparkSession, rows.groupBy("__key").agg(F.min("__copy").alias("__copy")), "copies")
    places = cursor_order(one.select(F.col("__key").alias("cursor"), F.col("__copy.next").alias("next")))
    places = places.select(F.col("cursor").alias("__key"), F.col("place").alias("fetch_seq"))
    found = rows.drop("fetch_seq").join(one.join(places.hint(SHUFFLED), "__key").hint(SHUFFLED), ["__key", "__copy"])
    # Copies that are the same in everything are one.
    return found.dropDuplicates(["fetch_seq"]).select("fetch_seq", *[c for c in pages.columns if c != "fetch_seq"])
