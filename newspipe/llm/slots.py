"""Sharding by fixed virtual slots and a stored, versioned map from slots to shards.

A record's slot is a hash of its id and text among a fixed number of slots and never
changes. Which shard holds a slot is a table of as many rows as there are slots. Version 1
deals slots out in turn; rebalancing reads the bytes per slot, edits the map by moving
whole slots from shards above the mean to the emptiest ones, and stores it as the next
version. The law that holds is ``bytes``: shards are equal up to about the smallest slots,
or the largest record.

Nulls: a null text has no bytes and checksum 0, a null id hashes like any other value.
Empty and very long texts count with their size. Repeated rows are all placed, each on a
place of its own; where so many rows are equal that they would fill a good part of a slot,
they are spread over all slots, as which of them is where makes no difference. An empty table gives an empty result and an unedited map. Columns other
than ``doc_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import scratch_dir
from .store import stored, utf8

SLOTS = 4096
OVERHEAD = 16


def slotted(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``doc_id, size, text_crc32, vslot`` of every record."""
    text = utf8("text")
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    return rows.withColumn(
        "vslot", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(slots)).cast("int")
    )


def spread(rows: DataFrame, slots: int = SLOTS) -> DataFrame:
    """The same with crowds of equal rows spread over all slots."""
    own = ["doc_id", "text_crc32"]
    numbered = stored(rows.withColumn("number", F.monotonically_increasing_id()), "numbered")
    least = max(2, numbered.count() // (4 * slots))
    crowds = numbered.groupBy(*own).agg(F.count("*").alias("n")).filter(F.col("n") > least)
    crowds = stored(crowds.select(F.col("doc_id").alias("__id"), F.col("text_crc32").alias("__crc"), "n"), "crowds")
    same = numbered["doc_id"].eqNullSafe(F.col("__id")) & (numbered["text_crc32"] == F.col("__crc"))
    elsewhere = F.pmod(F.xxhash64(*own, "number"), F.lit(slots)).cast("int")
    return (
        numbered.join(F.broadcast(crowds), same, "left")  # 4 * slots rows at most
        .withColumn("vslot", F.when(F.col("n").isNull(), F.col("vslot")).otherwise(elsewhere))
        .select(*rows.columns)
    )


def slot_loads(rows: DataFrame) -> DataFrame:
    """Bytes and records of the slots in use."""
    return rows.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count("*").alias("n_rows"))


def first_map(spark: SparkSession, shards: int, slots: int = SLOTS) -> DataFrame:
    """Slots dealt out in turn."""
    slot = F.col("id").cast("int")
    return spark.range(slots).select(slot.alias("vslot"), (slot % shards).alias("shard"))


def rebalance(held: DataFrame, loads: DataFrame, shards: int) -> DataFrame:
    """The edited map for ``shards`` shards, given the bytes per slot.

    Each shard keeps its largest slots up to the mean, and always its largest one; the
    rest, and the slots of shards that no longer exist, go largest first to the shard
    with the fewest bytes. All of it works on one row per slot.
    """
    slots = held.join(F.broadcast(loads), "vslot", "left").fillna(0, ["bytes", "n_rows"])
    by_size = [F.desc("bytes"), F.asc("vslot")]
    in_shard = Window.partitionBy("shard").orderBy(*by_size)
    mean = F.sum("bytes").over(Window.partitionBy(F.lit(1))) / shards
    slots = slots.select(
        "*",
        (
            (F.col("shard") < shards)
            & ((F.sum("bytes").over(in_shard) <= mean) | (F.row_number().over(in_shard) == 1))
        ).alias("stays"),
    )
    kept = slots.filter("stays")
    row = F.struct((-F.col("bytes")).alias("less"), "vslot")
    both = slots.agg(
        F.array_sort(F.collect_list(F.when(~F.col("stays"), row))).alias("queue"),
        F.collect_list(F.when(F.col("stays"), F.struct("shard", "bytes"))).alias("kept"),
    )

    def held_by(shard):
        own = F.filter("kept", lambda k: k["shard"] == shard)
        return F.aggregate(own, F.lit(0).cast("bigint"), lambda total, k: total + k["bytes"])

    filled = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), held_by)

    def place(state, slot):
        to = F.array_position(state["filled"], F.array_min(state["filled"]))
        return F.struct(
            F.transform(
                state["filled"], lambda x, i: F.when(i == to - 1, x - slot["less"]).otherwise(x)
            ).alias("filled"),
            F.concat(
                state["moves"],
                F.array(F.struct(slot["vslot"].alias("vslot"), (to - 1).cast("int").alias("shard"))),
            ).alias("moves"),
        )

    nothing = F.expr("cast(array() as array<struct<vslot:int,shard:int>>)")
    moved = both.select("queue", filled.alias("filled")).select(
        F.inline(F.aggregate("queue", F.struct("filled", nothing.alias("moves")), place)["moves"])
    )
    return kept.select("vslot", "shard").unionByName(moved)


def store_map(held: DataFrame, folder: str, version: int) -> None:
    held.coalesce(1).write.parquet(f"{folder}/version={version}")


def read_map(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """``vslot, shard`` of one version, the latest by default."""
    held = spark.read.schema("vslot int, shard int, version int").parquet(folder)
    if version is None:
        version = held.agg(F.max("version")).first()[0]
    return held.filter(F.col("version") == version).select("vslot", "shard")


def placed(rows: DataFrame, held: DataFrame, loads: DataFrame) -> DataFrame:
    """Each record's shard and its place there, gapless from 0.

    A shard is its slots in order, so that a place is the slot's offset, a running sum
    over the map, plus the place in the slot. No task holds more than a slot.
    """
    before = Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = held.join(F.broadcast(loads), "vslot", "left").select(
        "vslot", "shard", F.coalesce(F.sum("n_rows").over(before), F.lit(0)).alias("before")
    )
    in_slot = Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size")
    return (
        rows.withColumn("place", F.row_number().over(in_slot) - 1)
        .join(F.broadcast(offsets), "vslot")  # as many rows as slots
        .withColumn("slot", (F.col("before") + F.col("place")).cast("long"))
        .drop("before", "place")
    )


def shard_documents(docs: DataFrame, shards: int = 40, slots: int = SLOTS) -> DataFrame:
    """Versions 1 and 2 of the map for these records, and each record's place in version 2."""
    spark = docs.sparkSession
    rows = stored(spread(slotted(docs, slots), slots), "slotted")
    loads = stored(slot_loads(rows), "slot_loads")
    folder = scratch_dir(spark, "shard_map")
    store_map(first_map(spark, shards, slots), folder, 1)
    store_map(rebalance(read_map(spark, folder), loads, shards), folder, 2)
    return placed(rows, read_map(spark, folder), loads).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "vslot",
    )
