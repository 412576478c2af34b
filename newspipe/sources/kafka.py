"""Kafka topics as streams of ``value``.

The Kafka connector is a separate Spark package and has to be on the classpath. The
options are plain data so that they can be checked without it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def source_options(
    servers: str,
    topic: str,
    group_id: str | None = None,
    starting: str = "earliest",
    max_per_trigger: int | None = None,
) -> dict[str, str]:
    """Where to resume is kept in the query's checkpoint, not in the consumer group."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if group_id:
        options["kafka.group.id"] = group_id
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def read_kafka(
    spark: SparkSession, servers: str, topic: str, stream: bool = True, **settings
) -> DataFrame:
    """Messages from the earliest offset on."""
    reader = spark.readStream if stream else spark.read
    options = source_options(servers, topic, **settings)
    return reader.format("kafka").options(**options).load().select("value")
