"""Writing messages to a Kafka topic; needs the Kafka connector on the classpath."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def sink_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def write_kafka(wire: DataFrame, servers: str, topic: str) -> None:
    """Send a batch of ``value``; returns once all are flushed."""
    wire.select("value").write.format("kafka").options(**sink_options(servers, topic)).save()


def stream_kafka(
    wire: DataFrame, servers: str, topic: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Send a stream of ``value``; at least once, as the topic has no transactions."""
    writer = wire.select("value").writeStream.format("kafka")
    return (
        writer.options(**sink_options(servers, topic))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
