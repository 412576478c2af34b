"""Starting, bounding and watching streaming queries."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

ONCE = {"availableNow": True}


def every(seconds: int = 60) -> dict:
    """Trigger of a continuous run that looks for new input at this interval."""
    return {"processingTime": f"{seconds} seconds"}


def _pattern(path: str) -> str:
    """A glob pattern that matches just this path: the last letter as a choice of one.

    A stream over a single file needs one. Spark's file streams read the files of a folder
    more than once if its name has characters that mean something in patterns, so such
    names are refused.
    """
    if re.search(r"[\\\[\]{}*?]", path):
        raise ValueError(f"a file stream cannot read from a name with pattern characters: {path}")
    return re.sub(r"(\w)(?=\W*$)", r"[\1]", path.rstrip("/"))


def stream_table(
    spark: SparkSession, path: str, schema: StructType, max_bytes: int | None = None
) -> DataFrame:
    """Parquet files of a table as a stream, whether a single file or a folder.

    ``max_bytes`` bounds a micro-batch, so that a first run over a large table makes
    progress in steps a restart does not have to repeat.
    """
    reader = spark.readStream.schema(schema)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.parquet(_pattern(path))


def stream_parquet(
    df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append every micro-batch to a table, exactly once per checkpoint."""
    writer = df.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or ONCE)).start(path)


class RowsRead:
    """Rows a query has read, added up by batch however many batches there are.

    Spark keeps the last ``spark.sql.streaming.numRecentProgressUpdates`` reports only, so
    ``look`` has to be called more often than that many batches pass, which ``finish`` does.
    Batches are numbered without gaps: one that was never seen is an error, not a low count.
    """

    def __init__(self, query: StreamingQuery) -> None:
        self.query = query
        self.by_batch: dict[int, int] = {}

    def look(self) -> None:
        for report in self.query.recentProgress:
            batch, rows = report["batchId"], report["numInputRows"]
            self.by_batch[batch] = max(rows, self.by_batch.get(batch, 0))

    @property
    def total(self) -> int:
        self.look()
        if self.by_batch:
            missing = set(range(min(self.by_batch), max(self.by_batch))) - set(self.by_batch)
            if missing:
                raise RuntimeError(f"no report seen of {len(missing)} batches")
        return sum(self.by_batch.values())


def stream_judged(
    df: DataFrame, tag: str, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append every micro-batch to a table in parts by ``tag``, such as records and rejects.

    Both come out of one pass over the step, and are there together or not at all.
    """
    writer = df.writeStream.format("parquet").partitionBy(tag).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or ONCE)).start(path)


def read_judged(spark: SparkSession, path: str, tag: str, judged: bool | None = None) -> DataFrame:
    """What ``stream_judged`` has written, all of it or the rows that were judged so."""
    rows = spark.read.parquet(path).withColumn(tag, F.col(tag).cast("boolean"))
    return rows if judged is None else rows.filter(F.col(tag) == judged)


def finish(query: StreamingQuery) -> int:
    """Wait for a bounded run; the query is stopped in any case. Gives the rows read."""
    rows = RowsRead(query)
    try:
        while not query.awaitTermination(timeout=1):
            rows.look()
        return rows.total
    finally:
        query.stop()


def rows_read(query: StreamingQuery) -> int:
    """Rows the query has read so far.

    An error if Spark may have dropped reports already; follow long runs with ``RowsRead``.
    """
    spark = SparkSession.getActiveSession()
    kept = int(spark.conf.get("spark.sql.streaming.numRecentProgressUpdates", "100"))
    if len(query.recentProgress) >= kept - 1:  # the oldest goes before the newest comes
        raise RuntimeError(f"only the last {kept} reports are kept")
    return RowsRead(query).total
