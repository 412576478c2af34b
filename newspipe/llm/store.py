"""Intermediate results as tables in the shared folder, and column helpers."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from ..session import scratch_dir


_shipped: dict[str, str] = {}


def ship_package(spark: SparkSession | None = None) -> None:
    """Send this package to the Python workers, once for each Spark application.

    Functions that run there import it, and no worker need have it on its path. Spark
    itself hands the archive out from the driver.
    """
    context = (spark or SparkSession.getActiveSession()).sparkContext
    if _shipped.get("to") == context.applicationId:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for source in sorted(package.rglob("*.py")):
            packed.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped["to"] = context.applicationId


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage: a lost executor costs its running tasks, not the stages before. The
    files stay as long as the caller keeps the folder, as results are read from them later.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ranked(df: DataFrame, *order: str, name: str = "ranked") -> DataFrame:
    """Rows with ``rank``, their place from 0 in the order of all rows, stored in that order.

    A range shuffle deals out the sorted rows, so that no key, however frequent, meets in
    one task; the only thing counted together is the number of rows of each partition.
    """
    number = "__number"
    rows = stored(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(number, F.monotonically_increasing_id()),
        name,
    )
    part = F.shiftrightunsigned(number, 33).alias("__part")
    within = F.col(number).bitwiseAND((1 << 33) - 1)
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        rows.groupBy(part)
        .agg(F.count("*").alias("__rows"))
        .select("__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"))
    )
    return (
        rows.withColumn("__part", part)
        .join(F.broadcast(parts), "__part")  # as many rows as partitions
        .withColumn("rank", F.col("__before") + within)
        .drop(number, "__part", "__before")
    )


def utf8(text: str) -> Column:
    """Bytes of a text column, null as none."""
    return F.coalesce(F.col(text).cast("binary"), F.lit(b""))


def row_keys() -> list[Column]:
    """``__k1, __k2``: 96 bits that tell a document from others, null ids and texts included."""
    return [F.xxhash64("doc_id", "text").alias("__k1"), F.hash("text", "doc_id").alias("__k2")]


def release_memory() -> None:
    """Hand memory that is free but held by this process back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def map_frames(
    df: DataFrame,
    run: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]],
    shape: str,
    ids: tuple[str, ...] = ("doc_id",),
    at_once: int = 4 << 20,
) -> DataFrame:
    """``mapInPandas`` for frames with ids, which come out as they were.

    In pandas a null turns whole numbers into floating ones, which cannot tell large ids
    apart; so ids travel as text. ``shape`` lists the other columns, which follow the ids.
    A worker turns about ``at_once`` bytes into a frame at a time, not all rows of a batch,
    and hands its memory back when it is done, as it stays for later tasks.
    """
    ship_package(df.sparkSession)
    kinds = {c: df.schema[c].dataType for c in ids}
    texts = df.withColumns({c: F.col(c).cast("string") for c in ids})
    shape = ", ".join([*(f"{c} string" for c in ids), shape])
    schema = to_arrow_schema(StructType.fromDDL(shape))

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            step = max(1, batch.num_rows * at_once // max(1, batch.nbytes))
            for at in range(0, batch.num_rows, step):
                yield batch.slice(at, step).to_pandas()

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in run(frames(batches)):
            yield pa.RecordBatch.from_pandas(frame, schema, preserve_index=False)
        release_memory()

    found = texts.mapInArrow(sliced, shape)
    return found.withColumns({c: F.col(c).cast(kind) for c, kind in kinds.items()})
