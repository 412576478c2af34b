"""CSV files.

Written as UTF-8 with newline row ends: a two-character row end would rewrite newlines
inside values. A byte-order mark is optional; as every file begins with the header, it is
written as the first character of the first name there. Null and empty text are both
written as nothing and read back as null.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, StructField, StructType

from ..operators.analyze import key_list
from ..operators.normalize import flatten, flatten_raw
from ..schemas import text_fields
from ..session import scratch_dir

WRITE_OPTIONS = {
    "header": "true",
    "escape": '"',
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
# Fixed value: records per appended batch in a small run.
BATCH_RECORDS = 100
READ_OPTIONS = {"header": "true", "escape": '"', "multiLine": "true"}


BYTE_ORDER_MARK = "\ufeff"


def csv_rows(
    df: DataFrame,
    columns: list[str] | None = None,
    rename: dict | None = None,
    byte_order_mark: bool = False,
) -> DataFrame:
    """The rows as they go into a file: chosen columns, lists and objects as text.

    Booleans are spelled ``True`` and ``False``. The byte-order mark is part of the first
    column's name, so that every file starts with it.
    """

    def cell(field: StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, BooleanType):
            column = F.initcap(column.cast("string"))
        return column.alias((rename or {}).get(field.name, field.name))

    flat = flatten(df.select(*[f"`{c}`" for c in columns]) if columns else df)
    rows = flat.select(*[cell(f) for f in flat.schema.fields])
    if byte_order_mark:
        rows = rows.withColumnRenamed(rows.columns[0], BYTE_ORDER_MARK + rows.columns[0])
    return rows


def write_options(rows: DataFrame) -> dict[str, str]:
    """A line with nothing on it is no row, so a lone column has its blanks quoted."""
    quoted = {"emptyValue": '""', "nullValue": '""'} if len(rows.columns) == 1 else {}
    return WRITE_OPTIONS | quoted


def _records_for(rows: DataFrame, max_bytes: int) -> int:
    """How many rows of average size, as text without quotes, make a file of that size."""
    cells = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + 1 for c in rows.columns]
    size = rows.agg(F.avg(reduce(Column.__add__, cells))).first()[0] or 1
    return max(1, int(max_bytes / size))


def write_csv(
    df: DataFrame,
    path: str | None,
    columns: list[str] | None = None,
    mode: str = "overwrite",
    rename: dict | None = None,
    max_records_per_file: int | None = None,
    max_bytes_per_file: int | None = None,
    byte_order_mark: bool = False,
) -> None:
    """Write one file per task, or more if ``max_records_per_file`` is given.

    With ``max_bytes_per_file`` the rows are first measured, in a pass of their own that gives
    their average size, and a task starts another file after as many rows as that allows.
    No row moves for it. Without a path nothing is written. ``mode="append"`` adds files.
    """
    if not path:
        print("No path given, nothing written.")
        return
    rows = csv_rows(df, columns, rename, byte_order_mark)
    if max_bytes_per_file:
        fitting = _records_for(rows, max_bytes_per_file)
        max_records_per_file = min(fitting, max_records_per_file or fitting)
    writer = rows.write.mode(mode).options(**write_options(rows))
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.csv(path)


def write_raw_csv(
    df: DataFrame,
    raw: str,
    path: str,
    mode: str = "overwrite",
    max_records_per_file: int | None = None,
    max_bytes_per_file: int | None = None,
    max_keys: int | None = None,
    byte_order_mark: bool = False,
) -> list[str]:
    """Raw JSON items under the union of their keys in ascending order.

    The header has to be known before the first row, so the items are first kept as a table
    in the shared folder, from which the keys, the size and the rows are read. The input
    itself is worked out once. More than ``max_keys`` keys are an error.
    """
    spark, kept = df.sparkSession, scratch_dir(df.sparkSession, "items")
    df.select(F.col(raw).alias("raw")).write.parquet(kept)
    items = spark.read.schema("raw string").parquet(kept)
    keys = key_list(items, "raw", at_most=max_keys)
    rows = flatten_raw(items, "raw", text_fields(*keys), titled_booleans=True)
    write_csv(
        rows,
        path,
        mode=mode,
        max_records_per_file=max_records_per_file,
        max_bytes_per_file=max_bytes_per_file,
        byte_order_mark=byte_order_mark,
    )
    return keys


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read back what ``write_csv`` wrote; rows may span lines.

    A file is then read by one task. Keep files small with ``max_bytes_per_file`` where
    they are read again, or keep the records in a columnar format.
    """
    return spark.read.schema(schema).options(**READ_OPTIONS).csv(path)


def stream_csv(
    df: DataFrame,
    path: str,
    checkpoint: str,
    columns: list[str] | None = None,
    trigger: dict | None = None,
    max_records_per_file: int | None = None,
    byte_order_mark: bool = False,
) -> StreamingQuery:
    """Append every micro-batch as CSV files, exactly once per checkpoint."""
    rows = csv_rows(df, columns, byte_order_mark=byte_order_mark)
    writer = rows.writeStream.format("csv").options(**write_options(rows))
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    return (
        writer.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start(path)
    )
