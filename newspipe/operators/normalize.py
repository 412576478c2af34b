"""Bringing API items into flat rows of fixed columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    MapType,
    StringType,
    StructField,
    StructType,
    VariantType,
)

from ..functions.plan import let
from ..functions.values import join_list, json_text, spaced_json
from ..schemas import NEWS_ITEM


def flatten(df: DataFrame) -> DataFrame:
    """Lists as joined text, maps and structs as JSON text, all else untouched."""

    def cell(field: StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, ArrayType):
            column = join_list(column)
        elif isinstance(field.dataType, (MapType, StructType)):
            column = json_text(column)
        return column.alias(field.name)

    return df.select(*[cell(f) for f in df.schema.fields])


def fill_missing(*parts: DataFrame) -> DataFrame:
    """All rows of all parts under the union of their columns, gaps null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the columns of the schema: missing ones null, others left out.

    A value that does not fit its type becomes null.
    """

    def cell(field: StructField) -> Column:
        if field.name not in df.columns:
            return F.lit(None).cast(field.dataType).alias(field.name)
        return F.col(f"`{field.name}`").try_cast(field.dataType).alias(field.name)

    return df.select(*[cell(f) for f in schema.fields])


def flatten_raw(
    df: DataFrame, raw: str, schema: StructType = NEWS_ITEM, titled_booleans: bool = False
) -> DataFrame:
    """Raw JSON items as rows of the schema, lists and objects flattened to text.

    The same field may be a list in one item and plain text in the next, so the kind
    of each value is looked up per row. Objects keep their key order, and decimals
    keep their decimals. A boolean column takes JSON booleans only; in a text column
    they are ``true`` and ``false``, or ``True`` and ``False`` with
    ``titled_booleans``. Of a repeated key the last one counts. Items that are not JSON
    objects give rows of nulls.
    """

    names, corrupt = schema.names, "_corrupt_record"

    def parsed(kind: DataType) -> Column:
        fields = [StructField(n, kind) for n in names] + [StructField(corrupt, StringType())]
        return F.from_json(
            F.col("raw"), StructType(fields), {"columnNameOfCorruptRecord": corrupt}
        )

    # A variant respells objects and decimals, so their cells come from the text. It is parsed
    # once for an item, and not at all if no cell asks for it.
    as_text = let(parsed(StringType()), lambda record: F.array(*[record[n] for n in names]))

    def respelled(value: Column) -> Column:
        kind = F.schema_of_variant(value)
        plain = kind.startswith("ARRAY") | kind.isin("STRING", "BIGINT", "BOOLEAN", "VOID")
        return F.coalesce(~plain, F.lit(False))

    def by_kind(value: Column, i: Column, texts: Column) -> Column:
        plain, items = value.cast("string"), F.try_variant_get(value, "$", "array<string>")
        return let(
            F.schema_of_variant(value),
            lambda kind: F.when(kind.isin("STRING", "BIGINT"), plain)
            .when(kind.startswith("ARRAY"), join_list(items))
            .when(kind.startswith("OBJECT"), spaced_json(texts[i]))
            .when(kind == "BOOLEAN", F.initcap(plain) if titled_booleans else plain)
            .when(kind != "VOID", F.btrim(texts[i], F.lit('"'))),
        )

    def by_text(text: Column) -> Column:
        return (
            F.when(text.startswith("["), join_list(F.from_json(text, "array<string>")))
            .when(text.startswith("{"), spaced_json(text))
            .otherwise(text)
        )

    readable = F.col("item")[corrupt].isNull()

    def column(i: int, field: StructField) -> Column:
        text = F.col("cells")[i]
        if isinstance(field.dataType, BooleanType):
            is_boolean = F.schema_of_variant(F.col("item")[field.name]) == "BOOLEAN"
            text = F.when(is_boolean | ~readable, text.try_cast("boolean"))
        return text.alias(field.name)

    items = df.select(F.col(raw).alias("raw")).select("raw", parsed(VariantType()).alias("item"))
    values = F.array(*[F.col("item")[n] for n in names])
    # Variants refuse objects that repeat a key; plain text does not.
    asks = ~readable | F.exists("values", respelled)
    cells = let(
        F.when(asks, as_text),
        lambda texts: F.when(
            readable, F.transform("values", lambda value, i: by_kind(value, i, texts))
        ).otherwise(F.transform(texts, by_text)),
    )
    items = items.select("raw", "item", values.alias("values"))
    flat = items.select("item", cells.alias("cells"))
    return flat.select(*[column(i, f) for i, f in enumerate(schema.fields)])
