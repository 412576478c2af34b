"""News messages: selection, projection, limits and the JSON wire format."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    MapType,
    StringType,
    StructField,
    StructType,
    VariantType,
)

from ..functions.plan import computed_once, let
from ..functions.values import join_list, spaced_json
from .ordered import first_rows

# What the batch fetch and the publisher ask for by default.
BATCH_QUERY = {"country": "us", "category": "crime", "language": "en"}
PUBLISH_QUERY = {"category": "crime", "language": "en"}

# Names the one field of the object that ends the brackets around a message.
_END = "end of message"


def filter_news(
    items: DataFrame,
    country: str | None = None,
    category: str | None = None,
    language: str | None = None,
) -> DataFrame:
    """Items that fit all given values; list fields fit if they contain the value."""
    wanted = {"country": country, "category": category, "language": language}
    for name, value in wanted.items():
        if value is not None:
            is_list = isinstance(items.schema[name].dataType, ArrayType)
            items = items.filter(
                F.array_contains(name, value) if is_list else F.col(name) == value
            )
    return items


def project_news(items: DataFrame) -> DataFrame:
    """The message of an item: ``title, content, pubDate, link, category``.

    ``content`` is the item's description; its own ``content`` is ignored. Fields the
    input does not have are null.
    """

    def field(name: str, kind: str = "string") -> Column:
        return F.col(name) if name in items.columns else F.lit(None).cast(kind)

    return items.select(
        field("title").alias("title"),
        field("description").alias("content"),
        field("pubDate").alias("pubDate"),
        field("link").alias("link"),
        field("category", "array<string>").alias("category"),
    )


def limit_messages(
    df: DataFrame, max_messages: int | None = None, order: tuple[str, ...] = ()
) -> DataFrame:
    """The first messages in ``order``; ``None`` and 0 mean all of them.

    However many they are, see ``first_rows``. Without an order any of them.
    """
    if max_messages is not None and max_messages < 0:
        raise ValueError("max_messages must not be negative")
    if not max_messages:
        return df
    return first_rows(df, max_messages, order) if order else df.limit(max_messages)


def wire_value(*columns: Column | str, ascii_only: bool = False) -> Column:
    """The columns as a UTF-8 JSON object, null fields included.

    ``ascii_only`` escapes all other characters, as some producers do; consumers read
    both forms alike.
    """
    options = {
        "ignoreNullFields": "false",
        "writeNonAsciiCharacterAsCodePoint": str(ascii_only).lower(),
    }
    return F.encode(F.to_json(F.struct(*columns), options), "UTF-8")


def to_wire(df: DataFrame, ascii_only: bool = False) -> DataFrame:
    """``value`` = each row as a UTF-8 JSON object, see ``wire_value``."""
    return df.select(wire_value("*", ascii_only=ascii_only).alias("value"))


def _parsed(wire: DataFrame, schema: StructType) -> DataFrame:
    """``value`` and ``record``: the fields as text, null where the message is no object.

    Set between brackets with an object of our own after it, a message that is exactly one
    JSON object is the first of two; trailing text breaks that or adds to it. So one parse
    tells that and gives the fields.
    """
    text = F.col("value").cast("string")
    strict = {"allowSingleQuotes": "false"}

    def fields(kind: DataType, *more: str) -> StructType:
        return StructType([StructField(name, kind) for name in (*schema.names, *more)])

    bracketed = F.from_json(
        F.concat(F.lit("["), text, F.lit(f',{{"{_END}":""}}]')),
        ArrayType(fields(StringType(), _END)),
        strict,
    )

    def alone(parts: Column) -> Column:
        ended = F.try_element_at(parts, F.lit(2))[_END].isNotNull()
        only = (F.size(parts) == 2) & ended
        return F.when(only, with_kinds(F.try_element_at(parts, F.lit(1))))

    def with_kinds(record: Column) -> Column:
        # Only a text that looks like a list or an object may be one; then its kind tells.
        texts = [f.name for f in schema.fields if isinstance(f.dataType, StringType)]
        nested = F.exists(F.array(*[record[n] for n in texts]), lambda t: t.rlike(r"^[\[{]"))
        kinds = F.from_json(text, fields(VariantType()), strict)
        return F.struct(
            record.alias("text"), F.when(nested if texts else F.lit(False), kinds).alias("kind")
        )

    readable = text.rlike(r"^\s*\{") & F.call_function("is_valid_utf8", text)
    return computed_once(
        wire, F.col("value"), F.when(readable, let(bracketed, alone)).alias("record")
    )


def _field(field: StructField) -> Column:
    """A field of a message, given as text, in the type asked for.

    A text takes lists joined and objects as JSON text. A list of texts takes a single value
    as a list of one. What fits a type in no way is null in that field only.
    """
    text, kind = F.col(f"record.text.`{field.name}`"), field.dataType
    if isinstance(kind, StringType):
        found = F.schema_of_variant(F.col(f"record.kind.`{field.name}`"))
        value = (
            F.when(found.startswith("ARRAY"), join_list(F.from_json(text, "array<string>")))
            .when(found.startswith("OBJECT"), spaced_json(text))
            .otherwise(text)
        )
    elif isinstance(kind, ArrayType) and isinstance(kind.elementType, StringType):
        several = F.when(text.startswith("["), F.from_json(text, kind))
        value = F.coalesce(several, F.when(text.isNotNull(), F.array(text)))
    elif isinstance(kind, (ArrayType, StructType, MapType)):
        value = F.from_json(text, kind)
    else:
        value = text.try_cast(kind)
    return value.alias(field.name)


def _readable() -> Column:
    return F.col("record").isNotNull()


def from_wire(wire: DataFrame, schema: StructType) -> DataFrame:
    """The records of all messages that are JSON objects.

    Keys that are not in the schema are ignored, keys that are missing are null.
    """
    parsed = _parsed(wire, schema).filter(_readable())
    return parsed.select(*[_field(field) for field in schema.fields])


def wire_rejects(wire: DataFrame, schema: StructType) -> DataFrame:
    """``value`` of the messages that ``from_wire`` leaves out."""
    return _parsed(wire, schema).filter(~_readable()).select("value")


def judged_wire(wire: DataFrame, schema: StructType, tag: str = "readable") -> DataFrame:
    """Every message once: whether it is a record, its fields, and its ``value`` if it is none.

    One parse for both outcomes, for sinks that keep records and rejects side by side.
    """
    parsed = _parsed(wire, schema)
    rejected = F.when(~_readable(), F.col("value")).alias("value")
    return parsed.select(_readable().alias(tag), *[_field(f) for f in schema.fields], rejected)
