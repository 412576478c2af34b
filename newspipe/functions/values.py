"""Cell values: lists and objects as text, headline labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A run up to and including the next comma or colon outside of JSON strings. It has to
# start where the last one ended, as it could otherwise start inside a string.
_JSON_STEP = r'\G((?:[^":,]++|"(?:[^"\\]++|\\.)*+")*+[:,])'


def join_list(items: Column) -> Column:
    """List as text, joined by a comma and a space; an empty list becomes null.

    Null elements are skipped.
    """
    return F.when(F.size(items) > 0, F.array_join(items.cast("array<string>"), ", "))


def spaced_json(text: Column) -> Column:
    """Compact JSON text with a space after each comma and colon."""
    return F.regexp_replace(text, _JSON_STEP, "$1 ")


def json_text(value: Column) -> Column:
    """Map or struct as spaced JSON text; ``{}`` stays ``{}``, non-ASCII stays as it is."""
    return spaced_json(F.to_json(value, {"ignoreNullFields": "false"}))


def label(text: Column, length: int = 60, suffix: str = "") -> Column:
    """The first characters of a text, for progress lines; null stays null."""
    return F.concat(F.left(text, F.lit(length)), F.lit(suffix))
