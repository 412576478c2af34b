"""Text of pages that are stored as bytes.

The character set is told as browsers do: by a byte-order mark, else by a ``meta`` element
near the start, else UTF-8 if the bytes are that, else windows-1252. All is done with native
expressions; what single-byte character sets mean is looked up when the plan is made.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .plan import let

HEAD = 1024  # bytes that are searched for a meta element
_MAX = 2**31 - 1
_DEFAULT = "cp1252"

# Single-byte character sets by the labels that pages use for them.
_LABELS = {
    "cp1252": (
        "windows-1252 cp1252 x-cp1252 iso-8859-1 iso8859-1 iso88591 latin1 latin-1 l1 us-ascii ascii"
    ),
    "cp1254": "windows-1254 cp1254 iso-8859-9 latin5 l5",
    "cp1250": "windows-1250 cp1250 x-cp1250",
    "cp1251": "windows-1251 cp1251 x-cp1251",
    "cp1253": "windows-1253 cp1253",
    "cp1255": "windows-1255 cp1255",
    "cp1256": "windows-1256 cp1256",
    "cp1257": "windows-1257 cp1257",
    "cp1258": "windows-1258 cp1258",
    "iso8859-2": "iso-8859-2 iso8859-2 latin2 l2",
    "iso8859-5": "iso-8859-5 cyrillic",
    "iso8859-7": "iso-8859-7 greek",
    "iso8859-15": "iso-8859-15 latin9 l9",
    "koi8-r": "koi8-r koi",
    "koi8-u": "koi8-u",
    "mac-roman": "macintosh mac",
}
_CODEC = {label: codec for codec, labels in _LABELS.items() for label in labels.split()}
# UTF-16 cannot be what a readable meta element is written in.
_UTF8 = "utf-8 utf8 unicode-1-1-utf-8 utf-16 utf-16le utf-16be".split()

_META = (
    r"(?is)<meta(?=[\s/])(?=[^>]*?[\s;\"'/]charset\s*=\s*[\"']?\s*([a-z0-9_:.-]+))[^>]*>"
)
# A surrogate without its other half, after everything that is in order.
_LONE = r"\G((?:(?!D[89A-F]).{4}|D[89AB]..D[C-F]..)*+)D[89A-F].."


def _single_byte(content: Column, codec: str) -> Column:
    """Bytes as text by a table of what each byte from 128 on means."""
    high = range(128, 256)
    shown = "".join(bytes([b]).decode(codec, "ignore") or chr(b) for b in high)
    return F.translate(F.decode(content, "ISO-8859-1"), "".join(map(chr, high)), shown)


def _utf8(content: Column) -> Column:
    return F.call_function("make_valid_utf8", content.cast("string"))


def _utf16(content: Column, little: bool) -> Column:
    """An odd last byte is dropped, half a surrogate pair is shown as U+FFFD."""
    units = F.hex(content)
    units = F.left(units, F.length(units) - F.length(units) % 4)
    if little:
        units = F.regexp_replace(units, "(..)(..)", "$2$1")
    lone = F.regexp_replace(units, _LONE, "$1FFFD")
    clean = F.when(units.contains("D"), lone).otherwise(units)
    return F.decode(F.unhex(clean), "UTF-16BE")


def declared_charset(content: Column) -> Column:
    """The label in the first ``meta`` element that gives one, in lower case, or ``''``."""
    head = F.decode(F.substring(content, 1, HEAD), "ISO-8859-1")
    return F.lower(F.regexp_extract(head, _META, 1))


def page_text(content: Column, charset: str | None = None) -> Column:
    """The text of a page from its bytes; null stays null.

    ``charset`` is what the server said, which comes before the page's own word but not before
    a byte-order mark. Labels that are not known count as if there were none.
    """

    def after(mark: int) -> Column:
        return F.substring(content, mark + 1, _MAX)

    def by_label(label: Column) -> Column:
        found = F.when(label.isin(*_UTF8), _utf8(content))
        for codec in dict.fromkeys(_CODEC.values()):
            names = [name for name, c in _CODEC.items() if c == codec]
            found = found.when(label.isin(*names), _single_byte(content, codec))
        guessed = F.call_function("is_valid_utf8", content.cast("string"))
        return found.when(guessed, content.cast("string")).otherwise(_single_byte(content, _DEFAULT))

    start = F.hex(F.substring(content, 1, 3))
    label = F.lit(charset.lower()) if charset else declared_charset(content)
    return (
        F.when(start == "EFBBBF", _utf8(after(3)))
        .when(start.startswith("FEFF"), _utf16(after(2), little=False))
        .when(start.startswith("FFFE"), _utf16(after(2), little=True))
        .otherwise(let(label, by_label))
    )
