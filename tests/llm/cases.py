"""Tables with every awkward case the operators have to give a defined result for."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")

LONG = " ".join(f"word{i % 977} and{i % 13}" for i in range(30_000))
SAME = "the quick brown fox jumps over the lazy dog and runs away from here"
ROWS = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one two"),
    (5, LONG),
    (6, SAME),
    (6, SAME),
    (7, SAME),
    (None, SAME),
    (None, None),
    (8, "1234 5678 !?"),
    (9, "Überall ñandú 漢字 🙂 ok"),
    (2**62 + 1, "a large id " * 20),
]
# Columns that clash with names the operators use themselves.
EXTRA = ["kept", "shard", "slot", "score", "bytes", "node", "digest", "gram", "n_words", "url", "places"]


def documents(spark, rows=ROWS):
    """The rows under the columns of documents and some more."""
    values = [(i, t, None, "s", 0, *[k for k in range(len(EXTRA))]) for i, t in rows]
    names = ", ".join(f"{c} int" for c in EXTRA)
    return spark.createDataFrame(
        values, f"doc_id long, text string, lang string, source string, n_chars long, {names}"
    ).repartition(3)


def words(text):
    return WORD.findall(text or "")


def plain_rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def saved(df, folder, name):
    """The frame as a table a query can read."""
    df.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)
