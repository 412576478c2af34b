"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Texts are compared as words in lower case without ASCII punctuation. The seeds of a benchmark
item are its pairs of neighbouring words; a document has one where both words stand in it side
by side or with one other word between them. Any copy whose alignment reaches the score that
counts holds at least ``fewest`` of them, however it was edited. So an item's most frequent
pairs need not be looked up, as long as the rest must still hold some; documents with fewer
hits among the rest cannot match. In the others the item is aligned wherever as many hits as
that are close enough, and the best score against that of the item with itself tells how much
of it, edited or not, the document holds.

Which pairs of a document are looked up at all is told by a bitmap of fixed size; the join
with the items then is by the pairs themselves. The benchmark may thus be of any size.

Items and documents that are null, empty or wordless match nothing. Items with fewer words
than a seed are one seed as a whole, and of an item of two words both must be there. Very
long texts are read and aligned whole around their seeds. Repeated documents are each reported; repeated items count as one if text and
id agree. Null ids are carried along. Empty tables give an empty result. Columns other than
``doc_id`` and ``text``, ``item_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import words
from .bitmaps import bitmap, contained
from .store import map_frames, release_memory, stored

SEED = 2
SIMILARITY = 0.5
MATCH, MISMATCH, GAP = 2, -1, -1


def lowered() -> Column:
    """The text in lower case, of any script, as bytes; null as none."""
    return F.coalesce(F.lower("text").cast("binary"), F.lit(b""))


def fewest(n: int) -> int:
    """Seeds that any alignment of an item of ``n`` words holds if its score counts.

    With ``m`` words matched, a score of ``n`` (half of ``MATCH * n``) leaves room for
    ``2 m - n`` errors. Of the ``m - 1`` steps between matched words, those that pass over
    words of the item, ``p`` of them, cost 1 or more, and those that pass over two words or
    more of the document alone cost 2 or more. The others are seeds: ``(n - 2 - p) / 2`` at
    least, where ``p`` is up to ``min(n - m, 2 m - n)``, a third of ``n``.
    """
    return max(1, -(-(n - 2 - n // 3) // 2))


def seed_hashes(item: np.ndarray) -> np.ndarray:
    """An item's seeds in order. Of three words the outer ones are a seed too, as two matched
    words are enough there."""
    if len(item) < SEED:
        return item
    first, second = item[:-1], item[1:]
    if len(item) == 3:
        first, second = item[[0, 1, 0]], item[[1, 2, 2]]
    return pair_hashes(first, second)


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return words.mix(first * words.U(words.BASE) + second)


def item_grams(items: DataFrame) -> DataFrame:
    """``item_id, item_words, size, gram, at, fewest`` for every seed of every item."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = list(frame["text"])
            out = []
            for rows, b in words.batches(texts, words.PLAIN):
                hashes = b.hashes()
                for i, item in enumerate(frame["item_id"].iloc[rows]):
                    own = hashes[b.first[i] : b.first[i + 1]]
                    if not len(own):
                        continue
                    n, least = min(SEED, len(own)), fewest(len(own))
                    whole = own.view(np.int64).tolist()
                    grams = seed_hashes(own).view(np.int64)
                    out += [(item, whole, n, g, a, least) for a, g in enumerate(grams)]
            yield pd.DataFrame(out, columns=["item_id", "item_words", "size", "gram", "at", "fewest"])

    source = items.select("item_id", lowered().alias("text")).distinct()
    return map_frames(
        source, run, "item_words array<bigint>, size int, gram bigint, at int, fewest int", ("item_id",)
    )


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, text`` as bytes: what identifies a document, and what it holds."""
    text = lowered()
    return docs.select("doc_id", F.xxhash64(text).alias("text_hash"), text.alias("text"))


def occurrences(docs: DataFrame, bits: np.ndarray, sizes: list[int]) -> DataFrame:
    """Seeds of the documents that may be among those in the bitmap, each once a document."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)  # of fixed size

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for rows, b in words.batches(list(frame["text"]), words.PLAIN):
                part = frame[["doc_id", "text_hash"]].iloc[rows]
                hashes = b.hashes()
                for size in sizes:
                    found = []
                    for apart in range(size - 1, 2 * size - 1):  # 0, or 1 and 2
                        n = max(0, len(hashes) - apart)
                        at = np.flatnonzero(b.doc[:n] == b.doc[apart:])
                        grams = pair_hashes(hashes[at], hashes[at + apart]) if apart else hashes[at]
                        hit = contained(shared.value, grams)
                        found.append(pd.DataFrame({"doc": b.doc[at[hit]], "gram": grams[hit].view(np.int64)}))
                    once = pd.concat(found).drop_duplicates()
                    yield part.iloc[once["doc"]].assign(size=size, gram=once["gram"].to_numpy())

    return map_frames(docs, run, "text_hash bigint, size int, gram bigint")


def seeds(grams: DataFrame, found: DataFrame) -> DataFrame:
    """Each item's seeds without the most frequent, and how many of these a copy must hold.

    A copy holds ``fewest`` seeds, so after ``spare`` places are left out it still holds
    ``fewest - spare``.
    """
    counts = found.groupBy("size", "gram").agg(F.count("*").alias("n"))
    frequent = Window.partitionBy("item").orderBy(F.desc("n"), "at")
    spare = F.floor((F.col("fewest") - 1) / 2)
    return (
        grams.join(counts, ["size", "gram"])
        .withColumn("place", F.row_number().over(frequent))
        .filter(F.col("place") > spare)
        .select("item", "size", "gram", F.col("at").alias("item_at"), (F.col("fewest") - spare).alias("need"))
    )


def candidates(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, text_hash, places``: for each document with seeds enough, the items to align
    it with."""
    grams = stored(item_grams(items).withColumn("item", F.xxhash64("item_id", "item_words")), "item_grams")
    sizes = sorted(r["size"] for r in grams.select("size").distinct().collect())  # 1 to SEED
    narrow = grams.drop("item_id", "item_words")
    found = stored(occurrences(docs, bitmap(narrow, "gram"), sizes), "seed_runs")
    rare = stored(seeds(narrow, found), "seeds")
    enough = (
        found.join(rare, ["size", "gram"])
        .groupBy("doc_id", "text_hash", "item", "need")
        .agg(F.size(F.collect_set("item_at")).alias("hits"))  # at most an item's words
        .filter(F.col("hits") >= F.col("need"))
    )
    named = grams.filter(F.col("at") == 0).select("item", "item_id", "item_words")
    return (
        enough.join(named, "item")
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_list(F.struct("item_id", "item_words")).alias("places"))
    )


def seed_places(own: np.ndarray, pairs: list[np.ndarray], item: np.ndarray) -> np.ndarray:
    """Where in a document seeds of the item begin, given the hashes of its pairs of words
    side by side, and of those with a word between them."""
    sought = seed_hashes(item)
    if len(item) < SEED:
        return np.flatnonzero(np.isin(own, sought))
    return np.unique(np.concatenate([np.flatnonzero(np.isin(p, sought)) for p in pairs]))


def stretches(at: np.ndarray, item: int, doc: int) -> list[tuple[int, int]]:
    """Where to align an item of some words, given where its seeds begin; overlapping
    stretches as one.

    An alignment that counts matches m words and has up to ``2 m - item`` errors, so that it
    covers up to ``3 m - item`` words of the document, twice the item at most.
    """
    least, span = fewest(item), 2 * item
    first, last = at[: max(0, len(at) - least + 1)], at[least - 1 :]
    near = last - first < span
    out: list[tuple[int, int]] = []
    for x, y in zip(first[near].tolist(), last[near].tolist(), strict=True):
        begin, end = max(0, y - span), min(doc, x + span + 1)
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def align(item: np.ndarray, parts: list[np.ndarray]) -> np.ndarray:
    """Best local alignment score of the item with each part.

    All parts go through the table together, a row for each word of the item. Within a row
    a gap's cost is linear, so that the best way along it is a running maximum.
    """
    width = max(map(len, parts))
    table = np.zeros((len(parts), width), np.int64)
    held = np.zeros((len(parts), width), bool)
    for i, part in enumerate(parts):
        table[i, : len(part)] = part
        held[i, : len(part)] = True
    along = -GAP * np.arange(width, dtype=np.int32)
    row = np.zeros((len(parts), width + 1), np.int32)
    best = np.zeros(len(parts), np.int32)
    for word in item:
        step = np.where((table == word) & held, MATCH, MISMATCH).astype(np.int32)
        now = np.maximum(row[:, :-1] + step, row[:, 1:] + GAP)
        np.maximum(now, 0, out=now)
        now = np.maximum.accumulate(now + along, axis=1) - along
        row[:, 1:] = now
        np.maximum(best, now.max(axis=1), out=best)
    return best


def scores(texts: pd.Series, places: pd.Series) -> pd.Series:
    """Which of a document's places hold their item, by its index there."""
    out: list[list[dict]] = [[] for _ in range(len(texts))]
    asked = [i for i, p in enumerate(places) if p is not None and len(p)]
    for rows, b in words.batches([texts.iloc[i] for i in asked], words.PLAIN):
        hashes = b.hashes()
        for k, i in enumerate(asked[rows]):
            own = hashes[b.first[k] : b.first[k + 1]]
            pairs = [pair_hashes(own[:-apart], own[apart:]) for apart in (1, 2)]
            for n, place in enumerate(places.iloc[i]):
                item = np.asarray(place["item_words"], np.int64).view(np.uint64)
                where = stretches(seed_places(own, pairs, item), len(item), len(own))
                # Parts of a kind together; a long one does not widen the others.
                where.sort(key=lambda w: w[1] - w[0])
                best, spot = 0, (0, 0)
                for at in range(0, len(where), 64):
                    some = where[at : at + 64]
                    score = align(item.view(np.int64), [own[x:y].view(np.int64) for x, y in some])
                    j = int(score.argmax())
                    if score[j] > best:
                        best, spot = int(score[j]), some[j]
                similarity = best / (MATCH * len(item))
                if similarity >= SIMILARITY:
                    out[i].append(
                        {"item": n, "score": similarity, "first_word": spot[0], "last_word": spot[1]}
                    )
    release_memory()
    return pd.Series(out)


def _matched(docs: DataFrame, items: DataFrame, how: str) -> DataFrame:
    """Documents (with all that ``docs`` has) beside the matches found in them."""
    key = keyed(docs)
    places = candidates(key, items).select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("places").alias("__places")
    )
    same = docs["doc_id"].eqNullSafe(F.col("__id")) & (F.xxhash64(lowered()) == F.col("__hash"))
    score = F.pandas_udf(
        scores, "array<struct<item:int,score:double,first_word:int,last_word:int>>"
    )
    text = F.when(F.col("__places").isNotNull(), lowered())  # others need not travel
    return docs.join(places, same, how).withColumn("__found", score(text, "__places"))


def find_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, item_id, similarity`` and the stretch of words, of every match."""
    hit: Column = F.explode("__found").alias("hit")
    narrow = docs.select("doc_id", "text")
    return (
        _matched(narrow, items, "inner")
        .select("doc_id", hit, "__places")
        .select(
            "doc_id",
            F.element_at("__places", F.col("hit.item") + 1)["item_id"].alias("item_id"),
            F.round("hit.score", 6).alias("similarity"),
            F.col("hit.first_word").alias("first_word"),
            F.col("hit.last_word").alias("last_word"),
        )
    )


def drop_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that hold no item, all columns as they are."""
    names = docs.columns
    return _matched(docs, items, "left").filter(F.size("__found") == 0).select(*names)
