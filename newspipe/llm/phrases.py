"""Collocations of two to four words, counted by multikey quicksort of suffix pointers.

A text is cut at punctuation and line ends into pieces, these into words. Every place where
a word stands points at a suffix: the word and up to three that follow in its piece. Suffixes
are dealt out by their leading words, so that all with the same beginning meet in one task;
there a three-way multikey quicksort parts them by their first word, the equal part by the
second, and so on to depth four. The size of an equal part is the count of the phrase that
its suffixes share, and parts below the least count are abandoned at once.

Two looks at the words come first. One counts all words, exactly, and how often leading pairs
and triples fall into the cells of two sketches of fixed size; suffixes end before a word that
is too rare to be in any phrase. A sketch never counts too few, so a pair whose cell is small
is small: its suffixes are routed by the leading pair. In a heavy cell they are routed by three
words, and if that is heavy too by all four, and the counts of shorter beginnings, which are
then spread over tasks, are added up. Equal suffixes of a batch travel as one with their
number. So neither a common word nor a common phrase makes a task large.

Words are told apart by 64-bit hashes in tasks. The word count goes by their texts too (by a
second hash within a batch), and if two words of a language share a hash, all is done again
with other hashes.

Null and empty texts have no words. A null language counts as ``und``. Very long texts are cut
whole. Repeated rows count each. Ties in score go by count and then by the phrase's UTF-8
bytes. An empty table gives an empty result. Columns other than ``text`` and ``lang`` are not
looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import words
from .bitmaps import bitmap, contained
from .store import release_memory, ship_package, stored, utf8

LONGEST = 4
LEAST = 30
BEST = 2000
COVERED = 80  # percent of a phrase's count that a longer one has to reach
SCALE = 2_000_000
TASK_SUFFIXES = 1 << 18  # routed to a task, on average
CELLS = 1 << 16
AT_ONCE = 2 << 20  # bytes of text cut at a time
SMALL = 4096  # suffixes sorted directly

U = np.uint64
# Where pieces end, and white space within them.
_STOP = np.zeros(256, bool)
_STOP[[*b".,;:!?", *range(10, 14)]] = True
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9]] = True


def hashed(data: np.ndarray, begin: np.ndarray, end: np.ndarray, seed: int) -> np.ndarray:
    """A hash of every word; another seed makes it an independent one."""
    other = np.random.default_rng(seed).permutation(256).astype(np.uint8)
    return words.run_hashes(other[data], begin, end)


def cut(texts: list[bytes], seed: int) -> tuple[np.ndarray, ...]:
    """Lower-cased bytes; begin, end, hash, text and piece of every word."""
    data = words.LOWER[np.frombuffer(b"\n".join([*texts, b""]), np.uint8)]
    inside = np.zeros(len(data) + 1, np.int8)
    inside[1:] = ~(_STOP | _BLANK)[data]
    steps = np.diff(inside)
    begin, end = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
    hashes = hashed(data, begin, end, seed)
    # Zero marks the end of a suffix.
    hashes[hashes == 0] = 1
    offset = np.cumsum([0, *(len(t) + 1 for t in texts)])
    piece = np.cumsum(_STOP[data])[begin] if len(begin) else begin
    return data, begin, end, hashes, np.searchsorted(offset, begin, "right") - 1, piece


def suffixes(hashes: np.ndarray, piece: np.ndarray, usable: np.ndarray) -> np.ndarray:
    """Rows of up to ``LONGEST`` words from each place on, zero behind the end."""
    n = len(hashes)
    out = np.zeros((n, LONGEST), U)
    going = usable.copy()
    for k in range(LONGEST):
        if k:
            going[: n - k] &= usable[k:] & (piece[k:] == piece[: n - k])
            going[max(0, n - k) :] = False
        out[: n - k, k][going[: n - k]] = hashes[k:][going[: n - k]]
    return out


def cells(rows: np.ndarray, lang: np.ndarray, n: int) -> np.ndarray:
    """The sketch cell of the first ``n`` words of each suffix."""
    key = lang.copy()
    for k in range(n):
        key = words.mix(key * U(words.BASE) + rows[:, k])
    return key


def multikey_counts(
    rows: np.ndarray, weight: np.ndarray, least: int, from_depth: int = 1, least_of: np.ndarray | None = None
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Depth, a row of each group of equal beginnings, and its size, by three-way quicksort.

    ``rows`` are sorted by pointer only. Groups below ``least`` (or below the smallest
    ``least_of`` of their rows) are abandoned, and those that end there have no longer ones.
    """
    depths = rows.shape[1]
    found: list[list[np.ndarray]] = [[] for _ in range(depths)]
    sizes: list[list[np.ndarray]] = [[] for _ in range(depths)]
    floor = np.full(len(rows), least, np.int64) if least_of is None else least_of
    work = [(np.arange(len(rows)), 0)]
    while work:
        at, d = work.pop()
        if len(at) <= SMALL:
            _sorted_counts(rows, weight, floor, at, d, found, sizes)
            continue
        key = rows[at, d]
        pivot = np.sort(key[:: max(1, len(key) // 31)])
        pivot = pivot[len(pivot) // 2]
        low, high = key < pivot, key > pivot
        for part in (at[low], at[high]):
            if len(part) and weight[part].sum() >= floor[part].min():
                work.append((part, d))
        same = at[~(low | high)]
        size = weight[same].sum()
        if pivot and size >= floor[same].min():
            found[d].append(same[:1])
            sizes[d].append(np.array([size]))
            if d + 1 < depths:
                work.append((same, d + 1))
    for d in range(from_depth - 1, depths):
        if found[d]:
            yield d + 1, np.concatenate(found[d]), np.concatenate(sizes[d])


def _sorted_counts(rows, weight, floor, at, d, found, sizes) -> None:
    """The same for a few pointers, which are sorted by all words left to look at."""
    depths = rows.shape[1]
    at = at[np.lexsort([rows[at, k] for k in range(depths - 1, d - 1, -1)])]
    new = np.ones(len(at), bool)
    new[1:] = False
    for k in range(d, depths):
        key = rows[at, k]
        new[1:] |= key[1:] != key[:-1]
        first = np.flatnonzero(new)
        size = np.add.reduceat(weight[at], first)
        keep = (key[first] != 0) & (size >= np.minimum.reduceat(floor[at], first))
        if not keep.any():
            return
        found[k].append(at[first[keep]])
        sizes[k].append(size[keep])
        # What goes on is only what belongs to a group that was kept.
        member = np.repeat(keep, np.diff([*first, len(at)]))
        at, new = at[member], new[member]


def distinct(rows: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal rows as one, in order, with their weights added."""
    order = np.lexsort(rows.T[::-1])
    rows = rows[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]).any(axis=1)
    first = np.flatnonzero(new)
    return rows[first], np.add.reduceat(weight[order], first)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Texts of a bounded number of bytes and the languages' numbers."""
    for batch in batches:
        step = max(1, batch.num_rows * AT_ONCE // max(1, batch.nbytes))
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            yield part.column("text").to_pylist(), part.column("lang").to_numpy().view(U)


def word_counts(docs: DataFrame, seed: int) -> DataFrame:
    """``kind, lang, hash, n, word``: words (kind 1), and cells of leading pairs and triples."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros((2, CELLS), np.int64)
        for texts, lang in _texts(batches):
            data, begin, end, hashes, doc, piece = cut(texts, seed)
            if not len(hashes):
                continue
            rows = suffixes(hashes, piece, np.ones(len(hashes), bool))
            for n in (2, 3):
                has = rows[:, n - 1] != 0
                cell = cells(rows[has], lang[doc[has]], n) % U(CELLS)
                sketch[n - 2] += np.bincount(cell.astype(np.int64), minlength=CELLS)
            spoken, second = lang[doc], hashed(data, begin, end, ~seed & 0xFFFF)
            order = np.lexsort((second, hashes, spoken))
            new = np.ones(len(order), bool)
            new[1:] = False
            for key in (spoken, hashes, second):
                new[1:] |= np.diff(key[order]).astype(bool)
            at = np.flatnonzero(new)
            first = order[at]
            yield _record(
                np.ones(len(at), np.int64), spoken[first], hashes[first], np.diff([*at, len(order)]),
                [data[begin[i] : end[i]].tobytes() for i in first],
            )
        for n in (2, 3):
            some = np.flatnonzero(sketch[n - 2])
            zero = np.zeros(len(some), np.int64)
            yield _record(zero + n, zero, some, sketch[n - 2][some], [b""] * len(some))
        release_memory()

    found = docs.mapInArrow(run, "kind long, lang long, hash long, n long, word binary")
    return found.groupBy("kind", "lang", "hash", "word").agg(F.sum("n").alias("n"))


def _record(kind, lang, key, n, word) -> pa.RecordBatch:
    numbers = [pa.array(np.asarray(c).astype(U).view(np.int64)) for c in (kind, lang, key, n)]
    return pa.RecordBatch.from_arrays(
        [*numbers, pa.array(word, pa.binary())], names=["kind", "lang", "hash", "n", "word"]
    )


def routed(docs: DataFrame, seed: int, usable: np.ndarray, heavy: list[np.ndarray], parts: int) -> DataFrame:
    """``part, rows``: suffixes of two words or more, with their weights, for each task."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((usable, heavy))  # a bitmap and two flags a cell

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, (pairs, triples) = shared.value
        for texts, lang in _texts(batches):
            _, _, _, hashes, doc, piece = cut(texts, seed)
            # Different texts never share a piece, as each ends with a line end.
            rows = suffixes(hashes, piece, contained(known, hashes ^ words.mix(lang)[doc]))
            some = rows[:, 1] != 0
            if not some.any():
                continue
            rows = np.column_stack((lang[doc[some]], rows[some]))
            rows, weight = distinct(rows, np.ones(len(rows), np.int64))
            two = cells(rows[:, 1:], rows[:, 0], 2)
            spread = pairs[two % U(CELLS)]
            three = cells(rows[:, 1:], rows[:, 0], 3)
            far = spread & triples[three % U(CELLS)] & (rows[:, 3] != 0)
            route = np.where(spread, three, two)
            route[far] = cells(rows[far, 1:], rows[far, 0], 4)
            part = (words.mix(route) % U(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            first = np.flatnonzero(np.diff(part[order], prepend=-1))
            packed = np.column_stack((rows, weight.astype(U), (spread + far.astype(int)).astype(U)))[order]
            stop = [*first[1:], len(order)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[order][first]),
                 pa.array([np.asfortranarray(packed[i:j]).tobytes("F") for i, j in zip(first, stop, strict=True)], pa.binary())],
                names=["part", "rows"],
            )
        release_memory()

    return docs.mapInArrow(run, "part long, rows binary")


def counted(found: DataFrame, parts: int, least: int) -> DataFrame:
    """``lang, words, n``: phrases of two words and more; spread ones in several rows."""
    width = LONGEST + 3

    def run(blocks: list[bytes]) -> Iterator[pa.RecordBatch]:
        table = np.concatenate([np.frombuffer(b, U).reshape(width, -1).T for b in blocks])
        blocks.clear()
        rows, weight, spread = table[:, : LONGEST + 1], table[:, LONGEST + 1].astype(np.int64), table[:, LONGEST + 2]
        # The column of languages comes first; suffixes routed by more words may be few here.
        floor = np.where(spread > 0, 1, least)
        for depth, first, size in multikey_counts(rows, weight, least, 3, floor):
            n = depth - 1
            whole = spread[first] < n - 1  # all that begin so are here
            keep = (size >= least) | ~whole
            first, size = first[keep], size[keep]
            flat = np.ascontiguousarray(rows[first, 1 : depth]).view(np.int64).ravel()
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[first, 0].view(np.int64)),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(first) + 1, dtype=np.int32) * n), pa.array(flat)),
                 pa.array(size)],
                names=["lang", "words", "n"],
            )

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Parts one after the other, as they come sorted."""
        now, held = None, []
        for batch in batches:
            for part, data in zip(batch.column("part").to_pylist(), batch.column("rows"), strict=True):
                if part != now and held:
                    yield from run(held)
                    held = []
                now = part
                held.append(data.as_py())
        if held:
            yield from run(held)
        release_memory()

    return (
        found.repartition(parts, "part")
        .sortWithinPartitions("part")
        .mapInArrow(tasks, "lang long, words array<long>, n long")
    )


def collocations(
    docs: DataFrame, least: int = LEAST, best: int = BEST, covered: int = COVERED, task: int = TASK_SUFFIXES
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's best phrases."""
    ship_package(docs.sparkSession)
    named = F.coalesce("lang", F.lit("und"))
    source = docs.select(F.xxhash64(named).alias("lang"), utf8("text").alias("text"))
    names = stored(docs.select(F.xxhash64(named).alias("lang"), named.alias("name")).distinct(), "languages")
    for seed in range(8):
        counts = stored(word_counts(source, seed), "word_counts")
        spelled = counts.filter(F.col("kind") == 1).groupBy("lang", "hash").agg(F.count("*").alias("n"))
        if spelled.filter(F.col("n") > 1).isEmpty():
            break
    else:
        raise ValueError("words share their hashes whatever the seed")
    vocabulary = counts.filter(F.col("kind") == 1)
    totals = stored(vocabulary.groupBy("lang").agg(F.sum("n").alias("total")), "totals")
    total = totals.agg(F.sum("total")).first()[0] or 0
    common = stored(vocabulary.filter(F.col("n") >= least).select("lang", "hash", "n", "word"), "common_words")
    heavy = []
    for kind in (2, 3):
        flags = np.zeros(CELLS, bool)
        some = counts.filter((F.col("kind") == kind) & (F.col("n") > task // 4)).select("hash").collect()  # CELLS at most
        flags[[r[0] for r in some]] = True
        heavy.append(flags)
    usable = bitmap(_keyed(common), "key")
    parts = max(1, -(-total // task))
    found = counted(routed(source, seed, usable, heavy, parts), parts, least)
    phrases = stored(
        found.groupBy("lang", "words").agg(F.sum("n").alias("n")).filter(F.col("n") >= least), "phrases"
    )
    return best_of(phrases, common, totals, names, best, covered)


def _keyed(common: DataFrame) -> DataFrame:
    """The key under which tasks look a word of a language up."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            lang, key = (frame[c].to_numpy(np.int64).view(U) for c in ("lang", "hash"))
            yield pd.DataFrame({"key": (key ^ words.mix(lang)).view(np.int64)})

    return common.select("lang", "hash").mapInPandas(run, "key long")


def best_of(
    phrases: DataFrame, common: DataFrame, totals: DataFrame, names: DataFrame, best: int, covered: int
) -> DataFrame:
    """Scores of phrases, without those that longer ones cover, the best of each language."""
    size = F.size("words")
    inner = F.transform(
        F.flatten(
            F.transform(
                F.sequence(F.lit(2), size - 1),
                lambda n: F.transform(F.sequence(F.lit(1), size - n + 1), lambda at: F.struct(at.alias("at"), n.alias("n"))),
            )
        ),
        lambda x: F.slice("words", x["at"], x["n"]),
    )
    longer = (
        phrases.filter(size > 2)
        .select("lang", F.explode(F.array_distinct(inner)).alias("words"), "n")
        .groupBy("lang", "words")
        .agg(F.max("n").alias("longer"))
    )
    keys = ["lang", "words"]
    staying = (
        phrases.join(longer, keys, "left")
        .filter(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("n") * covered))
        .select("lang", "words", F.col("n").alias("a"))
    )
    of_all = stored(
        phrases.unionByName(common.select("lang", F.array("hash").alias("words"), "n")), "counts_of_parts"
    )
    k = F.explode(F.sequence(F.lit(1), size - 1))
    cuts = staying.withColumn("k", k).select(
        *keys, "a", "k", F.slice("words", F.lit(1), F.col("k")).alias("head"), F.slice("words", F.col("k") + 1, size - F.col("k")).alias("tail")
    )
    for part, n in (("head", "l"), ("tail", "r")):
        known = of_all.select("lang", F.col("words").alias(part), F.col("n").alias(n))
        cuts = cuts.join(known, ["lang", part])
    score = F.expr(f"cast(cast(a as decimal(20,0)) * cast({SCALE} as decimal(8,0)) div (l + r) as bigint)")
    scored = (
        cuts.withColumn("score", score)
        .groupBy(*keys)
        .agg(F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("low"))
        .select(*keys, "a", "low.*")
    )
    scored = stored(scored, "scored")
    # Words are spelled out, as phrases order ties.
    spelled = (
        scored.select(*keys, F.posexplode("words").alias("at", "hash"))
        .join(common.select("lang", "hash", "word"), ["lang", "hash"])
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("spelled"))
        .select(*keys, F.array_join(F.transform("spelled", lambda x: x["word"].cast("string")), " ").alias("phrase"))
    )
    place = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return (
        scored.join(spelled, keys)
        .withColumn("rank", F.row_number().over(place))
        .filter(F.col("rank") <= best)
        .join(totals, "lang")
        .join(names, "lang")
        .select(
            F.col("name").alias("lang"), F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
            F.col("total").alias("n"), "score",
        )
    )
