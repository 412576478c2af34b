"""Exact substring removal with suffix arrays sorted in two stages.

Every byte covered by a string of ``LENGTH`` bytes that also starts anywhere else, in the
same or another text, is removed. Which bytes those are is read off suffix arrays: where
neighbours in one share a prefix of that length, both start such a string.

No array holds the corpus. Each text gives anchors: of each of its strings of ``LENGTH``
bytes, the place of the run of ``GRAM`` bytes with the smallest hash. Equal strings have
equal anchors at the same place within, so that all copies of a string lie in the contexts,
the strings that have the anchor taken together, of anchors with the same run. Equal
contexts are counted as one. What is counted twice repeats throughout; a context that shares
neither half of a string with another one of its run cannot repeat; the others go, by runs,
into blocks of bounded size, and a suffix array is built of each.

A block's array is built in two stages: only suffixes that are smaller than their
successor are sorted directly; a scan over the buckets of the first byte, in order, puts
every other suffix behind the ones its own tail was found behind.

A run with more different contexts than fit a block is split: a context goes along once
for each range of places where a string may start, under the bytes that all strings of the
range have in common, so that strings that are equal stay together.

Null and empty texts, and texts shorter than ``LENGTH``, lose nothing. Very long texts are
read whole. Repeated rows repeat each other throughout, if long enough. Null ids are
carried along. An empty table gives an empty result. Columns other than ``doc_id`` and
``text`` are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bitmaps import maybe_in
from .store import map_frames, release_memory, stored, utf8
from .words import BASE, INVERSE, U, groups, mix, powers

LENGTH = 400
GRAM = 32
BLOCK = 1024  # contexts in a block on the average, of up to two lengths each
CROWD = 2048  # different contexts of a run that go to one block as they are
AT_ONCE = 2 << 20  # bytes of texts that a worker looks at
RANGE = 16  # starts in one part of a split context


# --- anchors ------------------------------------------------------------------


def running_sums(data: np.ndarray) -> np.ndarray:
    """What the hashes of all runs are read off."""
    sums = np.zeros(len(data) + 1, U)
    np.cumsum((data.astype(U) + U(1)) * powers(BASE, len(data))[: len(data)], out=sums[1:])
    return sums


def hashes_at(sums: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the runs of ``size`` bytes that start at some places."""
    return mix((sums[at + size] - sums[at]) * powers(INVERSE, len(sums))[at])


def rolling(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` bytes."""
    n = len(data) - size + 1
    if n <= 0:
        return np.empty(0, U)
    sums = running_sums(data)
    return mix((sums[size:] - sums[:n]) * powers(INVERSE, n)[:n])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every ``width`` neighbours, from running minima within blocks."""
    n = len(x) - width + 1
    if n <= 0:
        return x[:0]
    full = np.full(-(-len(x) // width) * width, np.iinfo(x.dtype).max, x.dtype)
    full[: len(x)] = x
    table = full.reshape(-1, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def anchors(
    data: np.ndarray, offset: np.ndarray, length: int, gram: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places of the anchors of joined texts, the hashes of their runs, and where the first
    and the last string of ``length`` start that have them as anchor.

    Places are packed into the low bits of the hashes, so that the first of equal hashes
    is the smallest. Going through a text the anchor never moves back, so that the strings
    of one anchor stand together.
    """
    hashes = rolling(data, gram)
    if len(data) < length:
        none = np.empty(0, np.int64)
        return none, np.empty(0, U), none, none
    bits = U(max(1, int(len(data)).bit_length()))
    packed = hashes >> bits << bits | np.arange(len(hashes), dtype=U)
    least = sliding_min(packed, length - gram + 1)
    end = np.repeat(offset[1:], np.diff(offset))[: len(least)]
    inside = np.flatnonzero(np.arange(len(least)) + length <= end)  # strings do not cross texts
    found = (least[inside] & ((U(1) << bits) - U(1))).astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1]))) if len(found) else inside
    at = found[new]
    last = np.append(new[1:], len(found))[: len(new)] - 1
    return at, hashes[at], inside[new], inside[last]


def keyed(docs: DataFrame) -> DataFrame:
    text = utf8("text")
    return docs.select("doc_id", F.xxhash64(text).alias("text_hash"), text.alias("text"))


def anchored(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """One row for each anchor: the hash of its run, the digest of its context, where it is.

    ``left`` and ``right`` are hashes of the run with half of what a string of ``length`` may
    hold besides, before or after it; any such string holds one of the two. 0 is for halves
    that the text does not have.
    """
    reach = length - gram
    half = reach // 2

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame = frame[frame["text"].str.len() >= length]
            texts = list(frame["text"])
            for rows in groups(np.array([len(t) for t in texts], np.int64), AT_ONCE // 4):
                part = texts[rows]
                joined = b"".join(part)
                offset = np.concatenate(([0], np.cumsum([len(t) for t in part], dtype=np.int64)))
                data = np.frombuffer(joined, np.uint8)
                at, hashes, first, last = anchors(data, offset, length, gram)
                sums = running_sums(data)
                doc = np.searchsorted(offset, at, "right") - 1
                left, right = at - first, last + length - at
                before_half, after_half = np.zeros((2, len(at)), np.int32)
                for out, fits, from_ in (
                    (before_half, left >= half, at - half),
                    (after_half, right >= half + gram, at),
                ):
                    found = hashes_at(sums, from_[fits], half + gram)
                    out[fits] = (found >> U(33)).astype(np.int32) + 1
                digest = [
                    hashlib.blake2b(
                        joined[p - x : p + y], digest_size=12, salt=x.to_bytes(8)
                    ).digest()
                    for p, x, y in zip(at.tolist(), left.tolist(), right.tolist(), strict=True)
                ]
                yield frame[["doc_id", "text_hash"]].iloc[rows].iloc[doc].assign(
                    gram=hashes.view(np.int64), digest=digest, at=at - offset[doc],
                    before=left, after=right, left=before_half, right=after_half,
                )

    return map_frames(
        docs,
        run,
        "text_hash bigint, gram bigint, digest binary, at bigint, before int, after int,"
        " left int, right int",
        at_once=AT_ONCE,
    )


# --- suffix arrays --------------------------------------------------------------


_STRIDES = (256, 128, 64, 32, 16, 8)
_FEW = 8


def _packed(text: np.ndarray) -> np.ndarray:
    """Eight bytes from every place as one number, in the order of the bytes."""
    wide = np.concatenate((text, np.zeros(8, np.uint8)))
    out = np.zeros(len(text), U)
    for k in range(8):
        out = out << U(8) | wide[k : k + len(text)]
    return out


def _directly_sorted(
    text: np.ndarray, packed: np.ndarray, which: np.ndarray, depth: int
) -> np.ndarray:
    """Suffixes in order of their first ``depth`` bytes.

    Suffixes with the same such prefix are sorted as one. The others are sorted by eight
    bytes, and those still tied by the next eight, and so on. Ties of a few first move on,
    in strides that halve, over all bytes that the hashes show them to share.
    """
    full = np.concatenate((text, np.zeros(2 * depth + _STRIDES[0], np.uint8)))
    sums = running_sums(full)
    wide = np.concatenate((packed, np.zeros(2 * depth + 8, U)))
    _, first, back = np.unique(
        hashes_at(sums, which, depth), return_index=True, return_inverse=True
    )
    order = which[first]
    rank = np.zeros(len(order), np.int64)
    tied = np.arange(len(order))  # members of ties, tie by tie
    number = np.zeros(len(order), np.int64)  # of the tie each is in
    shared = np.zeros(1, np.int64)  # bytes that a tie is known to share
    while len(tied):
        head = np.flatnonzero(np.concatenate(([True], number[1:] != number[:-1])))
        size = np.diff(np.append(head, len(tied)))
        few = np.flatnonzero(size <= _FEW)
        if len(few):
            some = tied[np.repeat(size <= _FEW, size)]
            least = np.cumsum(size[few]) - size[few]
            for stride in _STRIDES:
                ahead = hashes_at(sums, order[some] + np.repeat(shared[few], size[few]), stride)
                same = np.minimum.reduceat(ahead, least) == np.maximum.reduceat(ahead, least)
                shared[few] += stride * (same & (shared[few] + stride <= depth))
        key = wide[order[tied] + np.repeat(shared, size)]
        by = np.lexsort((key, number))
        tied, key = tied[by], key[by]  # ties stay in place, so number and size still hold
        new = np.concatenate(([True], (number[1:] != number[:-1]) | (key[1:] != key[:-1])))
        starts = np.flatnonzero(new)
        within = starts - np.repeat(head, size)[starts]
        rank[tied] += np.repeat(within, np.diff(np.append(starts, len(tied))))
        count = np.diff(np.append(starts, len(tied)))
        go_on = (count > 1) & (np.repeat(shared, size)[starts] + 8 < depth)
        shared = np.repeat(shared, size)[starts][go_on] + 8
        keep = np.repeat(go_on, count)
        tied, number = tied[keep], np.repeat(starts, count)[keep]
    place = np.empty(len(order), np.int64)
    place[np.argsort(rank, kind="stable")] = np.arange(len(order))
    return which[np.argsort(place[back], kind="stable")]


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """All suffixes in order of their first ``depth`` bytes at least.

    ``text`` ends in its only 0. First the types: a suffix is small if it is less than the one that
    starts a byte later, which the first byte that differs from the next one tells. Small
    ones are sorted directly and stand at the ends of the buckets of their first byte. One
    scan in order of the buckets then appends, for each suffix met, the one that starts a
    byte earlier, if it is not small, to the front part of its bucket.
    """
    n = len(text)
    rises = np.zeros(n, np.int8)
    rises[:-1] = np.sign(text[1:].astype(np.int16) - text[:-1])
    next_change = np.where(rises != 0, np.arange(n), n - 1)
    next_change = np.minimum.accumulate(next_change[::-1])[::-1]
    small = rises[next_change] > 0
    small[n - 1] = True

    direct = _directly_sorted(text, _packed(text), np.flatnonzero(small), depth)
    count = np.bincount(text, minlength=256)
    count_small = np.bincount(text[direct], minlength=256)
    stop = np.cumsum(count)
    start = stop - count
    out = np.empty(n, np.int64)
    begin_small = stop - count_small
    cut = np.cumsum(count_small) - count_small
    for c in np.flatnonzero(count_small):
        out[begin_small[c] : stop[c]] = direct[cut[c] : cut[c] + count_small[c]]
    fill = start.copy()

    def induce(found: np.ndarray) -> None:
        earlier = found[found > 0] - 1
        earlier = earlier[~small[earlier]]
        if not len(earlier):
            return
        byte = text[earlier]
        by = np.argsort(byte, kind="stable")
        byte = byte[by]
        more = np.bincount(byte, minlength=256)
        first = np.cumsum(more) - more
        out[fill[byte] + np.arange(len(byte)) - first[byte]] = earlier[by]
        fill[:] += more

    for c in np.flatnonzero(count):
        done = start[c]
        while done < fill[c]:  # suffixes of the same bucket may follow from these
            now = fill[c]
            induce(out[done:now].copy())
            done = now
        induce(out[begin_small[c] : stop[c]])
    return out


def repeated_starts(
    strings: list[bytes], length: int, place: np.ndarray, surely: np.ndarray
) -> list[np.ndarray]:
    """For each string, where in it a run of ``length`` bytes starts that also starts
    elsewhere.

    Strings may be cut from the same text and overlap: ``place`` numbers the first byte of
    each, such that the same byte has the same number everywhere. What is in a string of
    ``surely`` is known to start elsewhere as well.
    """
    sizes = np.array([len(s) for s in strings], np.int64)
    offset = np.cumsum(sizes + 1) - sizes - 1
    raw = np.frombuffer(b"".join(s + b"\0" for s in strings) + b"\0", np.uint8)
    text = raw + np.uint8(2)  # UTF-8 has no bytes above 247
    text[offset + sizes] = 1  # less than any byte
    text[-1] = 0
    order = suffix_array(text, length)
    packed = np.concatenate((_packed(text), np.zeros(length + 8, U)))
    ends = np.append(np.repeat(offset + sizes, sizes + 1), 0)
    fits = np.arange(len(text)) + length <= ends
    order = order[fits[order]]
    if not len(order):
        return [np.empty(0, np.int64) for _ in strings]
    # Common prefixes of neighbours, as far as they matter: told by a hash, then byte by byte.
    sums = running_sums(np.concatenate((text, np.zeros(length, np.uint8))))
    prefix = hashes_at(sums, order, length)
    pair = np.flatnonzero(prefix[:-1] == prefix[1:])
    for at in [*range(0, length - 7, 8), length - 8]:
        pair = pair[packed[order[pair] + at] == packed[order[pair + 1] + at]]
    new = np.ones(len(order), bool)
    new[pair + 1] = False
    head = np.flatnonzero(new)  # runs of suffixes that share the prefix
    which = np.searchsorted(offset, order, "right") - 1
    number = place[which] + (order - offset[which])
    twice = np.minimum.reduceat(number, head) != np.maximum.reduceat(number, head)
    twice |= np.logical_or.reduceat(surely[which], head)
    marked = np.zeros(len(text), bool)
    marked[order] = twice[np.cumsum(new) - 1]
    return [np.flatnonzero(marked[o : o + s]) for o, s in zip(offset, sizes, strict=True)]


# --- putting it together ----------------------------------------------------------


def _runs(starts: np.ndarray) -> list[tuple[int, int]]:
    """Neighbouring starts as pairs of first and last."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > 1)
    return list(
        zip(starts[np.append(0, cut + 1)].tolist(), starts[np.append(cut, -1)].tolist(), strict=True)
    )


_CONTEXT = (
    "gram bigint, digest binary, n bigint, crowd bigint, before int, owner bigint, base bigint,"
    " context binary"
)


def fetched(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` contexts with their bytes, each from one text that has it."""
    asked = (
        wanted.groupBy("doc_id", "text_hash")
        .agg(
            F.collect_list(
                F.struct("gram", "digest", "n", "crowd", "at", "before", "after")
            ).alias("places")
        )
        .select(
            F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), "places"
        )
    )
    key = F.xxhash64("doc_id", "text_hash")
    few = docs.filter(maybe_in(wanted.select(key.alias("key")), "key", key))
    joined = few.join(
        asked, few["doc_id"].eqNullSafe(F.col("__id")) & (few["text_hash"] == F.col("__hash"))
    ).select(key.alias("owner"), "text", "places")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for owner, text, places in zip(
                frame["owner"], frame["text"], frame["places"], strict=True
            ):
                yield pd.DataFrame(
                    [
                        (
                            p["gram"], p["digest"], p["n"], p["crowd"], p["before"],
                            owner, p["at"] - p["before"],
                            text[p["at"] - p["before"] : p["at"] + p["after"]],
                        )
                        for p in places
                    ],
                    columns=_CONTEXT.replace(",", " ").split()[::2],
                )

    found = map_frames(joined, run, _CONTEXT, ids=(), at_once=AT_ONCE)
    return found.dropDuplicates(["gram", "digest"])


def _split(contexts: DataFrame, length: int, gram: int, width: int) -> DataFrame:
    """Contexts of crowded runs, once for each range of ``width`` starts they have.

    With the anchor at 0, strings that start from ``lo`` to ``hi`` all hold the bytes from
    ``hi`` to ``lo + length``; these are the key.
    """
    reach = length - gram
    low = F.explode(F.sequence(F.lit(-reach), F.lit(0), F.lit(width)))
    size = F.octet_length("context")
    rows = contexts.withColumn("lo", low).withColumn("hi", F.least(F.col("lo") + width - 1, F.lit(0)))
    begin, end = F.col("before") + F.col("hi"), F.col("before") + F.col("lo") + length
    cut = F.greatest(F.lit(0), F.col("before") + F.col("lo"))
    part = F.expr("substring(context, int(cut) + 1, int(until - cut))")
    return (
        rows.filter((begin >= 0) & (end <= size))
        .withColumn("cut", cut)
        .withColumn("until", F.least(size, F.col("before") + F.col("hi") + length))
        .withColumn("begin", begin)
        .withColumn("end", end)
        .withColumn("key", F.xxhash64("gram", "lo", F.expr("substring(context, int(begin) + 1, int(end - begin))")))
        .select(
            "gram", "digest", "n", "owner", "base", F.col("cut").cast("int").alias("cut"), "key",
            part.alias("context"),
        )
    )


def searched(contexts: DataFrame, length: int, block: int) -> DataFrame:
    """``gram, digest, starts``: runs of starts in a context that repeat in another one."""
    blocks = max(1, -(-contexts.count() // block))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        _, owner = np.unique(frame["owner"], return_inverse=True)
        place = (owner.astype(np.int64) << 40) + (frame["base"] + frame["cut"]).to_numpy()
        many = (frame["n"] > 1).to_numpy()
        found = repeated_starts(list(frame["context"]), length, place, many)
        runs = [
            [{"first": a + c, "last": b + c} for a, b in _runs(starts)]
            for starts, c in zip(found, frame["cut"], strict=True)
        ]
        out = frame[["gram", "digest"]].assign(starts=runs)
        release_memory()
        return out[np.array([len(r) > 0 for r in runs]) & ~many]

    # As many tasks as blocks: small in bytes, they are heavy in work.
    return (
        contexts.withColumn("block", F.pmod("key", F.lit(blocks)))
        .repartition(blocks, "block")
        .groupBy("block")
        .applyInPandas(run, "gram bigint, digest binary, starts array<struct<first:bigint,last:bigint>>")
    )


def _single_starts(contexts: DataFrame, length: int, gram: int) -> DataFrame:
    """The same by counting whole strings, for what no block can hold together."""
    place = F.struct("owner", (F.col("base") + F.col("cut")).alias("at"))
    strings = _split(contexts, length, gram, 1).select(
        "gram", "digest", "n", "cut", F.md5("context").alias("string"), place.alias("place")
    )
    twice = (
        strings.groupBy("string")
        .agg(F.min("place").alias("one"), F.max("place").alias("other"), F.max("n").alias("most"))
        .filter((F.col("one") != F.col("other")) | (F.col("most") > 1))
    )
    at = F.col("cut").cast("bigint")
    return strings.filter(F.col("n") == 1).join(twice, "string").select(
        "gram", "digest", F.array(F.struct(at.alias("first"), at.alias("last"))).alias("starts")
    )


def _crowds(contexts: DataFrame) -> DataFrame:
    """Runs with more than one context, and how many."""
    crowd = contexts.groupBy("gram").agg(F.count("*").alias("crowd"))
    return crowd.filter(F.col("crowd") > 1)


def repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, block: int = BLOCK
) -> DataFrame:
    """``doc_id, text_hash, parts``: the stretches of a text to be removed, not yet merged."""
    rows = stored(anchored(docs, length, gram), "anchors")
    # Most runs are met once and go no further; the bitmap keeps most of them from the shuffle.
    runs = rows.groupBy("gram").agg(F.count("*").alias("met")).filter("met > 1").select("gram")
    runs = stored(runs, "repeated_runs")
    maybe = rows.filter(maybe_in(runs, "gram", F.col("gram")))
    rows = stored(maybe.join(runs, "gram", "left_semi"), "repeated_anchors")
    place = F.struct("doc_id", "text_hash", "at", "before", "after", "left", "right")
    contexts = stored(
        rows.groupBy("gram", "digest")
        .agg(F.count("*").alias("n"), F.min(place).alias("place"))
        .filter(F.col("place.before") + F.col("place.after") >= length),
        "contexts",
    )
    whole = rows.join(contexts.filter(F.col("n") > 1).select("gram", "digest"), ["gram", "digest"])

    # Different contexts of a run, as far as they share more than the run with another one.
    several = stored(
        contexts.select("gram", "digest", "n", "place.*").join(_crowds(contexts), "gram"), "runs"
    ).drop("crowd")
    halves = several.select(
        "gram", "digest", F.posexplode(F.array("left", "right")).alias("side", "half")
    ).filter("half <> 0")
    shared = ["gram", "side", "half"]
    twice = halves.groupBy(*shared).agg(F.count("*").alias("twice")).filter("twice > 1")
    sharing = halves.join(twice, shared).select("gram", "digest").distinct()
    several = several.join(sharing, ["gram", "digest"], "left_semi")
    several = stored(several.join(_crowds(several), "gram"), "several")
    texts = stored(fetched(docs, several), "context_texts")
    most = CROWD * block // BLOCK  # in one block, not split
    usual = texts.filter(F.col("crowd") <= most).select(
        "gram", "digest", "n", "owner", "base", F.lit(0).alias("cut"),
        F.xxhash64("gram").alias("key"), "context",
    )
    crowded = texts.filter(F.col("crowd") > most)
    parts = stored(
        usual.unionByName(_split(crowded, length, gram, RANGE)), "context_parts"
    )
    too_many = parts.groupBy("key").agg(F.count("*").alias("held")).filter(F.col("held") > most)
    found = searched(parts.join(too_many, "key", "left_anti"), length, block)
    dense = parts.join(too_many, "key").select("gram", "digest").distinct()
    found = found.unionByName(
        _single_starts(texts.join(dense, ["gram", "digest"]), length, gram)
    )
    single = (
        several.filter(F.col("n") == 1)
        .join(found, ["gram", "digest"])
        .select("doc_id", "text_hash", (F.col("at") - F.col("before")).alias("base"), F.explode("starts").alias("run"))
    )
    stretches = whole.select(
        "doc_id",
        "text_hash",
        (F.col("at") - F.col("before")).alias("begin"),
        (F.col("at") + F.col("after")).alias("end"),
    ).unionByName(
        single.select(
            "doc_id",
            "text_hash",
            (F.col("base") + F.col("run.first")).alias("begin"),
            (F.col("base") + F.col("run.last") + length).alias("end"),
        )
    )
    return stretches.groupBy("doc_id", "text_hash").agg(
        F.collect_set(F.struct("begin", "end")).alias("parts")
    )


def merged(parts: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal stretches; those that touch are one."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted(parts):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((begin, end))
    return out


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    ends = [0, *(end for _, end in spans)]
    begins = [*(begin for begin, _ in spans), len(text)]
    return b"".join(text[x:y] for x, y in zip(ends, begins, strict=True))


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, block: int = BLOCK
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept, kept_sha256`` of every document.

    ``kept`` are the bytes that are left.
    """
    key = keyed(docs)
    found = stored(repeats(key, length, gram, block), "stretches").select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), "parts"
    )
    # Texts that surely lose nothing need no join.
    both = F.xxhash64("doc_id", "text_hash")
    hit = maybe_in(found.select(F.xxhash64("__id", "__hash").alias("key")), "key", both)
    some = key.filter(hit)
    rows = some.join(
        found,
        some["doc_id"].eqNullSafe(F.col("__id")) & (some["text_hash"] == F.col("__hash")),
        "left",
    ).select("doc_id", "text", "parts")
    whole = key.filter(~hit).select(
        "doc_id", "text", F.lit(None).cast(found.schema["parts"].dataType).alias("parts")
    )
    rows = rows.unionByName(whole)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for text, parts in zip(frame["text"], frame["parts"], strict=True):
                spans = merged([(p["begin"], p["end"]) for p in parts]) if parts is not None else []
                kept = without(text, spans)
                out.append((len(text), len(text) - len(kept), len(spans), kept, hashlib.sha256(kept).hexdigest()))
            table = pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])
            table.insert(0, "doc_id", frame["doc_id"].to_numpy())
            yield table

    return map_frames(
        rows,
        run,
        "n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string",
        at_once=AT_ONCE,
    )
