"""Packing documents into sequences by vector bin packing with the dot-product heuristic.

A document becomes its token ids and one end id, cut into pieces of one sequence each and
a rest. A sequence holds pieces under three limits at once: tokens, pieces (segments), and
tokens that bear loss. It is filled by the piece whose demand, as a vector in parts of the
limits, has the largest dot product with what is left of the sequence, weighted by how
scarce each limit is among the pieces to place; a new one is opened when nothing fits.

Pieces are packed in groups of bounded size, told from the ids and the number of pieces,
each a task's work on its own. Only numbers are shuffled: ids and checksums are worked out
where the text is read.

Tokens are those of the public tokenizer on the whole text. Splitting a text into the
tokenizer's pieces is done in numpy, after the tokenizer's own pattern, for all texts of a
batch at once, so that the tokenizer sees every different piece only once for a worker.

Of plain documents all tokens but a piece's first bear loss, so that with equal limits the
one on loss tokens never acts by itself; it is for rows that bring a ``loss`` of their own.

Null and empty texts are the end id alone. Very long texts make many full sequences.
Repeated rows are packed each, equal ones in different groups. Null ids are carried along. An empty table gives an empty
result. Columns other than ``doc_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import map_frames, stored
from .words import groups, run_hashes

CAPACITY = 2048
SEGMENTS = 64
LOSS_TOKENS = 2048
END = 1
GROUP = 4096
STORED_AT = "__number"  # of a piece where it is stored
CACHED = 1_000_000  # pieces that a worker remembers, in some 70 bytes each

SPACE, LETTER, NUMBER, OTHER = range(4)
# Code points with the property White_Space.
_WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
          0x202F, 0x205F, 0x3000]
# What the tokenizer's pattern splits off after an apostrophe.
_ENDINGS = ["s", "t", "re", "ve", "m", "ll", "d"]

_state: dict = {}


def character_classes() -> np.ndarray:
    """White space, letter, number or other, of every code point."""
    if "classes" not in _state:
        table = np.full(0x110000, OTHER, np.uint8)
        kinds = {"L": LETTER, "N": NUMBER}
        for c in range(0x110000):
            kind = kinds.get(unicodedata.category(chr(c))[0])
            if kind is not None:
                table[c] = kind
        table[_WHITE] = SPACE
        _state["classes"] = table
    return _state["classes"]


def split(codes: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """Where the pieces start in the joined code points of texts that start at ``offset``.

    The tokenizer's pattern in words: a run of letters, of numbers or of other signs takes
    one blank before it along; a run of white space leaves its last character to what
    follows; an apostrophe that starts a piece takes certain endings along.
    """
    n = len(codes)
    kind = character_classes()[codes]
    begins = np.zeros(n + 1, bool)
    begins[offset] = True
    change = np.ones(n + 1, bool)
    change[1:n] = kind[1:] != kind[:-1]
    change |= begins
    starts = change[:n].copy()
    # The last white space character before something else in the same text stands apart,
    # and joins what follows if it is a blank.
    white = kind == SPACE
    last = np.zeros(n, bool)
    last[:-1] = white[:-1] & ~white[1:] & ~begins[1:n]
    starts |= last
    blank = last & (codes == 32)
    starts[1:][blank[:-1]] = False
    # Apostrophes: a single one that starts a piece, with letters after it.
    alone = (codes == 39) & starts
    alone[:-1] &= starts[1:]
    alone[-1:] = False
    for at in np.flatnonzero(alone):
        if begins[at + 1] or kind[at + 1] != LETTER:
            continue
        two = "".join(map(chr, codes[at + 1 : at + 3]))
        for ending in _ENDINGS:
            if two.startswith(ending):
                stop = at + 1 + len(ending)
                if begins[at + 2 : stop].any():
                    continue
                starts[at + 1] = False
                if stop < n:
                    starts[stop] = True
                break
    return np.flatnonzero(starts)


class Numbers:
    """Numbers, from 0, of the 64-bit keys given; a hash table with linear probing."""

    def __init__(self) -> None:
        self.keys = np.empty(0, np.uint64)
        self.slots = np.full(1 << 10, -1, np.int32)

    def __len__(self) -> int:
        return len(self.keys)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Number of each key, -1 for new ones."""
        found = np.full(len(keys), -1, np.int32)
        mask = np.uint64(len(self.slots) - 1)
        left, slot = np.arange(len(keys)), keys & mask
        while len(left):
            here = self.slots[slot]
            left, slot, here = (x[here >= 0] for x in (left, slot, here))
            same = self.keys[here] == keys[left]
            found[left[same]] = here[same]
            left, slot = left[~same], slot[~same] + np.uint64(1) & mask
        return found

    def add(self, keys: np.ndarray) -> None:
        """Keys that are new and differ from each other."""
        number = np.arange(len(self.keys), len(self.keys) + len(keys), dtype=np.int32)
        self.keys = np.concatenate((self.keys, keys))
        size = len(self.slots)
        while size < 2 * len(self.keys):
            size *= 2
        if size > len(self.slots):
            self.slots = np.full(size, -1, np.int32)
            number = np.arange(len(self.keys), dtype=np.int32)
        mask = np.uint64(size - 1)
        slot = self.keys[number] & mask
        while len(number):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = number[free]  # one of those that ask for a slot gets it
            wait = self.slots[slot] != number
            number, slot = number[wait], slot[wait] + np.uint64(1) & mask


class Encoder:
    """Token ids of whole texts. Remembers the ids of pieces, by a hash of them."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab()
        self.width = np.zeros(max(vocabulary.values()) + 1, np.int64)  # bytes of a token
        for token, number in vocabulary.items():
            self.width[number] = len(token)  # a character stands for a byte
        self.clear()

    def clear(self) -> None:
        self.known = Numbers()
        self.flat = np.empty(0, np.uint32)  # ids of all known pieces
        self.stop = np.zeros(1, np.int64)  # where each piece's ids end, after a first 0

    def learn(self, keys: np.ndarray, texts: list[str]) -> None:
        """Ids of strings that the pattern leaves whole."""
        found = self.tokenizer.encode_batch_fast([texts], is_pretokenized=True, add_special_tokens=False)
        ids = np.array(found[0].ids, np.uint32)
        # Tokens hold all bytes of the strings, one string after the other.
        told = np.cumsum(self.width[ids])
        ends = np.cumsum([len(t.encode()) for t in texts])
        stop = np.searchsorted(told, ends)
        if told[-1] != ends[-1] or (told[stop] != ends).any():
            raise ValueError("the vocabulary's tokens are not made of bytes")
        self.known.add(keys)
        self.stop = np.concatenate((self.stop, stop + 1 + len(self.flat)))
        self.flat = np.concatenate((self.flat, ids))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, and where each text's begin, with the end."""
        sizes = np.array([len(t) for t in texts], np.int64)
        offset = np.concatenate(([0], np.cumsum(sizes)))
        joined = "".join(texts)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        if not len(codes):
            return np.empty(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        start = split(codes, offset[:-1][sizes > 0])
        end = np.append(start[1:], len(codes))
        if len(self.known) > CACHED:
            self.clear()
        keys = run_hashes(codes, start, end)
        spot = self.known.find(keys)
        new = np.flatnonzero(spot < 0)
        if len(new):
            first_number = len(self.known)
            fresh, first, back = np.unique(keys[new], return_index=True, return_inverse=True)
            strings = [joined[start[i] : end[i]] for i in new[first]]
            self.learn(fresh, strings)
            spot[new] = first_number + back
        at = self.stop[spot]
        counts = self.stop[spot + 1] - at
        ends = np.cumsum(counts)
        # The ids of every piece, one after the other.
        ids = self.flat[np.arange(ends[-1]) + np.repeat(at - ends + counts, counts)]
        piece = np.searchsorted(start, offset)
        return ids, np.concatenate(([0], ends))[piece]


def encoder(path: str) -> Encoder:
    """One for each worker and vocabulary."""
    if path not in _state:
        _state[path] = Encoder(path)
    return _state[path]


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens``: documents cut at the capacity."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(vocabulary).encode
        for frame in frames:
            texts = [t or "" for t in frame["text"]]
            doc_ids = frame["doc_id"]
            for rows in groups(np.array([len(t) for t in texts], np.int64), 1 << 19):
                ids, offset = encode(texts[rows])
                out = []
                for i in range(len(offset) - 1):
                    own = np.append(ids[offset[i] : offset[i + 1]], np.uint32(END)).astype("<u4")
                    for at in range(0, len(own), capacity):
                        part = own[at : at + capacity]
                        out.append((rows.start + i, at, len(part), zlib.crc32(part.tobytes()), len(own)))
                table = pd.DataFrame(out, columns=["row", "start", "length", "ids_crc32", "doc_tokens"])
                table.insert(0, "doc_id", doc_ids.iloc[table["row"]].to_numpy())
                yield table.drop(columns="row")

    source = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return map_frames(source, run, "start long, length long, ids_crc32 long, doc_tokens long")


def fill(demands: np.ndarray, limits: np.ndarray) -> list[list[int]]:
    """Sequences as lists of rows of ``demands``; every row is placed once.

    Rows alike in all demands are one kind, so that a step looks at kinds, not at rows.
    """
    kinds, back = np.unique(demands, axis=0, return_inverse=True)
    left = np.bincount(back.ravel(), minlength=len(kinds))
    stock = [[] for _ in kinds]
    for row in range(len(demands) - 1, -1, -1):
        stock[back.ravel()[row]].append(row)
    part = kinds / limits
    out: list[list[int]] = []
    total = (part * left[:, None]).sum(axis=0)
    while left.any():
        weight = total / max(total.max(), 1e-12)
        room, held = limits.astype(float).copy(), []
        while True:
            fits = (left > 0) & (kinds <= room).all(axis=1)
            if not held:
                fits = left > 0  # a demand above the limits stands alone
            if not fits.any():
                break
            score = np.where(fits, part @ (weight * np.maximum(room, 0) / limits), -1.0)
            best = int(score.argmax())
            held.append(stock[best].pop())
            left[best] -= 1
            room -= kinds[best]
            total = total - part[best]
        out.append(held)
    return out


def pack(
    rows: DataFrame,
    capacity: int = CAPACITY,
    segments: int = SEGMENTS,
    loss_tokens: int = LOSS_TOKENS,
    group: int = GROUP,
) -> DataFrame:
    """``sequence_id`` and ``offset`` for pieces with ``length`` and ``loss`` (tokens that bear
    loss). Full pieces are sequences by themselves, all others are packed by groups."""
    kind = rows.schema["doc_id"].dataType
    # Pieces that are equal in all else are told apart by where they are stored.
    told = [c for c in ("doc_id", "start", "ids_crc32", STORED_AT) if c in rows.columns]
    rows = rows.withColumn("__key", F.xxhash64(*told))
    rows = rows.withColumn("doc_id", F.col("doc_id").cast("string"))  # as in map_frames
    n = rows.filter(F.col("length") < capacity).count()
    n_groups = max(1, -(-n // group))
    limits = np.array([capacity, segments, loss_tokens])
    fields = [f for f in rows.schema.fields if f.name != "__key"]

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        number = int(frame["__group"].iloc[0])
        frame = frame.sort_values(["length", "__key", "start"], ascending=False, kind="stable")
        demands = np.column_stack(
            (frame["length"], np.ones(len(frame), np.int64), frame["loss"])
        )
        sequence, offset = np.zeros(len(frame), np.int64), np.zeros(len(frame), np.int64)
        lengths = frame["length"].to_numpy()
        for k, held in enumerate(fill(demands, limits)):
            sequence[held] = (number << 32) + k
            offset[held] = np.cumsum(lengths[held]) - lengths[held]
        return frame.drop(columns=["__group", "__key"]).assign(
            sequence_id=sequence, offset=offset
        )

    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    loose = (
        rows.filter(F.col("length") < capacity)
        .withColumn("__group", F.pmod("__key", F.lit(n_groups)))
        .groupBy("__group")
        .applyInPandas(run, f"{shape}, sequence_id long, offset long")
    )
    full = rows.filter(F.col("length") >= capacity).select(
        *[f.name for f in fields],
        (-1 - F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    return loose.unionByName(full).withColumn("doc_id", F.col("doc_id").cast(kind))


def pack_documents(docs: DataFrame, vocabulary: str, **limits: int) -> DataFrame:
    """Every piece of every document and its place in a sequence.

    All tokens of a piece but its first bear loss, as nothing stands before that one.
    """
    capacity = limits.get("capacity", CAPACITY)
    numbered = pieces(docs, vocabulary, capacity).withColumn(STORED_AT, F.monotonically_increasing_id())
    rows = stored(numbered, "pieces")
    return pack(rows.withColumn("loss", F.col("length") - 1), **limits).drop("loss", STORED_AT)
