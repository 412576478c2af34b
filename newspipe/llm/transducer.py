"""BPE encoding and decoding as streaming transducers with bounded lookahead.

A merge list is applied to a word from left to right while the word is still coming in. What
is to come can change tokens only near the end of what is there: a merge across the end may
take a token away from a merge to its left, that one from the next, and so on. In such a
chain ranks rise, and every link moves left by the token it takes. ``lookahead`` finds the
longest chain of a merge list from its rules alone; a token that ends that far before the end
is stable and is emitted, and a boundary once stable parts the word into two that merge on
their own. So the encoder keeps a window of bounded size, however long a word is. Short words
are remembered, in a table of bounded size.

Before that, text is cut at special tokens, composed (NFC), put in lower case and split into
words, also block by block: what a later block could still change is held back.

Decoding looks up the bytes of each id and turns bytes into text with a state machine that
holds back the bytes of an unfinished character. ``decode`` gives the tokens' names parted by
blanks, as the library does for a vocabulary without decoder; ``decode_text`` gives the text
that the tokens stand for.

Null and empty texts have no tokens. Very long texts and words pass in blocks; only a run of
combining marks without end is held in full, as composing it needs all of them. What is a
letter or a number is told by Unicode 17, while the library knows Unicode 16. Repeated rows
come out each. Null ids are carried along. An empty table gives an empty result. Columns
other than ``doc_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import map_frames

BLOCK = 1 << 16  # characters read at a time
SHORT = 32  # characters of words that are remembered
REMEMBERED = 400_000
END = "</w>"

# The vocabulary's own pattern of a word, and the kinds of runs in it.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
LETTERS, SIGNS = regex.compile(r"\p{L}+"), regex.compile(r"[^\s\p{L}\p{N}]+")


def byte_names() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies.

    Printable bytes stand for themselves, the others for the characters from 256 on.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def lookahead(merges: list[tuple[str, str]], size: dict[str, int]) -> int:
    """Symbols behind a token that can still change it, at most.

    Rule ``(t, y)`` takes ``t`` from what is left of it if ``y`` stands there for a while. It
    depends on a rule ``(t2, y2)`` of lower rank if ``t2`` is how ``y`` begins, at a time
    before ``y``, or ``t2`` itself, is merged on. ``reach`` is the length of the longest chain
    that ends with a rule.
    """
    made = {a + b: rank for rank, (a, b) in enumerate(merges)}
    if len(made) < len(merges):
        raise ValueError("a token has two rules")
    if any(made.get(part, -1) >= rank for rank, pair in enumerate(merges) for part in pair):
        raise ValueError("a rule comes before one of its parts")
    best: dict[str, list[tuple[int, int]]] = {}  # by left part: ranks and the reach up to there

    def before(token: str, rank: int) -> int:
        """The longest chain that ends with a rule of the token below the rank."""
        rules = best.get(token, [])
        low, high = 0, len(rules)
        while low < high:
            middle = (low + high) // 2
            if rules[middle][0] < rank:
                low = middle + 1
            else:
                high = middle
        return rules[low - 1][1] if low else 0

    longest = 0
    for rank, (left, right) in enumerate(merges):
        chain, part, until = 0, right, rank
        while True:
            # Up to the rule that merges this part on, which may itself be the last link.
            chain = max(chain, before(part, until))
            if part not in made:
                break
            until = min(until, made[part] + 1)
            part = merges[made[part]][0]
        reach = chain + size[left]
        rules = best.setdefault(left, [])
        rules.append((rank, max(reach, rules[-1][1] if rules else 0)))
        longest = max(longest, reach)
    # The token itself must have been told from a longer one that begins with it.
    return longest + max(size.values(), default=1)


class Merges:
    """A merge list over token ids."""

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]], size: list[int], ahead: int):
        self.pairs = pairs  # two ids to the rank of their rule and what it makes
        self.size = size  # symbols in each id
        self.ahead = ahead

    def merge(self, symbols: list[int]) -> list[int]:
        """Tokens of a whole word: always the rule of the lowest rank, from the left."""
        if len(symbols) < 2:
            return symbols
        ids = list(symbols)
        after = list(range(1, len(ids) + 1))
        ahead = list(range(-1, len(ids) - 1))
        pairs = self.pairs
        heap = [(*rule, i) for i in range(len(ids) - 1) if (rule := pairs.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        n = len(ids)
        while heap:
            _, made, i = heapq.heappop(heap)
            j = after[i] if i < n and ids[i] >= 0 else n
            rule = pairs.get((ids[i], ids[j])) if j < n else None
            if rule is None or rule[1] != made:
                continue  # one of the two is gone
            ids[i], ids[j] = made, -1
            k = after[j]
            after[i] = k
            if k < n:
                ahead[k] = i
                if rule := pairs.get((made, ids[k])):
                    heapq.heappush(heap, (*rule, i))
            h = ahead[i]
            if h >= 0 and (rule := pairs.get((ids[h], made))):
                heapq.heappush(heap, (*rule, h))
        return [x for x in ids if x >= 0]


class WordStream:
    """Tokens of one word that comes in parts; holds a window of bounded size."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.window: list[int] = []
        self.room = 4 * merges.ahead + 64

    def feed(self, symbols: list[int]) -> Iterator[int]:
        for at in range(0, len(symbols), self.room):
            self.window += symbols[at : at + self.room]
            if len(self.window) >= self.room:
                yield from self._stable()

    def _stable(self) -> Iterator[int]:
        stop, end = 0, len(self.window) - self.merges.ahead
        for token in self.merges.merge(self.window):
            if stop + self.merges.size[token] > end:
                break
            stop += self.merges.size[token]
            yield token
        self.window = self.window[stop:]

    def finish(self) -> list[int]:
        rest, self.window = self.window, []
        return self.merges.merge(rest)


class Vocabulary:
    """What a vocabulary file says, made ready; read once for each worker."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        vocabulary = told["model"]["vocab"]
        rules = [tuple(r.split(" ")) if isinstance(r, str) else tuple(r) for r in told["model"]["merges"]]
        self.specials = {t["content"]: t["id"] for t in told["added_tokens"]}
        self.special = regex.compile("|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))) or r"\b\B")
        names = {**{i: name for name, i in vocabulary.items()}, **{i: c for c, i in self.specials.items()}}
        self.names = [names[i] for i in range(max(names) + 1)]
        length = {name: len(name.removesuffix(END)) or 1 for name in vocabulary}
        pairs = {
            (vocabulary[a], vocabulary[b]): (rank, vocabulary[a + b])
            for rank, (a, b) in enumerate(rules)
        }
        size = [length.get(name, 1) for name in self.names]
        self.merges = Merges(pairs, size, lookahead(rules, length))
        shown = byte_names()
        self.inside = [vocabulary[c] for c in shown]
        self.last = [vocabulary[c + END] for c in shown]
        self.called = [b" " + name.encode() for name in self.names]
        meant = {c: b for b, c in enumerate(shown)}
        self.bytes = [
            name.encode()
            if name in self.specials
            else bytes(meant[c] for c in name.removesuffix(END)) + b" " * name.endswith(END)
            for name in self.names
        ]
        self.known: dict[str, bytes] = {}

    def word(self, text: str) -> bytes:
        """Ids of a whole word, as little-endian unsigned 32-bit numbers."""
        found = self.known.get(text)
        if found is None:
            data = text.encode()
            symbols = [self.inside[b] for b in data[:-1]] + [self.last[data[-1]]]
            found = np.array(self.merges.merge(symbols), "<u4").tobytes()
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[text] = found
        return found


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def lowered(text: str) -> str:
    """Lower case of each character by itself: a final sigma is one like any other."""
    return text.replace("Σ", "σ").lower()


def composed_until(text: str) -> int:
    """How much of a text can be composed without what follows it."""
    for at in range(len(text) - 1, 0, -1):
        c = text[at]
        # Marks and the later letters of a Hangul syllable join what stands before them.
        if c < "̀" or not (unicodedata.category(c)[0] == "M" or "ᅠ" <= c <= "ᇿ"):
            return at
    return 0


class Encoder:
    """Ids of one text that comes in blocks, as bytes of little-endian 32-bit numbers."""

    def __init__(self, known: Vocabulary):
        self.v = known
        self.raw = ""  # may be the start of a special token
        self.loose = ""  # may still compose with what follows
        self.held = ""  # words that may go on
        self.open: tuple[regex.Pattern, WordStream] | None = None  # a long word that goes on
        self.byte = -1  # its last byte, which takes the mark of the end if nothing follows

    def feed(self, block: str) -> Iterator[bytes]:
        text = self.raw + block
        at = 0
        for match in self.v.special.finditer(text):
            yield from self._plain(text[at : match.start()], True)
            yield np.uint32(self.v.specials[match.group()]).astype("<u4").tobytes()
            at = match.end()
        rest = text[at:]
        longest = max(map(len, self.v.specials), default=1) - 1
        for n in range(min(longest, len(rest)), 0, -1):
            if any(s.startswith(rest[-n:]) for s in self.v.specials):
                break
        else:
            n = 0
        self.raw = rest[len(rest) - n :]
        yield from self._plain(rest[: len(rest) - n], False)

    def finish(self) -> Iterator[bytes]:
        rest, self.raw = self.raw, ""
        yield from self._plain(rest, True)

    def _plain(self, text: str, last: bool) -> Iterator[bytes]:
        """Words of text without special tokens."""
        text = self.loose + text
        until = len(text) if last else composed_until(text)
        self.loose = text[until:]
        ready = self.held + lowered(unicodedata.normalize("NFC", text[:until]))
        self.held = ""
        if self.open:
            kind, stream = self.open
            more = kind.match(ready)
            stop = more.end() if more else 0
            yield from self._long(stream, ready[:stop])
            if stop == len(ready) and not last:
                return
            yield from self._close()
            ready = ready[stop:]
        if last:
            yield self._words(WORD.findall(ready))
            return
        # The last word may go on in the next block, and decide what the one before is.
        tail = list(WORD.finditer(ready))
        stop = len(ready)
        if tail and tail[-1].end() == len(ready):
            stop = tail.pop().start()
            if tail and tail[-1].group() == "'" and tail[-1].end() == stop == len(ready) - 1:
                stop = tail.pop().start()
        yield self._words([m.group() for m in tail])
        rest = ready[stop:]
        if len(rest) <= SHORT:
            self.held = rest
            return
        self.open = LETTERS if LETTERS.match(rest) else SIGNS, WordStream(self.v.merges)
        yield from self._long(self.open[1], rest)

    def _words(self, words: list[str]) -> bytes:
        known, out = self.v.known, []
        for word in words:
            ids = known.get(word)
            if ids is None:
                if len(word) <= SHORT:
                    ids = self.v.word(word)
                else:
                    stream = WordStream(self.v.merges)
                    ids = b"".join([*self._long(stream, word), *self._close(stream)])
            out.append(ids)
        return b"".join(out)

    def _long(self, stream: WordStream, part: str) -> Iterator[bytes]:
        for at in range(0, len(part), BLOCK):
            data = part[at : at + BLOCK].encode()
            head = [self.v.inside[self.byte]] if self.byte >= 0 else []
            symbols = head + [self.v.inside[b] for b in data[:-1]]
            self.byte = data[-1]
            yield np.fromiter(stream.feed(symbols), "<u4").tobytes()

    def _close(self, stream: WordStream | None = None) -> Iterator[bytes]:
        if stream is None:
            stream, self.open = self.open[1], None
        yield np.fromiter(stream.feed([self.v.last[self.byte]]), "<u4").tobytes()
        self.byte = -1
        yield np.array(stream.finish(), "<u4").tobytes()


class TextState:
    """Bytes to text: holds back the bytes of an unfinished character, three at most."""

    def __init__(self) -> None:
        self.pending = b""

    def feed(self, data: bytes) -> str:
        data = self.pending + data
        cut = len(data)
        for back in range(1, min(3, cut) + 1):
            lead = data[-back]
            if lead & 0xC0 == 0x80:
                continue  # not the first byte of its character
            needs = 2 if 0xC2 <= lead < 0xE0 else 3 if lead & 0xF0 == 0xE0 else 4 if 0xF0 <= lead < 0xF5 else 1
            # Malformed ones end where the decoder itself would give up on them.
            if needs > back and unfinished(data[-back:]):
                cut -= back
            break
        self.pending = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def finish(self) -> str:
        rest, self.pending = self.pending, b""
        return rest.decode("utf-8", "replace")


def unfinished(data: bytes) -> bool:
    """Whether some character begins with these bytes; the second byte's range decides."""
    if len(data) < 2:
        return True
    low, high = {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}.get(
        data[0], (0x80, 0xBF)
    )
    return low <= data[1] <= high


class Decoder:
    """Text of ids that come in parts."""

    def __init__(self, table: list[bytes], skip: int = 0):
        self.table = table
        self.skip = skip  # bytes of the table left out once, at the start
        self.state = TextState()

    def feed(self, ids: bytes) -> str:
        data = b"".join(map(self.table.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        if self.skip and data:
            data, self.skip = data[self.skip :], 0
        return self.state.feed(data)

    def finish(self) -> str:
        return self.state.finish()


def encode(text: str, path: str, block: int = BLOCK) -> Iterator[bytes]:
    """Ids of a text in parts."""
    encoder = Encoder(vocabulary(path))
    for at in range(0, len(text), block):
        yield from encoder.feed(text[at : at + block])
    yield from encoder.finish()


def _decoded(parts: Iterator[bytes], decoder: Decoder) -> Iterator[str]:
    for part in parts:
        yield decoder.feed(part)
    yield decoder.finish()


def decode(parts: Iterator[bytes], path: str) -> Iterator[str]:
    """Names of the tokens, parted by blanks, in parts."""
    return _decoded(parts, Decoder(vocabulary(path).called, 1))


def decode_text(parts: Iterator[bytes], path: str) -> Iterator[str]:
    """The text that the tokens stand for, every word followed by a blank, in parts."""
    return _decoded(parts, Decoder(vocabulary(path).bytes))


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, decoded``: ids of each document as an array, and its words read back."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            ids, texts = [], []
            for text in frame["text"]:
                parts = list(encode(text, path))
                ids.append(np.frombuffer(b"".join(parts), "<u4").astype(np.int64))
                texts.append("".join(decode_text(iter(parts), path)))
            yield frame[["doc_id"]].assign(ids=ids, decoded=texts)

    source = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return map_frames(source, run, "ids array<long>, decoded string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every document."""

    def digests(text: str) -> tuple[int, str, str]:
        n, ids, words = 0, hashlib.sha256(), hashlib.sha256()
        decoder = Decoder(vocabulary(path).called, 1)
        for part in encode(text, path):
            n += len(part) // 4
            ids.update(part)
            words.update(decoder.feed(part).encode())
        words.update(decoder.finish().encode())
        return n, ids.hexdigest(), words.hexdigest()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [digests(text) for text in frame["text"]]
            columns = ["n_tokens", "ids_sha256", "decoded_sha256"]
            yield frame[["doc_id"]].join(pd.DataFrame(found, columns=columns, index=frame.index))

    source = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return map_frames(source, run, "n_tokens long, ids_sha256 string, decoded_sha256 string")
