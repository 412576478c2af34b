"""Words, lines and their hashes for whole batches of texts, in numpy.

Texts are UTF-8 bytes. A word is a run of bytes other than space and 9 to 13, which in
UTF-8 never cuts a character. The hash of a byte run is a polynomial in a fixed odd base
modulo 2**64, read off one running sum over the batch, and mixed at the end.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 2**64)
CHUNK = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Lower case, and ASCII signs as blanks: what is left of a text that is quoted loosely.
PLAIN = LOWER.copy()
PLAIN[[b for b in range(33, 127) if not chr(b).isalnum()]] = 32

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base`` to the power of 0 to n - 1 at least, modulo 2**64."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        size = max(n, CHUNK + 4096)
        known = np.full(size, base, U)
        known[0] = 1
        known = np.multiply.accumulate(known)
        if size <= 2 * CHUNK:
            _powers[base] = known
    return known


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole word (the finalizer of splitmix64)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def run_hashes(symbols: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each run ``symbols[start:end]``."""
    n = len(symbols)
    sums = np.empty(n + 1, U)
    sums[0] = 0
    np.cumsum((symbols.astype(U) + U(1)) * powers(BASE, n)[:n], out=sums[1:])
    total = (sums[end] - sums[start]) * powers(INVERSE, n + 1)[start]
    return mix(total + (end - start).astype(U))


def groups(sizes: np.ndarray, limit: int = CHUNK) -> Iterator[slice]:
    """Runs of rows with about ``limit`` bytes; a larger row stands alone."""
    at, total = 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > limit:
            yield slice(at, i)
            at, total = i, 0
        total += size + 1
    if at < len(sizes):
        yield slice(at, len(sizes))


@dataclass
class Batch:
    """Texts joined by line feeds, and the words found in them."""

    data: np.ndarray  # all bytes
    offset: np.ndarray  # where each text starts; one more at the end
    start: np.ndarray  # of words
    end: np.ndarray
    doc: np.ndarray  # which text a word is in
    first: np.ndarray  # first word of each text; one more at the end

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, lower: bool = True) -> np.ndarray:
        return run_hashes(LOWER[self.data] if lower else self.data, self.start, self.end)


def batch(texts: list[bytes], fold: np.ndarray | None = None) -> Batch:
    """``fold`` maps every byte to the one that counts for it, such as ``PLAIN``."""
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    if fold is not None:
        data = fold[data]
    offset = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=offset[1:])
    inside = np.zeros(len(data) + 1, np.int8)
    inside[1:] = ~SPACE[data]
    steps = np.diff(inside)
    start, end = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
    first = np.searchsorted(start, offset)
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    return Batch(data, offset, start, end, doc, first)


def batches(
    texts: list[bytes], fold: np.ndarray | None = None, limit: int = CHUNK
) -> Iterator[tuple[slice, Batch]]:
    for rows in groups(np.array([len(t) for t in texts], np.int64), limit):
        yield rows, batch(texts[rows], fold)


def windows(hashes: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` neighbours within a text, and where they start."""
    if len(hashes) < n:
        return np.empty(0, U), np.empty(0, np.int64)
    last = len(hashes) - n + 1
    at = np.flatnonzero(doc[:last] == doc[n - 1 :])
    out = np.zeros(len(at), U)
    for k in range(n):
        out = out * U(BASE) + hashes[at + k]
    return mix(out), at


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur twice or more."""
    _, back, n = np.unique(keys, return_inverse=True, return_counts=True)
    return n[back] > 1
