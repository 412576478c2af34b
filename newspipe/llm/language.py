"""Language identification by a convolutional network over bytes, trained in numpy.

Bytes are embedded, filters of several widths run over windows of a fixed length, each
filter's largest response feeds a softmax. A text is cut into windows that cover all of
it; its language is the one with the highest mean log probability, weighted by the bytes
in each window.

The network is trained on a bounded sample: of each language the ``PER_LANGUAGE`` labelled
documents with the smallest hash of their id, and of each document ``PER_DOCUMENT`` windows
spread over it. The sample depends on the ids only, not on how the table is stored.

Null texts and texts without a letter are ``und`` with score 0, and so is every text if
there is no label to learn from. Empty texts have no letter. Very long texts are read whole.
Repeated rows are predicted each. An empty table gives an empty result. A null id can
neither be held out nor learned from. Columns other than the four named are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .store import release_memory, ship_package, utf8

UNKNOWN = "und"
LENGTH = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
PAD = 256
STEP = LENGTH - max(WIDTHS) + 1  # windows overlap so that no run of bytes is missed
AT_ONCE = 64
PER_LANGUAGE = 600
PER_DOCUMENT = 4


@dataclass
class Network:
    """Weights. ``filters`` is one matrix for all widths; narrow ones end in zeros."""

    labels: list[str]
    embedding: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def responses(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Embedded runs of the widest filter, and every filter's response to each."""
        wide = max(WIDTHS)
        padded = np.pad(windows, ((0, 0), (0, wide - 1)), constant_values=PAD)
        runs = np.concatenate(
            [self.embedding[padded[:, k : k + LENGTH]] for k in range(wide)], axis=2
        )
        n = len(windows)
        found = runs.reshape(n * LENGTH, -1) @ self.filters
        return runs, found.reshape(n, LENGTH, -1)

    def log_probabilities(self, windows: np.ndarray) -> np.ndarray:
        pooled = np.maximum(self.responses(windows)[1].max(axis=1) + self.bias, 0)
        return log_softmax(pooled @ self.out + self.out_bias)


def log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def _width_mask() -> np.ndarray:
    rows = np.arange(max(WIDTHS) * EMBEDDING)[:, None] // EMBEDDING
    return (rows < np.repeat(WIDTHS, FILTERS)).astype(np.float32)


def train(
    windows: np.ndarray, labels: list[str], names: list[str], epochs: int = 12, seed: int = 7
) -> Network:
    """Fit a network by Adam on cross entropy, languages weighted alike.

    The gradient passes through the largest response of each filter only, so a step costs
    little more than the forward pass.
    """
    rng = np.random.default_rng(seed)
    y = np.array([names.index(x) for x in labels])
    weight = (len(y) / len(names) / np.maximum(np.bincount(y, minlength=len(names)), 1))[y]
    wide, n_filters, mask = max(WIDTHS), FILTERS * len(WIDTHS), _width_mask()
    scale = lambda *shape, s: rng.normal(0, s, shape).astype(np.float32)
    net = Network(
        names,
        scale(PAD + 1, EMBEDDING, s=0.5),
        scale(wide * EMBEDDING, n_filters, s=0.25) * mask,
        np.zeros(n_filters, np.float32),
        scale(n_filters, len(names), s=0.2),
        np.zeros(len(names), np.float32),
    )
    net.embedding[PAD] = 0
    parts = ["embedding", "filters", "bias", "out", "out_bias"]
    first = {p: np.zeros_like(getattr(net, p)) for p in parts}
    second = {p: np.zeros_like(getattr(net, p)) for p in parts}
    size, step = 32, 0
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        rate = 0.004 * (1 - epoch / epochs) + 0.0004
        for at in range(0, len(y), size):
            pick = order[at : at + size]
            x, n = windows[pick], len(pick)
            runs, found = net.responses(x)
            best = found.argmax(axis=1)  # window, filter
            value = np.take_along_axis(found, best[:, None, :], 1)[:, 0] + net.bias
            pooled = np.maximum(value, 0)
            slope = np.exp(log_softmax(pooled @ net.out + net.out_bias))
            slope[np.arange(n), y[pick]] -= 1
            slope *= (weight[pick] / n)[:, None]
            slope = slope.astype(np.float32)
            back = (slope @ net.out.T) * (value > 0)
            picked = runs[np.arange(n)[:, None], best]  # window, filter, run
            into = back[:, :, None] * net.filters.T[None]  # the same shape
            grad = {
                "out": pooled.T @ slope,
                "out_bias": slope.sum(0),
                "bias": back.sum(0),
                "filters": np.einsum("nf,nfr->rf", back, picked) * mask,
                "embedding": np.zeros_like(net.embedding),
            }
            padded = np.pad(x, ((0, 0), (0, wide - 1)), constant_values=PAD)
            symbols = padded[np.arange(n)[:, None, None], best[:, :, None] + np.arange(wide)]
            np.add.at(
                grad["embedding"], symbols.ravel(), into.reshape(-1, EMBEDDING)
            )
            grad["embedding"][PAD] = 0
            step += 1
            for p in parts:
                first[p] += 0.1 * (grad[p] - first[p])
                second[p] += 0.001 * (grad[p] ** 2 - second[p])
                move = first[p] / (1 - 0.9**step)
                move /= np.sqrt(second[p] / (1 - 0.999**step)) + 1e-7
                getattr(net, p)[...] -= rate * move
    return net


def windowed(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of the texts, the text each is from, and the bytes it holds."""
    sizes = np.array([len(t) for t in texts], np.int64)
    n = np.maximum(1, -(-(sizes - LENGTH + STEP) // STEP))
    owner = np.repeat(np.arange(len(texts)), n)
    order = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    data = np.frombuffer(b"".join(texts) + b"\0", np.uint8)
    begin = order * STEP
    held = np.clip(sizes[owner] - begin, 0, LENGTH)
    start = (np.cumsum(sizes) - sizes)[owner] + begin
    at = start[:, None] + np.arange(LENGTH)
    inside = np.arange(LENGTH) < held[:, None]
    symbols = data[np.minimum(at, len(data) - 1)].astype(np.int16)
    symbols[~inside] = PAD
    return symbols, owner, held


def classify(net: Network, texts: Iterable[bytes]) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    best, score = [], []
    pending: list[bytes] = []

    def flush() -> None:
        if not pending:
            return
        symbols, owner, held = windowed(pending)
        total = np.zeros((len(pending), len(net.labels)))
        for at in range(0, len(owner), AT_ONCE):
            part = slice(at, at + AT_ONCE)
            logs = net.log_probabilities(symbols[part]) * held[part, None]
            np.add.at(total, owner[part], logs)
        p = np.exp(log_softmax(total / np.maximum(np.bincount(owner, held), 1)[:, None]))
        best.extend(net.labels[i] for i in p.argmax(axis=1))
        score.extend(p.max(axis=1))
        pending.clear()

    size = 0
    for text in texts:
        pending.append(text)
        size += len(text)
        if size > 1 << 18:
            flush()
            size = 0
    flush()
    return best, np.array(score)


def has_letter(text: str | None) -> bool:
    return text is not None and any(c.isalpha() for c in text)


def held_out() -> Column:
    """Documents that are never learned from: a quarter, by the checksum of the id."""
    return F.coalesce(
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False)
    )


def sample(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """``lang, windows`` of the documents to learn from, ``per_language`` of each at most."""
    labelled = docs.filter(
        F.col("lang").isNotNull()
        & F.col("text").isNotNull()
        & F.col("doc_id").isNotNull()
        & ~held_out()
        & (F.length("text") > 0)
    )
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = (
        labelled.select("doc_id", "lang")
        .distinct()
        .withColumn("nth", F.row_number().over(order))
        .filter(F.col("nth") <= per_language)
        .select("doc_id")
        .distinct()
    )
    text = utf8("text")
    room = F.greatest(F.octet_length(text) - LENGTH, F.lit(0))
    spread = [
        F.substring(text, (F.floor(room * k / max(1, PER_DOCUMENT - 1)) + 1).cast("int"), F.lit(LENGTH))
        for k in range(PER_DOCUMENT)
    ]
    return (
        labelled.join(F.broadcast(ids), "doc_id")  # a bounded number for each language
        .select("doc_id", "lang", F.array_distinct(F.array(*spread)).alias("windows"))
        .dropDuplicates(["doc_id"])
        .select("doc_id", "lang", "windows")
    )


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Network | None:
    """A network for the languages of the labels; none if there are no labels."""
    rows = sorted(sample(docs, per_language).collect(), key=lambda r: r["doc_id"])
    pairs = [(bytes(w), r["lang"]) for r in rows for w in r["windows"]]
    if not pairs:
        return None
    symbols, owner, _ = windowed([w for w, _ in pairs])
    names = sorted({lang for _, lang in pairs})
    return train(symbols, [pairs[i][1] for i in owner], names)


def prediction(net: Network | None, text: str = "text") -> Column:
    """``struct<lang_pred, score>`` of a text column."""
    ship_package()

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame({"lang_pred": UNKNOWN, "score": 0.0}, index=texts.index)
        known = texts[[net is not None and has_letter(t) for t in texts]]
        if len(known):
            best, score = classify(net, (t.encode() for t in known))
            out.loc[known.index, "lang_pred"] = best
            out.loc[known.index, "score"] = np.clip(score, 0, 1)
        release_memory()
        return out

    return predict(F.col(text))


def identify(docs: DataFrame, net: Network | None = None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document."""
    net = net or fit(docs)
    return docs.select(
        "doc_id", held_out().alias("held_out"), prediction(net).alias("found")
    ).select("doc_id", "held_out", "found.lang_pred", "found.score")


def drop_unidentified(docs: DataFrame) -> DataFrame:
    """The documents in some language, however mixed, all columns as they are."""
    found = "__language_found"
    return (
        docs.withColumn(found, prediction(fit(docs)))
        .filter(F.col(f"{found}.lang_pred") != UNKNOWN)
        .drop(found)
    )
