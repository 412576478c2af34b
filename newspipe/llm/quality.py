"""Quality by weak supervision: rules vote or abstain, and their accuracies are estimated.

Each rule looks at one measure of a text and votes good, bad, or not at all. Texts are
counted by their pattern of votes, of which there is a fixed number at most, and an
expectation maximisation over these counts estimates the share of good texts and how often
each rule is right on either kind. A text is kept if it is good with a posterior of one
half or more. No rule has a veto, except for the base demands on length and repetition.

Null, empty and wordless texts have measures 0 and fail the base demand. Very long texts
are measured whole. Repeated rows are judged alike and each counts as a vote. An empty
table gives an empty result. A null id is carried along. Columns other than ``doc_id`` and
``text`` are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words
from .store import map_frames, stored, utf8

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
LEAST_POSTERIOR = 0.5

MEASURES = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_closed_lines", "n_upper_words", "n_letter_words", "n_plain_words", "n_shouts",
]
_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
_UPPER = np.isin(np.arange(256), np.arange(65, 91))
_LOWERCASE = np.isin(np.arange(256), np.arange(97, 123))
_LETTER = _UPPER | _LOWERCASE | (np.arange(256) > 127)
_CLOSING = np.isin(np.arange(256), list(b".!?:;\"')"))
_SHOUT = np.isin(np.arange(256), list(b"!"))


def measures(b: words.Batch) -> dict[str, np.ndarray]:
    """The measures of each text of a batch."""
    n_docs, data = len(b.offset) - 1, b.data

    def per_doc(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return sums[b.offset[1:]] - sums[b.offset[:-1]]

    def per_word(table: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(table[data], dtype=np.int64)))
        return sums[b.end] - sums[b.start]

    def count(doc: np.ndarray) -> np.ndarray:
        return np.bincount(doc, minlength=n_docs)

    line_end = np.flatnonzero(data == 10)
    line_start = np.concatenate(([0], line_end[:-1] + 1))
    first = np.searchsorted(b.start, line_start)
    last = np.searchsorted(b.start, line_end) - 1
    full = last >= first
    line_start, line_end, last = line_start[full], line_end[full], last[full]
    line_doc = b.doc[last]
    salt = words.mix(b.doc.astype(words.U))
    keys = words.run_hashes(data, line_start, line_end) ^ salt[last]
    _, earliest = np.unique(keys, return_index=True)
    again = np.ones(len(keys), bool)
    again[earliest] = False

    grams, at = words.windows(b.hashes(lower=False), b.doc, 3)
    twice = at[words.repeated(grams ^ salt[at])]
    cover = np.zeros(len(b.start) + 1, np.int64)
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + 3, -1)
    covered = np.cumsum(cover[:-1]) > 0

    letters = per_word(_LETTER)
    shouted = (per_word(_UPPER) > 1) & (per_word(_LOWERCASE) == 0)
    return {
        "n_words": b.n_words,
        "word_chars": per_doc(~words.SPACE[data] & ((data & 0xC0) != 0x80)),
        "n_symbols": per_doc(_SYMBOL[data]),
        "n_dup_lines": count(line_doc[again]),
        "n_repeat_words": count(b.doc[covered]),
        "n_lines": count(line_doc),
        "n_closed_lines": count(line_doc[_CLOSING[data[b.end[last] - 1]]]),
        "n_upper_words": count(b.doc[shouted]),
        "n_letter_words": count(b.doc[letters > 0]),
        "n_plain_words": count(b.doc[(letters > 0) & (per_word(_SYMBOL) == 0)]),
        "n_shouts": per_doc(_SHOUT[data]),
    }


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the measures of every document."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = list(frame["text"])
            for rows, b in words.batches(texts):
                yield pd.DataFrame({"doc_id": frame["doc_id"].iloc[rows].to_numpy()} | measures(b))

    source = docs.select("doc_id", utf8("text").alias("text"))
    return map_frames(source, run, ", ".join(f"{m} long" for m in MEASURES))


def _band(value: Column, good: tuple[float, float], fair: tuple[float, float]) -> Column:
    """1 within ``good``, 0 outside ``fair``, 2 (no vote) between them."""
    return (
        F.when(value.between(*good), 1).when(~value.between(*fair), 0).otherwise(2)
    )


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def rules() -> list[Column]:
    """The votes: 1 for good, 0 for bad, 2 for none."""
    any_more = float("inf")
    return [
        _band(F.col("n_words").cast("double"), (100.0, 100_000.0), (50.0, 200_000.0)),
        _band(_share("word_chars", "n_words"), (3.0, 10.0), (2.0, 15.0)),
        _band(_share("n_symbols", "n_words"), (0.0, 0.05), (0.0, 0.2)),
        _band(_share("n_dup_lines", "n_lines"), (0.0, 0.1), (0.0, 0.3)),
        _band(_share("n_repeat_words", "n_words"), (0.0, 0.15), (0.0, 0.35)),
        _band(_share("n_closed_lines", "n_lines"), (0.5, any_more), (0.1, any_more)),
        _band(_share("n_upper_words", "n_words"), (0.0, 0.1), (0.0, 0.4)),
        _band(_share("n_letter_words", "n_words"), (0.8, any_more), (0.6, any_more)),
        _band(_share("n_plain_words", "n_words"), (0.9, any_more), (0.75, any_more)),
        _band(_share("n_shouts", "n_words"), (0.0, 0.1), (0.0, 0.3)),
    ]


@dataclass
class Accuracies:
    """What the rules' agreement tells: the share of good texts, and each rule's chances of
    a right vote on good and on bad texts."""

    prior: float
    on_good: np.ndarray
    on_bad: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability of good for each row of votes."""
        up, down = votes == 1, votes == 0
        good = np.log(self.prior) + up @ np.log(self.on_good) + down @ np.log1p(-self.on_good)
        bad = np.log1p(-self.prior) + down @ np.log(self.on_bad) + up @ np.log1p(-self.on_bad)
        return 1 / (1 + np.exp(np.clip(bad - good, -700, 700)))


def estimate(votes: np.ndarray, counts: np.ndarray, rounds: int = 200) -> Accuracies:
    """Expectation maximisation over patterns of votes and how many texts have them.

    Starts from rules that are right more often than not. A rule may miss up to seven in ten
    bad texts, as each looks for one fault, but is never taken to be worse than a coin on good
    ones: this keeps good and bad from changing places, and faults of one kind from hiding
    those of another. Pseudo-counts stand for rules that seldom vote.
    """
    m = votes.shape[1]
    model = Accuracies(0.8, np.full(m, 0.9), np.full(m, 0.6))
    up, down = (votes == 1).T, (votes == 0).T
    for _ in range(rounds):
        good = model.posterior(votes) * counts
        bad = counts - good
        prior = (good.sum() + 8) / (counts.sum() + 10)
        on_good = (up @ good + 8) / ((up | down) @ good + 10)
        on_bad = (down @ bad + 6) / ((up | down) @ bad + 10)
        new = Accuracies(prior, np.clip(on_good, 0.5, 0.999), np.clip(on_bad, 0.3, 0.999))
        done = max(abs(new.prior - model.prior), *abs(new.on_bad - model.on_bad)) < 1e-9
        model = new
        if done:
            break
    return model


def judge(docs: DataFrame) -> DataFrame:
    """Measures, ``base_failed``, ``posterior`` and ``kept`` of every document."""
    spark = docs.sparkSession
    votes = rules()
    pattern = sum(vote * 3**i for i, vote in enumerate(votes)).cast("int")
    rows = stored(measured(docs).withColumn("pattern", pattern), "measured")
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    # One row per pattern, 3 ** len(rules) at most. What fails the base demands is judged
    # already and says nothing on the rules.
    counts = (
        rows.groupBy("pattern")
        .agg(F.count(F.when(~base_failed, 1)).alias("n"))
        .orderBy("pattern")
        .collect()
    )
    code = np.array([r["pattern"] for r in counts], np.int64)
    table = code[:, None] // 3 ** np.arange(len(votes)) % 3
    model = estimate(table, np.array([r["n"] for r in counts], float))
    known = [(int(c), float(p)) for c, p in zip(code, model.posterior(table))]
    posterior = spark.createDataFrame(known, "pattern int, posterior double")
    return (
        rows.join(F.broadcast(posterior), "pattern")
        .withColumn("base_failed", base_failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= LEAST_POSTERIOR))
    )
