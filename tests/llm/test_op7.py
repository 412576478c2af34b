"""Quality measures against a plain count, and what votes tell."""

import collections
import re

import cases
import numpy as np

from newspipe.llm import quality
from newspipe.llm.queries import REGISTRY


def base(text):
    text = text or ""
    w = cases.words(text)
    seen, again = set(), 0
    for line in text.split("\n"):
        if cases.words(line):
            again += line in seen
            seen.add(line)
    grams = collections.Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {k + j for k in range(len(w) - 2) if grams[tuple(w[k : k + 3])] > 1 for j in range(3)}
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(w), sum(map(len, w)), symbols, again, len(covered), failed


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
MORE = [(30, "a b c a b c\na b c a b c\n\n \na b c a b c"), (31, "x\nx \nx\n\tx\nx"), (32, "#a *b| <c> $ % &amp;")]


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = REGISTRY["op7_weak_supervision"](spark, sf_dir).collect()
    found = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in got}
    assert found == {r.doc_id: base(r.text) for r in docs} and len(got) == len(docs)
    assert not any(r.base_failed and r.kept for r in got)
    # The labels, which nothing here has seen, agree.
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    judged = [(label[r.doc_id], r.kept) for r in got if r.doc_id in label and not r.base_failed]
    assert np.mean([bool(q) == k for q, k in judged]) > 0.97


def test_awkward_rows(spark):
    rows = [*cases.ROWS, *MORE]
    got = quality.judge(cases.documents(spark, rows))
    want = sorted(((d, *base(t)) for d, t in rows), key=repr)
    assert cases.plain_rows(got, "doc_id", *COLUMNS) == want


def test_no_rows(spark):
    assert quality.judge(cases.documents(spark, [])).count() == 0


def test_accuracies_are_found():
    """Votes drawn from known accuracies give them back, and beat counting votes."""
    rng = np.random.default_rng(3)
    n, right_on_good, right_on_bad = 20_000, [0.97, 0.9, 0.95, 0.99], [0.9, 0.5, 0.8, 0.4]
    good = rng.random(n) < 0.8
    votes = np.empty((n, 4), int)
    for k in range(4):
        right = rng.random(n) < np.where(good, right_on_good[k], right_on_bad[k])
        votes[:, k] = np.where(right, good, ~good)
        votes[rng.random(n) < 0.2, k] = 2
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality.estimate(patterns, counts.astype(float))
    assert abs(model.prior - 0.8) < 0.05
    assert np.abs(model.on_good - right_on_good).max() < 0.05
    assert np.abs(model.on_bad - right_on_bad).max() < 0.12
    assert ((model.posterior(votes) >= 0.5) == good).mean() > 0.93
