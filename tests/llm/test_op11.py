"""Collocations against a plain count of all phrases."""

import re
from collections import Counter

import cases
import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from newspipe.llm import phrases
from newspipe.llm.queries import REGISTRY


def plain(rows, least=30, best=2000, covered=80):
    counts, total = {}, Counter()
    for lang, text in rows:
        lang = lang or "und"
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        found = counts.setdefault(lang, Counter())
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            said = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(said)
            for n in range(1, 5):
                found.update(zip(*[said[i:] for i in range(n)], strict=False))
    out = []
    for lang, found in counts.items():
        known = {p: a for p, a in found.items() if len(p) > 1 and a >= least}
        longer = Counter()
        for p, a in known.items():
            for n in range(2, len(p)):
                for at in range(len(p) - n + 1):
                    longer[p[at : at + n]] = max(longer[p[at : at + n]], a)
        scored = []
        for p, a in known.items():
            if 100 * longer[p] >= covered * a > 0 and longer[p]:
                continue
            score, k = min((2_000_000 * a // (found[p[:k]] + found[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), found[p[:k]], found[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:best], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "text").collect()
    got = REGISTRY["op11_multikey_phrases"](spark, sf_dir)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect())) == plain([tuple(r) for r in docs])


@pytest.mark.parametrize(("task", "best"), [(1 << 20, 2000), (40, 2000), (300, 7)])
def test_heavy_beginnings_are_dealt_out(spark, task, best):
    rng = np.random.default_rng(5)
    some = [" ".join(rng.choice(["a", "b", "c", "de", "Über", "x."], 60)) for _ in range(60)]
    hot = ["the common phrase here " + w for w in rng.choice(["p q", "r", "s"], 300)]
    rows = [(i, t, ["en", None, "fr"][i % 3]) for i, t in enumerate(some + hot + ["\n".join(hot)])]
    rows += [(-1, None, "en"), (-1, "", None), (None, "one two", "und"), (None, "one two", "und")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("n", df_zero())
    got = phrases.collocations(df.repartition(5), least=5, best=best, task=task)
    assert sorted(map(tuple, got.collect())) == plain([(r[2], r[1]) for r in rows], 5, best)


def df_zero():
    from pyspark.sql import functions as F

    return F.lit(0)


def test_awkward_rows(spark):
    got = phrases.collocations(cases.documents(spark), least=2).collect()
    assert sorted(map(tuple, got)) == plain([(None, t) for _, t in cases.ROWS], 2)
    assert phrases.collocations(cases.documents(spark, [])).collect() == []


@given(st.lists(st.lists(st.integers(0, 3), min_size=3, max_size=3), max_size=40), st.integers(1, 4), st.integers(1, 3))
def test_quicksort_counts_equal_beginnings(rows, least, small):
    rows = np.array([r[: r.index(0)] + [0] * (3 - r.index(0)) if 0 in r else r for r in rows], np.uint64).reshape(-1, 3)
    weight = np.arange(1, len(rows) + 1)
    before, phrases.SMALL = phrases.SMALL, small
    try:
        got = {
            (depth, *map(int, rows[i, :depth])): int(n)
            for depth, first, size in phrases.multikey_counts(rows, weight, least)
            for i, n in zip(first, size, strict=True)
        }
    finally:
        phrases.SMALL = before
    want = Counter()
    for row, n in zip(rows.tolist(), weight.tolist(), strict=True):
        for depth in (1, 2, 3):
            if row[depth - 1]:
                want[(depth, *row[:depth])] += n
    assert got == {k: n for k, n in want.items() if n >= least}
