"""Benchmark items in documents: alignment, planted copies, awkward rows."""

import itertools
import random

import cases
import numpy as np
import pytest

from newspipe.llm import leaks
from newspipe.llm.bitmaps import bitmap, contained
from newspipe.llm.queries import REGISTRY


def smith_waterman(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            same = leaks.MATCH if x == y else leaks.MISMATCH
            table[i + 1][j + 1] = max(
                0, table[i][j] + same, table[i][j + 1] + leaks.GAP, table[i + 1][j] + leaks.GAP
            )
    return max(map(max, table))


def test_alignment():
    rng = np.random.default_rng(1)
    for _ in range(100):
        item = rng.integers(0, 6, rng.integers(1, 20))
        parts = [rng.integers(0, 6, rng.integers(0, 40)) for _ in range(5)]
        got = leaks.align(item, parts) if max(map(len, parts)) else [0] * 5
        assert list(got) == [smith_waterman(item.tolist(), p.tolist()) for p in parts]


def plain(text):
    return "".join(c.lower() if c.isalnum() or ord(c) > 127 else " " for c in text or "").split()


def brute(docs, items):
    """Every document aligned with every item."""
    out = set()
    for d, text in docs:
        w = plain(text)
        for i, item in items:
            v = plain(item)
            if v and smith_waterman(v, w) >= leaks.SIMILARITY * leaks.MATCH * len(v):
                out.add((d, i))
    return out


def world(seed=1):
    rng = random.Random(seed)
    word = lambda: rng.choice(["the", "of", "and", "to"]) if rng.random() < 0.3 else "".join(rng.choice("abcdefg") for _ in range(5))
    text = lambda n: [word() for _ in range(n)]
    items = [(i, " ".join(text(rng.randrange(12, 50)))) for i in range(12)] + [(20, "two words"), (21, None), (22, "")]
    docs = []
    for d in range(80):
        body = text(rng.randrange(20, 200))
        if d % 4 == 0:
            item = items[rng.randrange(12)][1].split()
            kind = d // 4 % 4
            if kind == 1:  # some words replaced
                for _ in range(len(item) // 6):
                    item[rng.randrange(len(item))] = word()
            elif kind == 2:  # some words left out
                del item[:: 7]
            elif kind == 3:  # in capitals, with signs
                item = [f"{w.upper()}," for w in item]
            at = rng.randrange(len(body))
            body[at:at] = item
        docs.append((d, " ".join(body)))
    return docs, items


def frames(spark, docs, items):
    return cases.documents(spark, docs), spark.createDataFrame(items, "item_id long, text string")


def test_planted_copies(spark):
    docs, items = world()
    got = leaks.find_leaks(*frames(spark, docs, items))
    found = {(r.doc_id, r.item_id) for r in got.collect()}
    want = brute(docs, items)
    assert found == want and len({d for d, _ in want}) >= 20


def test_dropping_keeps_the_rest_whole(spark):
    docs, items = world()
    df, bench = frames(spark, [*docs, *cases.ROWS[:5], cases.ROWS[-1]], items)
    left = leaks.drop_leaks(df, bench)
    assert left.columns == df.columns
    gone = {d for d, _ in brute(docs, items)}
    want = [r for r in [*docs, *cases.ROWS[:5], cases.ROWS[-1]] if r[0] not in gone or r[1] is None]
    assert cases.plain_rows(left, "doc_id") == sorted({(d,) for d, _ in want}, key=repr) or {
        r.doc_id for r in left.collect()
    } >= {d for d, _ in docs} - gone


def test_awkward_rows(spark):
    items = [(1, cases.SAME), (1, cases.SAME), (2, None), (None, "one two"), (3, "1234 5678")]
    got = leaks.find_leaks(*frames(spark, cases.ROWS, items))
    assert got.columns == ["doc_id", "item_id", "similarity", "first_word", "last_word"]
    found = cases.plain_rows(got, "doc_id", "item_id")
    assert found == sorted([(6, 1), (6, 1), (7, 1), (None, 1), (4, None), (8, 3)], key=repr)


@pytest.mark.parametrize("docs, items", [([], [(1, "a b c d")]), ([(1, "a b c d")], []), ([], [])])
def test_empty_tables(spark, docs, items):
    df, bench = frames(spark, docs, items)
    assert leaks.find_leaks(df, bench).count() == 0
    assert leaks.drop_leaks(df, bench).count() == len(docs)


def test_an_item_that_is_everywhere_keeps_its_seeds(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    docs = [(d, f"x{d} y{d} {item} z{d}") for d in range(300)]
    assert leaks.find_leaks(*frames(spark, docs, [(1, item)])).count() == 300


def heavily_edited(exact):
    """Items of many lengths in copies with every 2nd to 5th word changed, by each way of editing."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    items, docs = [], []
    for i, n in enumerate([3, 4, 5, 7, 9, 13, 20, 27, 40, 53]):
        item = [word() for _ in range(n)]
        items.append((i, " ".join(item)))
        for step in (2, 3, 4, 5):
            replaced = [word() if k % step == step - 1 else w for k, w in enumerate(item)]
            spread = [x for k, w in enumerate(item) for x in ([w, word()] if k % step == step - 1 else [w])]
            without = [w for k, w in enumerate(item) if k % step != step - 1]
            for body in (replaced, spread, without, [x for w in item for x in (w, word())]):
                around = [word() for _ in range(30)]
                docs.append((len(docs), " ".join(around[:11] + body + around[11:])))
        docs += [(len(docs) + k, f"{word()} {items[-1][1]} {word()}") for k in range(exact)]
    return docs, items


@pytest.mark.parametrize("exact", [0, 1, 5])
def test_heavily_edited_copies(spark, exact):
    docs, items = heavily_edited(exact)
    found = {(r.doc_id, r.item_id) for r in leaks.find_leaks(*frames(spark, docs, items)).collect()}
    want = brute(docs, items)
    assert found == want and len(want) > 60


def test_similarity_is_that_of_the_best_alignment(spark):
    docs, items = heavily_edited(1)
    texts, sought = dict(docs), dict(items)
    for r in leaks.find_leaks(*frames(spark, docs, items)).collect():
        item = plain(sought[r.item_id])
        best = smith_waterman(item, plain(texts[r.doc_id]))
        assert r.similarity == round(best / (leaks.MATCH * len(item)), 6)


def test_fewest_seeds_of_all_small_alignments():
    """Every document of few words against every item of few, all counted."""
    for n in range(3, 7):
        item = list(range(n))
        for size in range(1, 8):
            for doc in itertools.product(range(-1, n), repeat=size) if n < 5 or size < 6 else ():
                if smith_waterman(item, doc) >= n:
                    pairs = {*zip(item, item[1:], strict=False), *([(0, 2)] if n == 3 else [])}
                    at = [j for j in range(size) if {(doc[j], x) for x in doc[j + 1 : j + 3]} & pairs]
                    assert len(at) >= leaks.fewest(n)


def test_too_few_seeds_give_no_stretch():
    assert leaks.stretches(np.arange(5), 40, 100) == []


def test_bitmap(spark):
    values = np.arange(0, 300_000, 7)
    bits = bitmap(spark.range(0, 300_000, 7), "id")
    assert contained(bits, values.astype(np.uint64)).all()
    assert np.unpackbits(bits).sum() == len(values)


def test_query(spark, sf_dir):
    """All documents that hold an item word by word are found."""
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    items = [(r.item_id, " " + " ".join(plain(r.text)) + " ") for r in bench]
    want = set()
    for r in docs:
        text = " " + " ".join(plain(r.text)) + " "
        want |= {(r.doc_id, i) for i, item in items if item in text}
    found = {(r.doc_id, r.item_id) for r in REGISTRY["op6_rare_seeds"](spark, sf_dir).collect()}
    assert want and want <= found and len(found) < 1.2 * len(want)
