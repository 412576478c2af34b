"""Near-duplicates against a comparison of all documents."""

import random

import cases
import numpy as np
import pytest

from newspipe.llm import forest
from newspipe.llm.components import components
from newspipe.llm.queries import REGISTRY


def shingles(text):
    w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in cases.words(text)]
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def brute(rows, percent=85):
    """``(n_shingles, component)`` of every row, by its place."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    inside = {}
    for i, s in enumerate(sets):
        for x in s:
            inside.setdefault(x, []).append(i)
    seen = set()
    for members in inside.values():
        for i in members:
            for j in members:
                if i < j and (i, j) not in seen:
                    seen.add((i, j))
                    shared = len(sets[i] & sets[j])
                    if 100 * shared >= percent * (len(sets[i]) + len(sets[j]) - shared):
                        root[find(j)] = find(i)
    for i, (doc, _) in enumerate(rows):  # rows of one id are one document
        for j in range(i):
            if doc is not None and rows[j][0] == doc and sets[i] and sets[j]:
                root[find(i)] = find(j)
    names = {}
    for i, (doc, _) in enumerate(rows):
        names.setdefault(find(i), []).append(doc)
    least = {r: min((d for d in docs if d is not None), default=None) for r, docs in names.items()}
    return [(len(s), least[find(i)]) for i, s in enumerate(sets)]


def check(spark, rows, percent=85):
    got = forest.near_duplicates(cases.documents(spark, rows), percent)
    found = cases.plain_rows(got, "doc_id", "n_shingles", "component_id", "kept")
    want = [(d, n, c, d is not None and d == c) for (d, _), (n, c) in zip(rows, brute(rows, percent), strict=True)]
    assert found == sorted(want, key=repr)


def test_awkward_rows(spark):
    check(spark, cases.ROWS)


def test_no_rows(spark):
    assert forest.near_duplicates(cases.documents(spark, [])).count() == 0


@pytest.mark.parametrize("percent", [85, 80])
def test_groups_of_edited_copies(spark, percent):
    """A chain of edits, a crowd around a common origin, and strangers."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))

    def edited(w, n):
        w = list(w)
        for _ in range(n):
            w[rng.randrange(len(w))] = word()
        return w

    texts = [" ".join(word() for _ in range(rng.randrange(3, 150))) for _ in range(60)]
    chain = [word() for _ in range(160)]
    for _ in range(25):
        texts.append(" ".join(chain))
        chain = edited(chain, 1)
    origin = [word() for _ in range(120)]
    texts += [" ".join(edited(origin, 1 + k % 2)) for k in range(120)] + [" ".join(origin)]
    texts += [" ".join(origin).upper()] * 5
    common = " ".join(word() for _ in range(30))
    texts += [f"{common} {' '.join(word() for _ in range(40))}" for _ in range(40)]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    check(spark, rows, percent)


def crowd(seed, n, words, edits):
    """Copies of one text that is not among them, each with its own edits."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    origin = [word() for _ in range(words)]
    texts = []
    for _ in range(n):
        copy = list(origin)
        for at in rng.sample(range(words), edits):
            copy[at] = word()
        texts.append(" ".join(copy))
    return list(enumerate(texts))


def components_of_crowd(rows, percent):
    """The smallest id each row is linked with, from the overlaps of all pairs."""
    sets = [shingles(t) for _, t in rows]
    column = {x: k for k, x in enumerate(set().union(*sets))}
    inside = np.zeros((len(rows), len(column)), np.float32)
    for i, s in enumerate(sets):
        inside[i, [column[x] for x in s]] = 1
    shared, size = inside @ inside.T, inside.sum(axis=1)
    linked = 100 * shared >= percent * (size[:, None] + size - shared)
    root = np.arange(len(rows))
    while True:
        least = np.where(linked, root, len(rows)).min(axis=1)
        if (least == root).all():
            return root.tolist()
        root = least


@pytest.mark.parametrize("edits, percent", [(5, 85), (6, 85), (8, 80)])
def test_crowds_without_their_origin(spark, monkeypatch, edits, percent):
    """Copies with just links enough to hang together, in more than a block."""
    monkeypatch.setattr(forest, "BLOCK", 300)
    rows = crowd(3, 1200, 400, edits)
    want = components_of_crowd(rows, percent)
    got = forest.near_duplicates(cases.documents(spark, rows), percent)
    assert {r.doc_id: r.component_id for r in got.collect()} == dict(enumerate(want))


def test_a_large_crowd(spark):
    rows = crowd(5, 5000, 120, 1)
    want = components_of_crowd(rows, 85)
    got = forest.near_duplicates(cases.documents(spark, rows))
    assert {r.doc_id: r.component_id for r in got.collect()} == dict(enumerate(want))


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    rows = [tuple(r) for r in docs]
    got = cases.plain_rows(
        REGISTRY["op4_lsh_forest"](spark, sf_dir), "doc_id", "n_shingles", "component_id", "kept"
    )
    assert got == sorted(((d, n, c, d == c) for (d, _), (n, c) in zip(rows, brute(rows), strict=True)), key=repr)


def test_one_of_each_group_stays(spark):
    df = cases.documents(spark)
    left = forest.drop_near_duplicates(df)
    assert left.columns == df.columns
    # 6, 7 and a row without id hold the same text; a null text without id has no name.
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 1, 2, 3, 4, 5, 6, 8, 9, 2**62 + 1]


@pytest.mark.parametrize("n", [2, 50])
def test_components_of_paths_and_stars(spark, n):
    path = [(i, i + 1) for i in range(n)]
    star = [(1000, 1001 + i) for i in range(n)]
    ring = [(5000 + i, 5000 + (i + 1) % n) for i in range(n)]
    links = spark.createDataFrame([*path, *star, *ring, (1, 0), (7, 7)], "a long, b long")
    root = {r.node: r.root for r in components(links).collect()}
    assert all(root[i] == 0 for i in range(n + 1))
    assert all(root[i] == 1000 for i in range(1000, 1001 + n))
    assert all(root[i] == 5000 for i in range(5000, 5000 + n))
