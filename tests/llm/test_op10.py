"""Language identification: held-out accuracy, windows, awkward rows."""

import random
import zlib

import cases
import numpy as np
import pytest

from newspipe.llm import language
from newspipe.llm.queries import REGISTRY

SYLLABLES = {"aa": ["ka", "to", "ri"], "bb": ["schl", "ung", "ech"], "cc": ["жи", "но", "ва"]}


def labelled(n=120):
    rng = random.Random(1)
    rows = []
    for i in range(n):
        lang = sorted(SYLLABLES)[i % 3]
        text = " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(3)) for _ in range(rng.randrange(5, 200)))
        rows.append((i, text, lang))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(
        [(*r, 1, 2) for r in rows], "doc_id long, text string, lang string, score int, held_out int"
    )


def test_query(spark, sf_dir):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = REGISTRY["op10_byte_network"](spark, sf_dir).collect()
    assert {r.doc_id for r in got} == set(lang) and len(got) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert all(0 <= r.score <= 1 for r in got)
    assert np.mean([lang[r.doc_id] == r.lang_pred for r in got if r.held_out]) > 0.97


def test_awkward_rows(spark):
    rows = [*labelled(), *[(1000 + i, t, None) for i, (_, t) in enumerate(cases.ROWS)], (None, "tokari", "aa")]
    got = language.identify(frame(spark, rows))
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    found = {r.doc_id: (r.lang_pred, r.score) for r in got.collect()}
    assert got.count() == len(rows)
    for i, t, _ in rows[120:]:
        if not any(c.isalpha() for c in t or ""):
            assert found[i] == ("und", 0.0)
        else:
            assert found[i][0] in SYLLABLES
    right = [found[i][0] == lang for i, _, lang in rows[:120]]
    assert np.mean(right) > 0.95


@pytest.mark.parametrize("rows", [[], [(1, "some text", None), (2, None, "en"), (3, "", "en")]])
def test_nothing_to_learn_from(spark, rows):
    got = language.identify(frame(spark, rows)).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)] * len(rows)


def test_the_sample_is_bounded_and_held_out_documents_are_not_in_it(spark):
    df = frame(spark, labelled(200)).unionByName(frame(spark, labelled(200)))
    rows = language.sample(df, per_language=7).collect()
    assert len(rows) == 21
    assert not any(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows)
    assert all(len(w) <= language.LENGTH for r in rows for w in r.windows)
    again = language.sample(df.repartition(5), per_language=7).collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in again}


def test_labels_are_no_input_of_a_prediction(spark):
    rows = labelled()
    net = language.fit(frame(spark, rows))
    other = [(i + 5000, t, "zz") for i, t, _ in rows]
    one = sorted((r.doc_id, r.lang_pred, r.score) for r in language.identify(frame(spark, rows), net).collect())
    two = sorted((r.doc_id - 5000, r.lang_pred, r.score) for r in language.identify(frame(spark, other), net).collect())
    assert one == two


def test_windows_cover_every_run():
    rng = np.random.default_rng(2)
    texts = [rng.integers(1, 255, n, np.uint8).tobytes() for n in (0, 1, 5, 255, 256, 257, 509, 510, 511, 5000)]
    symbols, owner, held = language.windowed(texts)
    wide = max(language.WIDTHS)
    for k, text in enumerate(texts):
        runs = {text[i : i + wide] for i in range(len(text) - wide + 1)}
        seen = set()
        for row, n in zip(symbols[owner == k], held[owner == k], strict=True):
            assert (row[n:] == language.PAD).all()
            body = row[:n].astype(np.uint8).tobytes()
            seen |= {body[i : i + wide] for i in range(n - wide + 1)}
        assert seen == runs


def test_gradients_lower_the_loss():
    rows = labelled()
    symbols, owner, _ = language.windowed([t.encode() for _, t, _ in rows])
    names = sorted(SYLLABLES)
    truth = [rows[i][2] for i in owner]
    net = language.train(symbols, truth, names, epochs=6)
    best = net.log_probabilities(symbols).argmax(axis=1)
    assert np.mean([names[b] == t for b, t in zip(best, truth, strict=True)]) > 0.98


def test_dropping_keeps_all_columns(spark):
    rows = [*labelled(), (500, "1234", None), (501, None, None), (502, "", None)]
    df = frame(spark, rows)
    left = language.drop_unidentified(df)
    assert left.columns == df.columns
    ids = {r.doc_id for r in left.collect()}
    assert not ids & {500, 501, 502} and len(ids) > 115
