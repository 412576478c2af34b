"""The transducers against the library, on whole texts, in blocks and over random merge lists."""

import hashlib
import random

import cases
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from newspipe.llm import transducer
from newspipe.llm.queries import REGISTRY, WORD_VOCABULARY

COLUMNS = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD_VOCABULARY)


def ids_of(text, block=transducer.BLOCK):
    return np.frombuffer(b"".join(transducer.encode(text, WORD_VOCABULARY, block)), "<u4").tolist()


def plain(library, doc, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    said = library.decode(ids, skip_special_tokens=False)
    return doc, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(said.encode()).hexdigest()


def test_query(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = REGISTRY["op13_bounded_lookahead"](spark, sf_dir)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect())) == sorted(plain(library, *r) for r in docs)


def test_awkward_rows(spark, library):
    got = transducer.round_trip(cases.documents(spark), WORD_VOCABULARY)
    assert cases.plain_rows(got, *COLUMNS) == sorted((plain(library, *r) for r in cases.ROWS), key=repr)
    assert transducer.round_trip(cases.documents(spark, []), WORD_VOCABULARY).count() == 0


PARTS = ["a", "b", "the", "'", "'s", "'ll", "r", "e", "1", " ", "  ", "\n", "\x85", "́", "é", "漢", "가", "ᆨ",
         "<|endoftext|>", "<|startoftext|>", "<|", "|>", "end", "text", "!", "?!", "🙂", "Σ", "İ", "zzzzzz", "==", "̸",
         "<", "ve", "l", "ABC", "'RE", "\x00", "￿"]


def test_blocks_make_no_difference(library):
    rng = random.Random(1)
    for _ in range(600):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randrange(60)))
        ids = library.encode(text, add_special_tokens=False).ids
        for block in (1, 3, 7, 64, transducer.BLOCK):
            assert ids_of(text, block) == ids, (text, block)
        parts = list(transducer.encode(text, WORD_VOCABULARY, 5))
        assert "".join(transducer.decode(iter(parts), WORD_VOCABULARY)) == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("unit", ["a", "ab", "hello", "==", "in", "é", "漢", "abcdefg", None])
def test_words_without_end(library, unit):
    rng = random.Random(3)
    text = unit * 9000 if unit else "".join(rng.choice("abcdeinthsor") for _ in range(30_000))
    for block in (100, transducer.BLOCK):
        assert ids_of(text, block) == library.encode(text, add_special_tokens=False).ids


def test_the_window_is_bounded():
    stream = transducer.WordStream(transducer.vocabulary(WORD_VOCABULARY).merges)
    most = n = 0
    symbols = transducer.vocabulary(WORD_VOCABULARY).inside
    for i in range(20_000):
        n += len(list(stream.feed([symbols[97 + i * i % 7]])))
        most = max(most, len(stream.window))
    assert most <= stream.room < 2000 and n > 0


@settings(max_examples=300, deadline=None)
@given(st.randoms(use_true_random=False), st.integers(1, 14), st.lists(st.integers(0, 2), max_size=60), st.integers(1, 5))
def test_lookahead_of_any_merge_list(rng, n, word, step):
    """Tokens emitted early are those of the whole word, whatever the rules."""
    names, rules, seen = ["a", "b", "c"], [], set("abc")
    for _ in range(n):
        pair = rng.choice(names), rng.choice(names)
        if pair[0] + pair[1] not in seen:
            rules.append(pair)
            names.append(pair[0] + pair[1])
            seen.add(names[-1])
    ids = {name: i for i, name in enumerate(names)}
    size = {name: len(name) for name in names}
    pairs = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(rules)}
    merges = transducer.Merges(pairs, [size[x] for x in names], transducer.lookahead(rules, size))
    stream = transducer.WordStream(merges)
    stream.room = merges.ahead + 1
    out = []
    for at in range(0, len(word), step):
        out += list(stream.feed(word[at : at + step]))
    whole = list(word)
    for rank, (a, b) in enumerate(rules):
        at = 0
        while at + 1 < len(whole):
            if (whole[at], whole[at + 1]) == (ids[a], ids[b]):
                whole[at : at + 2] = [ids[a + b]]
            at += 1
    assert out + stream.finish() == whole


@given(st.binary(max_size=40) | st.text(max_size=20).map(str.encode), st.integers(1, 5))
def test_bytes_to_text(data, step):
    state = transducer.TextState()
    out = []
    for at in range(0, len(data), step):
        out.append(state.feed(data[at : at + step]))
        assert len(state.pending) <= 3
    assert "".join(out) + state.finish() == data.decode("utf-8", "replace")


def test_texts_read_back(spark):
    got = {r.doc_id: r.decoded for r in transducer.encoded(cases.documents(spark), WORD_VOCABULARY).collect()}
    assert got[4] == "one two " and got[6].split() == cases.SAME.split() and got[1] == got[2] == ""
    assert got[9] == "überall ñandú 漢字 🙂 ok "


def test_rules_out_of_order_are_refused():
    with pytest.raises(ValueError):
        transducer.lookahead([("ab", "c"), ("a", "b")], {"ab": 2, "a": 1})
