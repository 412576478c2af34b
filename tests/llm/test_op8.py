"""Packing: token ids, limits and places against the tokenizer and a plain count."""

import random
import zlib

import cases
import numpy as np
import pytest
from tokenizers import Tokenizer

from newspipe.llm import packing
from newspipe.llm.queries import REGISTRY, VOCABULARY


@pytest.fixture(scope="module")
def tokenizer():
    made = Tokenizer.from_file(VOCABULARY)
    made.encode_special_tokens = True
    return made


def check(rows, texts, tokenizer, capacity, segments=packing.SEGMENTS):
    """Pieces are the documents' ids, and lie gapless in sequences within the limits."""
    want = []
    for doc, text in texts:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for at in range(0, len(ids), capacity):
            part = ids[at : at + capacity]
            want.append((doc, at, len(part), zlib.crc32(part.tobytes()), len(ids)))
    got = [(r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity and len(held) <= segments
    return len(sequences)


def test_query(spark, sf_dir, tokenizer):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    rows = REGISTRY["op8_vector_packing"](spark, sf_dir).collect()
    n = check(rows, [tuple(r) for r in docs], tokenizer, 2048)
    assert sum(r.length for r in rows) > 0.99 * 2048 * n


@pytest.mark.parametrize("group", [4096, 3])
def test_awkward_rows(spark, tokenizer, group):
    df = cases.documents(spark)
    rows = packing.pack_documents(df, VOCABULARY, capacity=64, segments=3, group=group).collect()
    check(rows, cases.ROWS, tokenizer, 64, 3)


def test_equal_rows_do_not_meet_in_one_group(spark, tokenizer):
    rows = [(None, None)] * 500 + [(-3, "the same words here")] * 500
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = packing.pack_documents(df, VOCABULARY, capacity=64, group=50).collect()
    check(got, rows, tokenizer, 64)
    groups = {}
    for r in got:
        groups[r.sequence_id >> 32] = groups.get(r.sequence_id >> 32, 0) + 1
    assert max(groups.values()) < 150


def test_no_rows(spark):
    assert packing.pack_documents(cases.documents(spark, []), VOCABULARY).count() == 0


def test_ids_are_the_tokenizers(tokenizer):
    rng = random.Random(1)
    parts = ["a", "b", "s", "t", "re", "'", "''", " ", "  ", "\n", "\t", "1", "²", "é", "!", "...", " ", "ll", "S",
             "漢", "　", "🙂", "'s", "'t", "'re", "x'll", "\r\n", "<|endoftext|>", "_", "Ⅷ", "\x1c", "​"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(14))) for _ in range(5000)]
    ids, offset = packing.Encoder(VOCABULARY).encode(texts)
    for i, found in enumerate(tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert ids[offset[i] : offset[i + 1]].tolist() == found.ids, texts[i]


def test_limits_hold_together():
    rng = np.random.default_rng(1)
    demands = np.column_stack((rng.integers(1, 400, 500), np.ones(500, int), rng.integers(0, 300, 500)))
    demands[:, 2] = np.minimum(demands[:, 2], demands[:, 0])
    limits = np.array([1024, 6, 500])
    bins = packing.fill(demands, limits)
    assert sorted(i for b in bins for i in b) == list(range(500))
    used = np.array([demands[b].sum(axis=0) for b in bins])
    assert (used <= limits).all()
    least = (demands.sum(axis=0) / limits).max()
    assert len(bins) < 1.06 * least + 1


def test_loss_tokens_limit_instruction_data(spark):
    rows = [(i, 0, 100 + i % 50, 60 + i % 30, i) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, start long, length long, loss long, ids_crc32 long")
    got = packing.pack(df, capacity=1000, segments=5, loss_tokens=250).collect()
    held = {}
    for r in got:
        held.setdefault(r.sequence_id, []).append((r.length, r.loss))
    assert len(got) == 200
    assert all(
        sum(a for a, _ in h) <= 1000 and sum(b for _, b in h) <= 250 and len(h) <= 5 for h in held.values()
    )


def test_numbers_of_keys():
    rng = np.random.default_rng(1)
    numbers, known = packing.Numbers(), {}
    for n in (0, 1, 700, 5, 4000):
        # Many keys ask for the same slots.
        keys = np.unique(rng.integers(0, 50, n).astype(np.uint64) | rng.integers(0, 1 << 20, n).astype(np.uint64) << np.uint64(40))
        assert numbers.find(keys).tolist() == [known.get(k, -1) for k in keys.tolist()]
        new = keys[numbers.find(keys) < 0]
        known |= {k: len(known) + i for i, k in enumerate(new.tolist())}
        numbers.add(new)
        assert len(numbers) == len(known)
    assert numbers.find(np.array(list(known), np.uint64)).tolist() == list(known.values())


def test_ids_do_not_depend_on_what_is_remembered(tokenizer, monkeypatch):
    rng = random.Random(4)
    texts = ["".join(rng.choice("ab cé 1'\n王") for _ in range(rng.randrange(60))) for _ in range(200)] + ["", "<|endoftext|> x"]
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    for cached in (3, 1_000_000):
        monkeypatch.setattr(packing, "CACHED", cached)
        encoder = packing.Encoder(VOCABULARY)
        for at in range(0, len(texts), 20):
            ids, offset = encoder.encode(texts[at : at + 20])
            assert [ids[a:b].tolist() for a, b in zip(offset[:-1], offset[1:], strict=True)] == want[at : at + 20]
