"""Shards by virtual slots against a plain count."""

import zlib

import cases

from newspipe.llm import slots
from newspipe.llm.queries import REGISTRY
from newspipe.session import scratch_dir


def check(rows, texts, shards):
    """Rows as the contract wants them, for ``texts`` as ``(doc_id, text)``."""
    want = sorted(
        (-1 if i is None else i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()))
        for i, t in texts
    )
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.size, r.text_crc32) for r in rows) == want
    load, places = [0] * shards, [[] for _ in range(shards)]
    for r in rows:
        load[r.shard] += r.size
        places[r.shard].append(r.slot)
        assert r.law == "bytes" and r.grown_shard is None
    assert all(sorted(p) == list(range(len(p))) for p in places)
    return load


def test_query(spark, sf_dir):
    texts = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    load = check(REGISTRY["op2_virtual_slots"](spark, sf_dir).collect(), texts, 40)
    assert max(load) - min(load) < 0.02 * sum(load) / 40


def test_awkward_rows(spark):
    rows = slots.shard_documents(cases.documents(spark), 3).collect()
    check(rows, cases.ROWS, 3)


def test_many_equal_rows_are_spread(spark):
    """A third of all rows without id and text; shards stay equal in bytes, slots gapless."""
    rows = [(None, None)] * 3000 + [(7, "same text")] * 1500 + [(i, "w" * (i % 50)) for i in range(-2000, 2500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = slots.shard_documents(df, 5).collect()
    load, places = [0] * 5, {}
    for r in got:
        load[r.shard] += r.size
        places.setdefault(r.shard, []).append(r.slot)
    assert len(got) == len(rows) and max(load) - min(load) < 0.02 * sum(load)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert max(sum(1 for r in got if r.vslot == v) for v in {r.vslot for r in got}) < 100


def test_no_rows(spark):
    assert slots.shard_documents(cases.documents(spark, []), 3).count() == 0


def test_rebalancing_edits_the_map(spark):
    loads = spark.createDataFrame(
        [(i, 1000 if i < 4 else 10 + i, 1) for i in range(64)], "vslot int, bytes long, n_rows long"
    )
    folder = scratch_dir(spark, "map")
    slots.store_map(slots.first_map(spark, 4, 64), folder, 1)
    slots.store_map(slots.rebalance(slots.read_map(spark, folder), loads, 4), folder, 2)
    one, two = ({r.vslot: r.shard for r in slots.read_map(spark, folder, v).collect()} for v in (1, 2))
    assert {r.vslot: r.shard for r in slots.read_map(spark, folder).collect()} == two
    assert sorted(one) == sorted(two) == list(range(64))
    held = {r.vslot: r.bytes for r in loads.collect()}
    load = [sum(held[v] for v, s in two.items() if s == k) for k in range(4)]
    assert max(load) - min(load) <= 30
    assert sum(one[v] != two[v] for v in one) < 20
    # One shard more takes slots from the others, and none go elsewhere but to even out.
    three = {r.vslot: r.shard for r in slots.rebalance(slots.read_map(spark, folder), loads, 5).collect()}
    assert set(three.values()) == set(range(5))
    grown = [sum(held[v] for v, s in three.items() if s == k) for k in range(5)]
    assert max(grown) - min(grown) <= max(held.values())
    # A shard that goes leaves its slots to the others.
    fewer = {r.vslot: r.shard for r in slots.rebalance(slots.read_map(spark, folder), loads, 3).collect()}
    assert set(fewer.values()) == {0, 1, 2} and len(fewer) == 64


def test_no_python_on_the_way(spark, sf_dir):
    plan = REGISTRY["op2_virtual_slots"](spark, sf_dir)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))
