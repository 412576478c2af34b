"""Conversation repair against a plain search over all edits."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from newspipe.llm import turns
from newspipe.llm.queries import REGISTRY

BLACK = re.compile(r"[^\x20\x09-\x0D]")
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate = zlib.crc32(key.encode()) % 20
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out += [(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


def cheapest(rows):
    """Least cost, edits and repaired rows, trying every edit at every place."""
    after = {"": "su", "s": "u", "u": "a", "a": "u"}

    @lru_cache(maxsize=None)
    def best(i, last, inserts):
        found = [(0, "", ())] if i == len(rows) and last in ("", "a") else []
        if inserts < 2:
            for role in ("user", "assistant"):
                if role[0] in after[last]:
                    c, e, r = best(i, role[0], inserts + 1)
                    found.append((c + 3, "I" + e, (f"{role}:", *r)))
        if i < len(rows):
            role, text, fault = rows[i]
            c, e, r = best(i + 1, last, 0)
            found.append((c + 4, "D" + e, r))
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                for to in {role, "user", "assistant"}:
                    if to[:1] and to[0] in after[last]:
                        for cost, edit in ((0, "K"),) * (to == role) + ((3, "R"),) * (to in ("user", "assistant")):
                            c, e, r = best(i + 1, to[0], 0)
                            found.append((c + cost + more, edit + e, (f"{to}:{text}", *r)))
        return min(found, default=(10**9, "", ()), key=lambda f: f[:2])

    return best(0, "", 0)


def plain(rows):
    out = []
    for conv in {r[0] for r in rows}:
        kept = damaged([r for r in rows if r[0] == conv])
        seen, judged = set(), []
        for _, role, text in kept:
            black = BLACK.findall(text)
            fault = (
                "blank" if not black
                else "duplicate" if (role, text) in seen
                else "truncated" if black[-1] not in ".!?"
                else None
            )
            seen.add((role, text))
            judged.append((role, text, fault))
        cost, audit, said = cheapest(tuple(judged)) if judged else (0, "", ())
        known = [r[0] for r in kept if r[0] is not None]
        initials = [r[1][:1] for r in kept]
        out.append((
            conv,
            max(known) - min(known) + 1 - len(set(known)) if known else 0,
            *(sum(f == kind for *_, f in judged) for kind in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)),
            cost,
            audit,
            hashlib.sha256("\n".join(said).encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def result(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()), key=repr)


def test_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert result(REGISTRY["op12_auction_repair"](spark, sf_dir)) == plain([tuple(r) for r in rows])


@pytest.mark.parametrize("segment", [4096, 3, 1])
def test_random_and_long_conversations(spark, monkeypatch, segment):
    monkeypatch.setattr(turns, "SEGMENT", segment)
    rng = random.Random(4)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "another"]
    texts = ["Yes.", "no", "", None, " \n ", "Why?", "x" * 50 + "!", "漢字。", "end. \t", "Yes.", "🙂"]
    rows = [
        (rng.choice([*range(60), None]), rng.choice([None, *range(9)]), rng.choice(roles), rng.choice(texts))
        for _ in range(500)
    ]
    rows += [(1000, t, roles[1 + t % 2], f"{t % 50} said{'.' * (t % 3)}") for t in range(300)]
    rows += [(2**62 + i, None, None, None) for i in range(3)] + [(-5, -3, "user", "A."), (-5, 7, "assistant", "B.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.selectExpr("*", "1 as rank", "2 as segment", "3 as cost", "'x' as fate", "'k' as key")
    assert result(turns.repaired(df.repartition(4))) == plain(rows)


def test_every_row_dropped(spark):
    gone = next(t for t in range(1000) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    df = spark.createDataFrame([(7, gone, "user", "Hello.")], "conv_id long, turn long, role string, text string")
    assert result(turns.repaired(df)) == [(7, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]


def test_no_rows(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert result(turns.repaired(df)) == []


def test_prices_are_the_costs_to_the_end():
    rng = random.Random(2)
    for _ in range(200):
        codes = "".join(rng.choice("suax") + rng.choice("-bdt") for _ in range(rng.randrange(8)))
        price, traces = turns.solved(codes, (0, turns.NEVER, turns.NEVER, 0), True)
        fault = {"-": None, "b": "blank", "d": "duplicate", "t": "truncated"}
        rows = tuple(({"s": "system", "u": "user", "a": "assistant", "x": "tool"}[r], "", fault[f])
                     for r, f in zip(codes[::2], codes[1::2], strict=True))
        cost, audit, _ = cheapest(rows)
        assert (price[turns.NONE], traces[turns.NONE][0]) == (cost, audit)
