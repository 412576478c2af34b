"""Conversations damaged on purpose, and repaired by cheapest edits.

A conversation's rows are the columns of a lattice: a node is a place between rows and the
last role so far (none, system, user, assistant), an arc keeps, gives another role to, or
deletes the next row, or inserts an empty turn. The cheapest edits are a shortest path.

It is found by the auction algorithm. Every node has a price, never more than an arc and the
price behind it. A path grows from its origin: while its last node's price is below the best
offer of its arcs, the price is raised to it and the path contracts by that node; otherwise it
is extended along the best arc. Origins are taken from the end of the conversation to its
start, and a path stops at a node whose price has converged, so an origin costs a few steps.
The prices are then the exact costs to the end, arcs that lose nothing are tight, and from
each node the tight arc with the least initial is followed. A role and an initial lead to one
node only, so that gives the least string of edits.

Long conversations are cut into segments of bounded size. One pass takes segments from the
last to the first, handing prices on; for each possible role before a segment it keeps the
edits within. Another takes rows in their order, follows those edits and feeds the digest.
Both are streams over sorted rows: what a task holds is a segment, not a conversation. The
digest is over a whole conversation in its order, so its rows pass through one task, as a
stream.

Rows are ordered by turn, nulls first; rows of the same turn by role, text and copy. A null
role or text is one blank; a null ``conv_id`` is a conversation of its own, and its number in
the damage key is one blank, like that of a null turn. A role without any character, or with
another initial than s, u or a, cannot be kept. Repeated rows are duplicates. An empty table
gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .bitmaps import maybe_in
from .store import ranked, release_memory, ship_package, stored

SEGMENT = 4096  # rows
KEEP, REROLE, DELETE, INSERT, CUT = 0, 3, 4, 3, 3
NONE, SYSTEM, USER, ASSISTANT = range(4)
NEVER = 1 << 60
# A row's code: its initial if it may be kept, and what its fault is.
SOUND, BLANK, DUPLICATE, TRUNCATED = "-", "b", "d", "t"
NEXT = {
    NONE: {"s": SYSTEM, "u": USER},
    SYSTEM: {"u": USER},
    USER: {"a": ASSISTANT},
    ASSISTANT: {"u": USER},
}
ROLE = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}


def arcs(codes: str, at: int, role: int, last: bool) -> Iterator[tuple[str, int, int, int]]:
    """Initial, cost and target of every edit at a node, by initial.

    The place behind a segment belongs to the next one, except at the end.
    """
    wanted = USER if role != USER else ASSISTANT
    if at < len(codes) // 2:
        initial, fault = codes[2 * at], codes[2 * at + 1]
        yield "D", DELETE, at + 1, role
        yield "I", INSERT, at, wanted
        if fault not in (BLANK, DUPLICATE):
            more = CUT if fault == TRUNCATED else 0
            if initial in NEXT[role]:
                yield "K", KEEP + more, at + 1, NEXT[role][initial]
            yield "R", REROLE + more, at + 1, wanted
    elif last:
        yield "I", INSERT, at, wanted


def auction(codes: str, end: tuple[int, ...], last: bool) -> list[list[int]]:
    """Converged prices of all nodes, given those behind the segment."""
    n = len(codes) // 2
    price = [[0] * 4 for _ in range(n + 1)]
    done = [[False] * 4 for _ in range(n + 1)]
    for at in range(n, -1, -1):
        for origin in range(4):
            path = [(at, origin)]
            while path:
                i, role = path[-1]
                if done[i][role]:
                    # What is converged behind the path makes the path converge.
                    for j, r in path:
                        done[j][r] = True
                    break
                best, target = (end[role], None) if i == n else (NEVER, None)
                for _, cost, j, r in arcs(codes, i, role, last):
                    offer = cost + price[j][r]
                    if offer < best:
                        best, target = offer, (j, r)
                if price[i][role] < best:
                    price[i][role] = best
                    if len(path) > 1:
                        path.pop()
                elif target is None:
                    done[i][role] = True  # the end itself
                else:
                    path.append(target)
    return price


@lru_cache(maxsize=20_000)
def solved(codes: str, end: tuple[int, ...], last: bool) -> tuple[tuple[int, ...], tuple[tuple[str, int], ...]]:
    """Prices at the segment's start, and for every role there the edits and the role behind."""
    price = auction(codes, end, last)
    n = len(codes) // 2
    traces = []
    for role in range(4):
        i, edits = 0, []
        while True:
            if i == n and price[i][role] == end[role]:
                break
            for initial, cost, j, r in arcs(codes, i, role, last):
                if cost + price[j][r] == price[i][role]:
                    edits.append(initial)
                    i, role = j, r
                    break
        traces.append(("".join(edits), role))
    return tuple(price[0]), tuple(traces)


def shown(column: str | Column) -> Column:
    """A value as text, null as one blank."""
    return F.coalesce((F.col(column) if isinstance(column, str) else column).cast("string"), F.lit(" "))


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copy`` after the damage that each row's key tells."""
    key = F.concat(shown("conv_id"), F.lit(":"), shown("turn"))
    fate = F.crc32(key.cast("binary")) % 20
    text = (
        F.when(F.col("fate") == 1, F.lit(""))
        .when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
    )
    copies = F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (
        rows.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), fate.alias("fate"))
        .filter(F.col("fate") != 0)
        .select(
            "conv_id",
            "turn",
            F.when(F.col("fate") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
            text.alias("text"),
            F.explode(copies).alias("copy"),
        )
    )


def faults(order: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``conv_id, rank, initial, fault`` of every row, and the rows that are duplicates."""
    black = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    key = F.xxhash64(F.lit(1), "conv_id", "role", "text")
    narrow = stored(
        order.select(
            "conv_id",
            "rank",
            F.substring("role", 1, 1).alias("initial"),
            F.when(black == "", BLANK).when(~black.isin(".", "!", "?"), TRUNCATED).otherwise(SOUND).alias("fault"),
            key.alias("key"),
            F.md5(F.to_json(F.struct("role", "text"))).alias("digest"),
        ),
        "faults",
    )
    said = ["key", "digest", "conv_id"]
    some = narrow.filter(F.col("fault") != BLANK)
    twice = stored(
        some.groupBy(*said).agg(F.min("rank").alias("first"), F.count("*").alias("n")).filter("n > 1"),
        "said_twice",
    )
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"t.{c}")) for c in said]
    again = (
        some.filter(maybe_in(twice, "key", F.col("key")))
        .alias("s")
        .join(twice.alias("t"), same)
        .filter(F.col("s.rank") > F.col("t.first"))
        .select("s.conv_id", "s.rank", F.lit(DUPLICATE).alias("fault"))
    )
    return narrow, again


def segments(narrow: DataFrame, again: DataFrame) -> DataFrame:
    """``conv_id, segment, codes``: the codes of a bounded run of rows of a conversation."""
    both = narrow.select("conv_id", "rank", "initial", "fault").unionByName(
        again.select("conv_id", "rank", F.lit(None).cast("string").alias("initial"), "fault")
    )
    rows = both.groupBy("conv_id", "rank").agg(
        F.max("initial").alias("initial"),
        F.max_by("fault", F.col("initial").isNull()).alias("fault"),
    )
    code = F.concat(F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("x"), "fault")
    return (
        rows.select("conv_id", "rank", F.floor(F.col("rank") / SEGMENT).alias("segment"), code.alias("code"))
        .groupBy("conv_id", "segment")
        .agg(F.array_sort(F.collect_list(F.struct("rank", "code"))).alias("rows"))  # SEGMENT at most
        .select("conv_id", "segment", F.array_join("rows.code", "").alias("codes"))
    )


def streamed(df: DataFrame, order: list, run, shape: str) -> DataFrame:
    """Rows of each conversation together and in order, through ``run`` as one stream a task."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small = (batch.slice(at, 1024) for batch in found for at in range(0, batch.num_rows, 1024))
        rows = (row for part in small for row in zip(*(c.to_pylist() for c in part.columns), strict=True))
        yield from run(rows)
        release_memory()

    return df.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(batches, shape)


def _batches(rows: Iterator[tuple], schema: pa.Schema, at_once: int = 1024) -> Iterator[pa.RecordBatch]:
    while held := list(islice(rows, at_once)):
        columns = [pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)


def traced(parts: DataFrame) -> DataFrame:
    """``conv_id, segment, cost, traces`` for the segments, worked out from the last to the first."""
    kind = parts.schema["conv_id"].dataType.simpleString()
    arrow = to_arrow_type(parts.schema["conv_id"].dataType)
    schema = pa.schema([("conv_id", arrow), ("segment", pa.int64()), ("codes", pa.string()),
                        ("cost", pa.int64()), ("traces", pa.list_(pa.string())), ("exits", pa.list_(pa.int32()))])

    def back(rows: Iterator[tuple]) -> Iterator[tuple]:
        now, started, end, total = None, False, (0, NEVER, NEVER, 0), 0
        for conv, segment, codes in rows:
            last = not started or conv != now
            if last:
                now, started, end, total = conv, True, (0, NEVER, NEVER, 0), 0
            price, traces = solved(codes, end, last)
            # Prices are handed on relative to the least, so that like segments look alike.
            cost = total + price[NONE]
            total, end = total + min(price), tuple(p - min(price) for p in price)
            yield conv, segment, codes, cost, [t for t, _ in traces], [r for _, r in traces]

    return streamed(
        parts.select("conv_id", "segment", "codes"),
        ["conv_id", F.desc("segment")],
        lambda rows: _batches(back(rows), schema),
        f"conv_id {kind}, segment bigint, codes string, cost bigint, traces array<string>, exits array<int>",
    )


class Conversation:
    """What a stream of a conversation's segments and rows has come to."""

    def __init__(self) -> None:
        self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = 0
        self.low = self.high = self.before = None
        self.cost, self.role, self.audit = None, NONE, []
        self.edits: Iterator[str] = iter("")
        self.at = NONE
        self.digest, self.empty = hashlib.sha256(), True

    def segment(self, codes: str, cost: int, traces: list[str], exits: list[int]) -> None:
        self.inserted()
        if self.cost is None:
            self.cost = cost
        for name, letter in (("blank", BLANK), ("duplicate", DUPLICATE), ("truncated", TRUNCATED)):
            setattr(self, name, getattr(self, name) + codes[1::2].count(letter))
        edits = traces[self.role]
        self.audit.append(edits)
        self.edits = iter(edits)
        self.at, self.role = self.role, exits[self.role]

    def write(self, role: str, text: str) -> None:
        self.digest.update((("" if self.empty else "\n") + role + ":" + text).encode())
        self.empty = False

    def inserted(self) -> str | None:
        """Write turns inserted here; the edit that concerns a row, if one follows."""
        for edit in self.edits:
            if edit != "I":
                return edit
            self.at = USER if self.at != USER else ASSISTANT
            self.write(ROLE[self.at], "")
        return None

    def row(self, turn: int | None, role: str, text: str) -> None:
        if turn is not None:
            if turn != self.high:
                self.distinct += 1
            self.low = turn if self.low is None else self.low
            self.high = turn
        if self.before is not None and self.before + role[:1] not in LEGAL:
            self.illegal += 1
        self.before = role[:1]
        edit = self.inserted()
        if edit == "K":
            self.at = NEXT[self.at][role[0]]
            self.write(role, text)
        elif edit == "R":
            self.at = USER if self.at != USER else ASSISTANT
            self.write(ROLE[self.at], text)

    def result(self) -> tuple:
        self.inserted()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return (gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost or 0,
                "".join(self.audit), self.digest.hexdigest())


def repaired(conversations: DataFrame) -> DataFrame:
    """Faults, cheapest edits and the digest of the repaired turns of every conversation."""
    ship_package(conversations.sparkSession)
    kind = conversations.schema["conv_id"].dataType.simpleString()
    arrow = to_arrow_type(conversations.schema["conv_id"].dataType)
    order = ranked(damaged(conversations), "conv_id", "turn", "role", "text", "copy", name="turns")
    narrow, again = faults(order)
    traces = stored(traced(stored(segments(narrow, again), "segments")), "traces")
    names = conversations.select("conv_id").distinct()
    segment = F.floor(F.col("rank") / SEGMENT)
    # Of a conversation its name comes first, then each segment before its rows.
    told = ["conv_id", "segment", "rank", "codes", "cost", "traces", "exits", "turn", "role", "text"]
    rows = (
        names.withColumn("segment", F.lit(-1).cast("long"))
        .unionByName(traces.withColumn("rank", F.lit(-1).cast("long")), allowMissingColumns=True)
        .unionByName(
            order.select("conv_id", segment.alias("segment"), "rank", F.col("turn").cast("long"), "role", "text"),
            allowMissingColumns=True,
        )
        .select(*told)
    )
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    schema = pa.schema([("conv_id", arrow), *((c, pa.int64()) for c in numbers),
                        ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def forward(found: Iterator[tuple]) -> Iterator[tuple]:
        now = name = None
        for conv, part, rank, codes, cost, edits, exits, turn, role, text in found:
            if part == -1:
                if now:
                    yield (name, *now.result())
                now, name = Conversation(), conv
            elif rank == -1:
                now.segment(codes, cost, edits, exits)
            else:
                now.row(turn, role, text)
        if now:
            yield (name, *now.result())

    return streamed(
        rows,
        ["conv_id", "segment", "rank"],
        lambda found: _batches(forward(found), schema),
        f"conv_id {kind}, {', '.join(f'{c} bigint' for c in numbers)}, audit string, repaired_sha256 string",
    )
