"""Near-duplicate documents by an LSH forest over MinHash signatures.

A document is the set of its five-word shingles. Documents with the same set are one node.
A node's signature is cut into the labels of several trees; each tree is the list of all
nodes sorted by label, a stored order dealt out in even chunks that overlap. Nodes with a
long common prefix stand together there, and how deep the prefix has to be depends on how
crowded the place is: a run of nodes that share the least prefix is compared in full if it
is small, and searched again one value deeper if not. Where even whole labels are shared
by many, the nodes are compared with their neighbours and with the heads of their run, the
nodes that share most labels with others over all trees.

Candidates are confirmed on full shingle sets, then linked nodes are joined to components.
Neighbours and heads join most of a crowd at little cost, but not all. Where a crowded run
still holds several components, what is outside its largest one is compared with all of the
run: nodes are dealt into blocks of bounded size, a block of outsiders meets every block of
the run in a task of its own, and those links are kept that join what was not joined yet.
Blocks of the largest component never meet each other, so rows grow with the run times the
blocks of its outsiders.

Null, empty and wordless texts have no shingles, are linked with nothing and are kept, as
component of their own. With fewer than five words the whole sequence is the one shingle.
Very long texts are read whole. Repeated rows share a component; with the same id they are
the same document. A null id names nothing: its component is the smallest other id there,
or null, and it is never kept if there is a smaller name for it. An empty table gives an
empty result. Columns other than ``doc_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .bitmaps import maybe_in
from .components import components
from .store import map_frames, ranked, row_keys, stored, utf8

SHINGLE = 5
PERCENT = 85
TREES = 16
DEPTH = 6
LEAST_PREFIX = 2
RUN = 16  # as many nodes are compared with each other
BESIDE = 3  # in larger runs, each with as many neighbours
CHUNK = 4096
BLOCK = 2048  # nodes of a crowded run that meet those of another block, ...
BLOCK_SHINGLES = 1 << 20  # ... fewer if they are long

_rng = np.random.default_rng(20240229)
_FACTOR = _rng.integers(1, 2**63, TREES * DEPTH, np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _rng.integers(0, 2**63, TREES * DEPTH, np.uint64)


def screen(percent: int) -> float:
    """Pairs whose signatures agree in a smaller share are not compared in full.

    At the least similarity that counts, this is more than six standard deviations off.
    """
    least = percent / 100
    return least - 6.3 * (least * (1 - least) / (TREES * DEPTH)) ** 0.5


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for _, b in words.batches(texts):
        hashes = b.hashes()
        keys, at = words.windows(hashes, b.doc, size)
        first = np.searchsorted(at, b.first)
        for i, n in enumerate(b.n_words):
            if n >= size:
                yield np.unique(keys[first[i] : first[i + 1]])
            elif n:
                whole = hashes[b.first[i] : b.first[i + 1]]
                yield words.windows(whole, np.zeros(n, int), n)[0]
            else:
                yield keys[:0]


def signature(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of the set under each hash function, cut to its low 16 bits."""
    least = np.full(len(_FACTOR), 2**48 - 1, np.uint64)
    for at in range(0, len(shingles), 4096):
        values = (shingles[at : at + 4096, None] * _FACTOR + _SHIFT) >> np.uint64(16)
        np.minimum(least, values.min(axis=0), out=least)
    return least.astype(">u2")


def sketched(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, digest, signature`` and the row keys of every document."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            n, digest, sign = [], [], []
            for shingles in shingle_sets(list(frame["text"])):
                n.append(len(shingles))
                some = len(shingles) > 0
                digest.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if some else None)
                sign.append(signature(shingles).tobytes() if some else None)
            yield frame.drop(columns="text").assign(n_shingles=n, digest=digest, signature=sign)

    source = docs.select("doc_id", *row_keys(), utf8("text").alias("text"))
    return map_frames(
        source, run, "__k1 bigint, __k2 int, n_shingles long, digest binary, signature binary"
    )


def chunk_candidates(label: np.ndarray, least: int = LEAST_PREFIX) -> list[tuple[int, int]]:
    """Pairs of rows to compare in a sorted run of labels, given as rows of values."""
    n, depth = label.shape
    if n < 2:
        return []
    same = np.cumprod(label[1:] == label[:-1], axis=1).sum(axis=1)  # prefix shared with the next
    out: list[tuple[int, int]] = []
    work = [(0, n, least)]
    while work:
        begin, stop, d = work.pop()
        cuts = np.flatnonzero(same[begin : stop - 1] < d) + begin + 1
        for i, j in zip(np.concatenate(([begin], cuts)), np.concatenate((cuts, [stop])), strict=True):
            if j - i < 2:
                continue
            if j - i <= RUN:
                out += [(x, y) for x in range(i, j) for y in range(x + 1, j)]
                continue
            out += [(x, y) for x in range(i, j) for y in range(x + 1, min(j, x + 1 + BESIDE))]
            if d < depth:
                work.append((i, j, d + 1))
    return out


def candidates(nodes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Distinct pairs ``a, b`` of nodes that some tree shows close to each other."""
    trees = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1)))
    rows = nodes.select("node", "n_shingles", "signature", trees.alias("tree")).select(
        "tree",
        F.substring("signature", F.col("tree") * DEPTH * 2 + 1, F.lit(DEPTH * 2)).alias("label"),
        "node",
        "n_shingles",
    )
    order = ranked(rows, "tree", "label", "node", name="forest")
    # Each chunk sees the end of the one before, so that no small run is cut.
    chunk = F.floor(F.col("rank") / CHUNK)
    again = F.when(F.col("rank") % CHUNK >= CHUNK - RUN, F.array(chunk, chunk + 1)).otherwise(
        F.array(chunk)
    )

    def search(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("rank")
        label = np.frombuffer(b"".join(frame["label"]), ">u2").reshape(len(frame), DEPTH).astype(np.int32)
        tree = frame["tree"].to_numpy()[:, None]
        pairs = np.array(chunk_candidates(np.hstack((tree, label)), LEAST_PREFIX + 1), np.int64)
        pairs = pairs.reshape(-1, 2)
        node, size = frame["node"].to_numpy(), frame["n_shingles"].to_numpy()
        a, b = node[pairs[:, 0]], node[pairs[:, 1]]
        x, y = size[pairs[:, 0]], size[pairs[:, 1]]
        fits = (a != b) & (100 * np.minimum(x, y) >= percent * np.maximum(x, y))
        both = pd.DataFrame({"a": np.minimum(a, b)[fits], "b": np.maximum(a, b)[fits]})
        return both.drop_duplicates()

    kind = nodes.schema["node"].dataType.simpleString()
    beside = (
        order.withColumn("chunk", F.explode(again))
        .groupBy("chunk")
        .applyInPandas(search, f"a {kind}, b {kind}")
    )
    # Runs that share whole labels: how crowded a node's places are over all trees tells
    # which ones the others in its runs derive from.
    places = order.select(F.xxhash64("tree", "label").alias("place"), "node")
    runs = places.groupBy("place").agg(F.count("*").alias("crowd")).filter(F.col("crowd") > RUN)
    crowded = places.join(runs, "place")
    central = crowded.groupBy("node").agg(F.sum("crowd").alias("central"))
    crowded = stored(crowded.join(central, "node"), "crowded")
    pick = F.struct("central", (-F.col("node")).alias("node"))
    heads = crowded.groupBy("place").agg(F.max(pick).alias("head"))
    second = (
        crowded.join(heads, "place")
        .filter(F.col("node") != -F.col("head.node"))
        .groupBy("place")
        .agg(F.max(pick).alias("head"))
    )
    heads = heads.unionByName(second).select("place", (-F.col("head.node")).alias("head"))
    to_heads = crowded.join(heads, "place").select(
        F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b")
    )
    return beside.unionByName(to_heads).filter(F.col("a") < F.col("b")).distinct()


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Elements that two sorted sets share."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0


def screened(pairs: DataFrame, nodes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs whose signatures agree enough."""
    least = screen(percent)

    def alike(x: pd.Series, y: pd.Series) -> pd.Series:
        left = np.frombuffer(b"".join(x), np.uint16).reshape(len(x), -1)
        right = np.frombuffer(b"".join(y), np.uint16).reshape(len(y), -1)
        return pd.Series((left == right).mean(axis=1) >= least)

    left = nodes.select(F.col("node").alias("a"), F.col("signature").alias("x"))
    right = nodes.select(F.col("node").alias("b"), F.col("signature").alias("y"))
    close = F.pandas_udf(alike, "boolean")("x", "y")
    return pairs.join(left, "a").join(right, "b").filter(close).select("a", "b").distinct()


def sets_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``doc_id, shingles``: the shingle sets, as bytes, of the documents asked for."""
    key = F.xxhash64("doc_id")
    asked = (
        docs.select("doc_id", utf8("text").alias("text"))
        .filter(maybe_in(ids.select(key.alias("key")), "key", key))
        .join(ids, "doc_id")
    )

    def to_sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sets = [s.tobytes() for s in shingle_sets(list(frame["text"]))]
            yield frame[["doc_id"]].assign(shingles=sets)

    return stored(map_frames(asked, to_sets, "shingles binary"), "shingle_sets")


def confirmed(docs: DataFrame, pairs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs that are links, told from the full shingle sets."""
    ids = stored(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "asked")
    sets = sets_of(docs, ids)

    def linked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for p, q in zip(frame["x"], frame["y"], strict=True):
                p, q = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
                shared = overlap(p, q)
                out.append(100 * shared >= percent * (len(p) + len(q) - shared) and shared > 0)
            yield frame[["a", "b"]].assign(linked=out)

    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y"))
    both = pairs.join(left, "a").join(right, "b")
    return map_frames(both, linked, "linked boolean", ("a", "b")).filter("linked").drop("linked")


def block_links(
    left: pd.DataFrame, right: pd.DataFrame | None, tree: int, percent: int = PERCENT
) -> list[tuple[int, int]]:
    """Rows of a left and a right block (the left one again if None) whose links join what the
    roots tell apart. Pairs that already share the least prefix in an earlier tree are left
    to that one."""
    both = left if right is None else pd.concat([left, right])
    sign = np.frombuffer(b"".join(both["signature"]), np.uint16).reshape(len(both), TREES, DEPTH)
    sets = [np.frombuffer(x, np.uint64) for x in both["shingles"]]
    size = both["n_shingles"].to_numpy()
    # Nodes of a root share a number, which changes as roots are joined.
    group = np.unique(both["root"].to_numpy(), return_inverse=True)[1]
    flat, prefix = sign.reshape(len(both), -1), sign[:, :tree, :LEAST_PREFIX]
    least, out = screen(percent), []
    for x in range(len(left)):
        begin = x + 1 if right is None else len(left)
        fits = (group[begin:] != group[x]) & (
            100 * np.minimum(size[begin:], size[x]) >= percent * np.maximum(size[begin:], size[x])
        )
        ys = np.flatnonzero(fits) + begin
        ys = ys[(flat[ys] == flat[x]).mean(axis=1) >= least]
        ys = ys[~(prefix[ys] == prefix[x]).all(axis=2).any(axis=1)]
        for y in ys:
            if group[x] == group[y]:
                continue
            shared = overlap(sets[x], sets[y])
            if 100 * shared >= percent * (size[x] + size[y] - shared) and shared > 0:
                out.append((x, int(y)))
                group[group == group[y]] = group[x]
    return out


def crowd_links(
    docs: DataFrame, nodes: DataFrame, roots: DataFrame, percent: int = PERCENT
) -> DataFrame | None:
    """Links ``a, b`` between components that crowded runs hold; None without such runs."""
    trees = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1)))
    prefix = F.substring("signature", F.col("tree") * DEPTH * 2 + 1, F.lit(LEAST_PREFIX * 2))
    places = (
        nodes.join(roots, "node", "left")
        .select("node", "n_shingles", F.coalesce("root", "node").alias("root"), "signature", trees.alias("tree"))
        .select("node", "n_shingles", "root", "tree", F.xxhash64("tree", prefix).alias("place"))
    )
    open_runs = stored(
        places.groupBy("place", "root")
        .agg(F.count("*").alias("n"))
        .groupBy("place")
        .agg(F.sum("n").alias("crowd"), F.count("*").alias("held"), F.max(F.struct("n", "root")).alias("most"))
        .filter((F.col("crowd") > RUN) & (F.col("held") > 1))
        .select("place", F.col("most.root").alias("largest")),
        "open_runs",
    )
    if open_runs.isEmpty():
        return None
    # Nodes of like size together, and as many in a block as their sizes allow.
    bits = F.floor(F.log2("n_shingles")).cast("int")
    members = (
        places.join(open_runs, "place")
        .withColumn("outside", F.col("root") != F.col("largest"))
        .withColumn("bits", bits)
        .drop("largest")
    )
    order = stored(
        ranked(members, "place", "outside", "bits", "n_shingles", "node", name="crowds"), "members"
    )
    alike = ["place", "outside", "bits"]
    begin = order.groupBy(*alike).agg(F.min("rank").alias("begin"))
    room = F.greatest(F.lit(RUN), F.least(F.lit(BLOCK), F.expr(f"{BLOCK_SHINGLES} div shiftleft(1L, bits)")))
    number = F.floor((F.col("rank") - F.col("begin")) / room).alias("number")
    order = order.join(begin, alike).withColumn("block", F.struct("outside", "bits", number))
    blocks = stored(
        order.groupBy("place", "tree", "block").agg(
            F.min("n_shingles").alias("small"), F.max("n_shingles").alias("large"),
            F.min("root").alias("low"), F.max("root").alias("high"),
        ),
        "blocks",
    )
    # Every block of outsiders meets all others once; outsiders come last in the order.
    other = blocks.filter("block.outside").select(
        "place", *(F.col(c).alias(f"{c}2") for c in ("block", "small", "large", "low", "high"))
    )
    meets = (
        blocks.join(other, "place")
        .filter(F.col("block") <= F.col("block2"))
        .filter(100 * F.col("large") >= percent * F.col("small2"))
        .filter(100 * F.col("large2") >= percent * F.col("small"))
        .filter(F.least("low", "low2") != F.greatest("high", "high2"))
        .withColumn("meet", F.xxhash64("place", "block", "block2"))
    )
    sides = stored(
        meets.select("place", "block", "block2", "tree", "meet")
        .withColumn("alone", F.col("block") == F.col("block2"))
        .select("place", "tree", "meet", "alone", F.posexplode(F.array("block2", "block")).alias("side", "block"))
        .filter(~F.col("alone") | (F.col("side") == 0)),
        "meets",
    )
    going = order.select("place", "block", "node", "n_shingles", "root").join(sides, ["place", "block"])
    going = stored(going.select("meet", "tree", "side", "node", "n_shingles", "root"), "going")
    asked = stored(going.select(F.col("node").alias("doc_id")).distinct(), "asked")
    sets = sets_of(docs, asked).dropDuplicates(["doc_id"]).withColumnRenamed("doc_id", "node")
    rows = going.join(sets.join(nodes.select("node", "signature"), "node"), "node")

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        left, right = frame[frame["side"] == 0], frame[frame["side"] == 1]
        node = np.concatenate([left["node"].to_numpy(), right["node"].to_numpy()])
        pairs = block_links(left, right if len(right) else None, int(frame["tree"].iloc[0]), percent)
        pairs = np.array(pairs, np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": node[pairs[:, 0]], "b": node[pairs[:, 1]]})

    kind = nodes.schema["node"].dataType.simpleString()
    return stored(rows.groupBy("meet").applyInPandas(compare, f"a {kind}, b {kind}"), "crowd_links")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` and the row keys of every document.

    ``percent`` is the least similarity that links. At 80 a lone pair is missed with a
    probability below 1e-7, at 85 below 1e-8; the trees are not made for much less.
    """
    sketches = stored(sketched(docs), "sketches")
    nodes = (
        sketches.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
        .groupBy("digest")
        .agg(
            F.min("doc_id").alias("node"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("signature").alias("signature"),
        )
    )
    nodes = stored(nodes, "nodes")
    pairs = stored(screened(candidates(nodes, percent), nodes, percent), "candidates")
    links = stored(confirmed(docs, pairs, percent), "links")
    roots = stored(components(links), "roots")
    more = crowd_links(docs, nodes, roots, percent)
    if more is not None:
        roots = components(links.unionByName(more))
    named = nodes.join(roots, "node", "left").select(
        "digest", F.coalesce("root", "node").alias("component_id")
    )
    alone = F.when(F.col("n_shingles") == 0, F.col("doc_id"))
    return (
        sketches.drop("signature")
        .join(named, "digest", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.coalesce("component_id", alone).alias("component_id"),
            "__k1",
            "__k2",
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
    )


def drop_near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One document of each component, all columns as they are.

    A document without id stays if its component has no name, and of rows that are equal in
    id and text one stays.
    """
    found = near_duplicates(docs, percent)
    unnamed = F.col("doc_id").isNull() & F.col("component_id").isNull()
    staying = found.filter(F.col("kept") | unnamed).select("__k1", "__k2").distinct()
    return (
        docs.select("*", *row_keys())
        .join(staying, ["__k1", "__k2"], "left_semi")
        .dropDuplicates(["__k1", "__k2"])
        .select(*docs.columns)
    )
