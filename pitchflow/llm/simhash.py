"""Near duplicates by SimHash fingerprints and BK-trees (operator 8).

Each text becomes a 64-bit fingerprint. Equal fingerprints form one class; only
classes go on. Two fingerprints within ``radius`` bits agree on at least two of
``radius + 2`` bit blocks, so every class is sent to one shard per pair of
blocks, keyed by those blocks' bits. A shard holds a BK-tree for each key:
children hang below their parent by the integer Hamming distance to it, and a
query follows only the edges within the radius of its own distance.

The trees meet their queries in the shard and are not broadcast: all trees
together hold every fingerprint, which has no size bound.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchflow.functions.names import col
from pitchflow.llm.common import connected_components, in_tasks, stored

SEED = 42
#: Class rows that one shard gets on average; its BK-trees stay far below an executor's memory.
SHARD_ROWS = 50_000


def words(text: bytes) -> list[bytes]:
    """Words between ASCII white space (0x20, 0x09-0x0D), A-Z in lower case."""
    return text.lower().split()


def fingerprint(text: bytes, shingle: int) -> int:
    """64-bit SimHash of word shingles, repeats included; 0 if there is no word."""
    found = words(text)
    if not found:
        return 0
    line = b" ".join(found)
    if len(found) <= shingle:
        hashes = [xxhash.xxh64_intdigest(line, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))[: len(found) - shingle + 1]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[a:b], SEED) for a, b in zip(starts.tolist(), ends[shingle - 1 :].tolist(), strict=True)]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):  # a very long text in pieces
        part = np.array(hashes[at : at + (1 << 14)], dtype=">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes)).view(">u8")[0])


def _key() -> list[Column]:
    """doc_id and SHA-256 of the text; rows that agree in both are copies of one another."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return [F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.sha2(raw, 256)).alias("digest")]


def fingerprints(docs: DataFrame, shingle: int, with_digest: bool = False) -> DataFrame:
    """(doc_id[, digest], fp long) of every row; a NULL text counts as an empty one."""

    def run(batches):
        for b in batches:
            fps = [fingerprint(t, shingle) for t in b.column("text").to_pylist()]
            own = b.schema.names[:-1]
            yield pa.RecordBatch.from_arrays([*map(b.column, own), pa.array(np.array(fps, np.uint64).view(np.int64))], names=[*own, "fp"])

    rows = docs.select(*_key()[: 1 + with_digest], F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, digest binary, fp long" if with_digest else "doc_id long, fp long")


def block_masks(radius: int) -> list[np.uint64]:
    """One mask per pair of the ``radius + 2`` bit blocks."""
    edges = [round(64 * i / (radius + 2)) for i in range(radius + 3)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    return [np.uint64(x | y) for x, y in combinations(blocks, 2)]


class BKForest:
    """BK-trees, one per key, as arrays; built and searched level by level."""

    def __init__(self, keys: np.ndarray, fps: np.ndarray):
        order = np.lexsort((fps, keys))
        self.fps, keys = fps[order], keys[order]
        n = len(self.fps)
        first = np.concatenate(([True], keys[1:] != keys[:-1])) if n else np.zeros(0, bool)
        self.root = np.flatnonzero(first)[np.cumsum(first) - 1] if n else np.zeros(0, np.int64)  # of each row's tree
        edge = []  # parent * 65 + distance, and the child
        rows, node = np.flatnonzero(~first), self.root[~first]
        while len(rows):
            slot = node * 65 + np.bitwise_count(self.fps[rows] ^ self.fps[node])
            slots, at, back = np.unique(slot, return_index=True, return_inverse=True)
            child = rows[at]  # the first row of a slot becomes the child, the others go below it
            edge.append((slots, child))
            rest = rows != child[back]
            rows, node = rows[rest], child[back][rest]
        self.slots = np.concatenate([s for s, _ in edge]) if edge else np.zeros(0, np.int64)
        self.children = np.concatenate([c for _, c in edge]) if edge else np.zeros(0, np.int64)
        order = np.argsort(self.slots)
        self.slots, self.children = self.slots[order], self.children[order]

    def pairs(self, radius: int):
        """Index pairs (i, j), i < j by row, within ``radius`` bits, tree by tree, in pieces."""
        # So many queries at once that their open nodes stay few even if nothing can be pruned.
        largest = int(np.bincount(self.root).max(initial=1))
        step = max(64, (1 << 22) // largest)
        for at in range(0, len(self.fps), step):
            query = np.arange(at, min(at + step, len(self.fps)))
            node = self.root[query]
            while len(query):
                d = np.bitwise_count(self.fps[query] ^ self.fps[node]).astype(np.int64)
                hit = (d <= radius) & (query < node)
                if hit.any():
                    yield query[hit], node[hit]
                low = np.searchsorted(self.slots, node * 65 + np.maximum(d - radius, 0))
                many = np.searchsorted(self.slots, node * 65 + np.minimum(d + radius, 64), side="right") - low
                query = np.repeat(query, many)
                node = self.children[np.repeat(low - np.cumsum(many) + many, many) + np.arange(len(query))]


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges with the same components as (a, b): each node but the least of a component, to the least."""
    nodes, ends = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    least = np.arange(len(nodes))
    while True:
        before = least.copy()
        np.minimum.at(least, x, before[y])
        np.minimum.at(least, y, before[x])
        least = least[least]
        if np.array_equal(least, before):
            break
    rest = least != np.arange(len(nodes))
    return nodes[rest], nodes[least[rest]]


def links(classes: DataFrame, radius: int) -> DataFrame:
    """(a, b): edges between distinct fingerprints with the components of all pairs
    within ``radius`` bits.

    A pair that meets in several shards is taken in the first one only; each shard
    returns its pairs' components as stars.
    """
    masks = block_masks(radius)
    shards = max(1, -(-classes.count() * len(masks) // SHARD_ROWS))
    keyed = classes.select("fp", F.explode(F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(int(m.view(np.int64)))).alias("k")) for i, m in enumerate(masks)])).alias("x"))
    keyed = keyed.select("fp", "x.t", F.pmod(F.xxhash64("x.t", "x.k"), F.lit(shards)).alias("shard"))

    def run(group: pa.Table) -> pa.Table:
        t = group.column("t").to_numpy()
        fps = group.column("fp").to_numpy().view(np.uint64)
        out = []
        for i in np.unique(t):
            own = fps[t == i]
            _, keys = np.unique(own & masks[i], return_inverse=True)
            tree = BKForest(keys, own)
            for x, y in tree.pairs(radius):
                x, y = tree.fps[x], tree.fps[y]
                new = np.ones(len(x), bool)
                for m in masks[:i]:
                    new &= ((x ^ y) & m) != 0
                out.append((x[new], y[new]))
        a, b = stars(*(np.concatenate([np.zeros(0, np.uint64), *[p[k] for p in out]]).view(np.int64) for k in (0, 1)))
        return pa.table({"a": a, "b": b})

    return keyed.groupBy("shard").applyInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs``.

    component_id is the smallest doc_id reachable over fingerprints that differ
    in ``radius`` bits or fewer, the row's own included. A NULL or empty text has
    fingerprint zero and links like any other; rows with the same doc_id each
    give a row; a NULL doc_id is never a component's id unless all of its
    members have none. Columns besides doc_id and text are not read.
    """
    fps = stored(fingerprints(docs, shingle), "simhash-fingerprints")
    classes = stored(in_tasks(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), fps.count()), "simhash-classes")
    joined = _components(classes, radius)
    first = joined.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = stored(joined.join(first, "component").select("fp", "component_id"), "simhash-named")
    return fps.join(named, "fp").select("doc_id", "fp", "component_id")


def _components(classes: DataFrame, radius: int) -> DataFrame:
    """``classes`` with ``component``, the smallest fingerprint reachable."""
    groups = connected_components(links(classes, radius), "simhash-components")
    return classes.join(groups, classes.fp == groups.node, "left").withColumn("component", F.coalesce("component", "fp")).drop("node")


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """``docs`` with one row per component: that of the smallest doc_id.

    Rows are told apart by doc_id and text. Of rows that share the smallest doc_id
    of a component the one with the smallest SHA-256 of its text stays, and of
    its copies the one with the smallest JSON. A doc_id that goes in one component
    stays where it is another's smallest. Rows without a doc_id don't count as
    copies of rows with one; among themselves, one per component stays.
    """
    fps = stored(fingerprints(docs, shingle, with_digest=True), "simhash-fingerprints")
    keys = stored(fps.groupBy("doc_id", "digest", "fp").agg(F.count("*").alias("n")), "simhash-keys")
    classes = stored(in_tasks(keys.select("fp").distinct(), keys.count()), "simhash-classes")
    named = stored(_components(classes, radius), "simhash-named")
    least = keys.join(named, "fp").groupBy("component", F.col("doc_id").isNull().alias("no_id")).agg(F.min(F.struct("doc_id", "digest")).alias("x"))
    first = least.select("x.doc_id", "x.digest", F.lit(True).alias("kept"))
    marked = keys.alias("r").join(first.alias("k"), _same("r", "k"), "left").select("r.doc_id", "r.digest", "n", F.col("kept").isNotNull().alias("kept"))
    marked = stored(marked, "simhash-marked")
    # Rows go by doc_id, which is short; of a doc_id with rows that go and rows that stay, the latter come back by text.
    gone = stored(marked.where("not kept or n > 1").select("doc_id").distinct(), "simhash-gone")
    back = marked.where("kept").alias("r").join(gone.alias("k"), F.col("r.doc_id").eqNullSafe(F.col("k.doc_id")), "left_semi")
    back = stored(back.select("doc_id", "digest"), "simhash-back")
    rows = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("row"), *_key()).alias("r")
    once = rows.join(gone.alias("k"), F.col("r.doc_id").eqNullSafe(F.col("k.doc_id")), "left_anti").select("row")
    several = rows.join(back.alias("k"), _same("r", "k"), "left_semi")
    several = several.groupBy("doc_id", "digest").agg(F.min_by("row", F.to_json("row")).alias("row")).select("row")
    return once.union(several).select("row.*")


def _same(a: str, b: str) -> Column:
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.digest") == F.col(f"{b}.digest"))
