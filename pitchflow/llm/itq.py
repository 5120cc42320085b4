"""Embedding near duplicates by iterative quantisation (operator 7).

A rotation of the centred vectors is learnt so that their signs are balanced
binary codes that lose little (iterative quantisation). Codes within ``RADIUS`` bits
are retrieved by multi-index Hamming tables: the code is cut into as many
substrings as leave about log2(n) bits each, and codes within the radius agree
in some substring up to a few bits; half of these are flipped on either side
of an equality join. The original vectors decide by their cosine in double precision.

Equal vectors are one class, so a group of copies costs one vector.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchflow.llm.common import connected_components, joined_to, stored

COSINE = 0.95
#: Bits by which the codes of a pair may differ. At cosine 0.95 about a tenth of the bits do.
RADIUS = 11
#: Vectors that the rotation is fitted on at most; all vectors are indexed.
SAMPLE = 20_000
ROUNDS = 30
BITS = 64


@dataclass
class Rotation:
    """Codes are the signs of (x / |x| - mean) @ axes."""

    mean: np.ndarray
    axes: np.ndarray

    def codes(self, x: np.ndarray) -> np.ndarray:
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        bits = (unit - self.mean) @ self.axes > 0
        packed = np.zeros((len(x), BITS), bool)
        packed[:, : bits.shape[1]] = bits
        return np.packbits(packed, axis=1, bitorder="little").view("<u8").reshape(-1).astype(np.uint64)


def learn(x: np.ndarray, bits: int = BITS, rounds: int = ROUNDS) -> Rotation:
    """Principal axes of unit vectors, turned by the rotation that alternately takes the nearest
    binary codes and the best rotation onto them (orthogonal Procrustes)."""
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    mean = unit.mean(axis=0)
    _, axes = np.linalg.eigh((unit - mean).T @ (unit - mean))
    axes = axes[:, ::-1][:, : min(bits, x.shape[1])]
    v = (unit - mean) @ axes
    turn = np.linalg.qr(np.random.default_rng(7).standard_normal((v.shape[1], v.shape[1])))[0]
    for _ in range(rounds):
        u, _, wt = np.linalg.svd(v.T @ np.where(v @ turn > 0, 1.0, -1.0))
        turn = u @ wt
    return Rotation(mean, axes @ turn)


def tables(n: int, radius: int = RADIUS) -> tuple[list[tuple[int, int]], int]:
    """((shift, width) of each substring, bits that a pair may differ by in the substring that finds it)."""
    m = max(2, round(BITS / max(8.0, math.log2(max(2, n)))))
    edges = [round(BITS * i / m) for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)], -(-(radius + 1) // m) - 1


def _masks(width: int, most: int) -> list[int]:
    return [sum(1 << b for b in c) for k in range(most + 1) for c in combinations(range(width), k)]


def _sub(code: Column, shift: int, width: int) -> Column:
    return F.shiftrightunsigned(code, shift).bitwiseAND(F.lit((1 << width) - 1))


def candidates(codes: DataFrame, n: int, radius: int = RADIUS) -> DataFrame:
    """(a, b), a < b, of all pairs of rows (id, dims, code) with the same dims and codes within ``radius`` bits, each once."""
    subs, flips = tables(n, radius)
    here = flips // 2
    there = flips - here

    def keyed(most: int, id_: str, code: str, mask: str) -> DataFrame:
        def entries(t: int, shift: int, width: int) -> Column:
            masks = F.array(*[F.lit(m).cast("long") for m in _masks(width, most)])
            return F.transform(masks, lambda m: F.struct(F.lit(t).alias("t"), _sub(F.col("code"), shift, width).bitwiseXOR(m).alias("key"), m.alias("mask")))

        rows = codes.select("dims", F.col("id").alias(id_), F.col("code").alias(code), F.explode(F.concat(*[entries(t, *x) for t, x in enumerate(subs)])).alias("e"))
        return rows.select("dims", id_, code, "e.t", "e.key", F.col("e.mask").alias(mask))

    index, queries = keyed(here, "a", "code_a", "mask_a"), keyed(there, "b", "code_b", "mask_b")
    x = F.col("code_a").bitwiseXOR(F.col("code_b"))
    near = [F.bit_count(_sub(x, s, w)) <= flips for s, w in subs]
    # Of the ways in which a pair is found one counts: its first table, and there the lowest bits flipped on a's side.
    first = F.coalesce(*[F.when(c, F.lit(t)) for t, c in enumerate(near)])
    ma, mb = F.col("mask_a"), F.col("mask_b")
    bits_a, bits_b = F.bit_count(ma), F.bit_count(mb)
    once = (bits_a == F.greatest(bits_a + bits_b - there, F.lit(0))) & (ma.bitwiseAND(mb) == 0) & ((ma == 0) | (ma < mb.bitwiseAND(-mb)))
    # Spark takes the entries to be as large as the codes that they are made of, and would send them all to every executor.
    found = index.hint("merge").join(queries, ["dims", "t", "key"]).where((F.col("a") < F.col("b")) & once & (F.bit_count(x) <= radius) & (first == F.col("t")))
    return found.select("a", "b")


def usable(column: str = "embedding") -> Column:
    """Whether a vector has a direction: not NULL, without NULL or non-finite components, not zero."""
    v = F.col(column)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _hash_bound(n: int, most: int) -> int:
    """A bound on a 64-bit hash of ``n`` different ids that ``most`` of them, and hardly more, stay below."""
    share = (most + 8 * math.sqrt(most) + 8) / max(1, n)
    return min(2**63 - 1, int(share * 2**64) - 2**63)


def sampled(classes: DataFrame, n: int, most: int) -> pa.Table:
    """(dims, v) of the ``most`` of the ``n`` classes whose ids have the least hashes, in the order of these.

    Each task would send its own ``most`` vectors to be compared. So only those are looked at whose
    hashes are below a bound that hardly more than ``most`` meet, whatever the number of tasks.
    """
    rows = classes.select("dims", "v", "id", F.xxhash64("id").alias("hash"))
    bound = _hash_bound(n, most)
    low = rows.where(F.col("hash") <= bound)
    while bound < 2**63 - 1 and low.count() < most:
        bound = min(2**63 - 1, 2 * bound + 2**63)
        low = rows.where(F.col("hash") <= bound)
    return low.orderBy("hash", "id").limit(most).select("dims", "v").toArrow()


def links(classes: DataFrame, least: float = COSINE, radius: int = RADIUS, sample: int = SAMPLE) -> DataFrame:
    """(a, b), a < b, of the classes (id, dims, v) found with cosine ``least`` or more."""
    spark = classes.sparkSession
    sizes = {r["dims"]: r["n"] for r in classes.groupBy("dims").agg(F.count("*").alias("n")).collect()}
    chosen = sampled(classes, sum(sizes.values()), sample)
    dims = chosen.column("dims").to_numpy()
    turns = spark.sparkContext.broadcast({d: learn(_matrix(chosen.column("v").filter(pa.array(dims == d)).combine_chunks())) for d in np.unique(dims).tolist()})

    def code(batches):
        for b in batches:
            dims = b.column("dims").to_numpy()
            for d in np.unique(dims):
                own = b.filter(pa.array(dims == d))
                # Vectors of a length that the sample misses are coded by their own signs.
                turn = turns.value.get(d) or Rotation(np.zeros(d), np.eye(d, min(d, BITS)))
                made = turn.codes(_matrix(own.column("v")))
                yield pa.RecordBatch.from_arrays([own.column("id"), own.column("dims"), pa.array(made.view(np.int64))], names=["id", "dims", "code"])

    codes = stored(classes.select("id", "dims", "v").mapInArrow(code, "id long, dims int, code long"), "itq-codes")
    pairs = candidates(codes, sum(sizes.values()), radius)

    def rerank(batches):
        for b in batches:
            dims = b.column("dims").to_numpy()
            for d in np.unique(dims):
                own = b.filter(pa.array(dims == d))
                x, y = _matrix(own.column("x")), _matrix(own.column("y"))
                cos = np.einsum("ij,ij->i", x, y) / (np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1))
                yield own.select(["a", "b"]).filter(pa.array(cos >= least))

    left = classes.select(F.col("id").alias("a"), "dims", F.col("v").alias("x"))
    right = classes.select(F.col("id").alias("b"), F.col("v").alias("y"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "dims", "x", "y")
    return both.mapInArrow(rerank, "a long, b long")


def near_duplicates(vectors: DataFrame, least: float = COSINE, radius: int = RADIUS, sample: int = SAMPLE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors``.

    Vectors that are NULL, empty, zero, or hold NULL or non-finite components link with
    nothing, and vectors of different lengths don't link. Rows with equal vectors
    link with each other, also if their vec_ids are equal; a NULL vec_id names a
    component only if no member has another, and is kept only then. Columns besides
    vec_id and embedding are not read.
    """
    rows = stored(
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(usable(), F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0))).alias("v")),
        "itq-vectors",
    )
    classes = rows.where("v is not null").groupBy("v").agg(F.min("vec_id").alias("first"), F.count("*").alias("n"))
    classes = stored(classes.select(F.monotonically_increasing_id().alias("id"), F.size("v").alias("dims"), "v", "first", "n"), "itq-classes")
    linked = stored(links(classes, least, radius, sample), "itq-links")
    n = classes.count()
    groups = connected_components(linked, "itq-components", n).withColumnRenamed("node", "id")
    sizes = joined_to(classes.select("id", "n"), max(n, 2 * linked.count()))
    both = linked.select(F.col("a").alias("id"), F.col("b").alias("other")).union(linked.select(F.col("b").alias("id"), F.col("a").alias("other")))
    others = both.join(sizes.withColumnRenamed("id", "other"), "other").groupBy("id").agg(F.sum("n").alias("beyond"))
    known = classes.select("id", "first", "n").join(joined_to(others, n), "id", "left").join(joined_to(groups, n), "id", "left")
    known = known.select("id", "first", (F.col("n") - 1 + F.coalesce("beyond", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component"))
    least_id = known.groupBy("component").agg(F.min("first").alias("component_id"))
    named = stored(known.join(joined_to(least_id, n), "component").select("id", "n_links", "component_id"), "itq-named")
    told = classes.select("id", "v").join(joined_to(named, n), "id").select("v", "n_links", "component_id", F.lit(True).alias("linked"))
    joined = rows.join(joined_to(told, n), "v", "left")
    component = F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("vec_id"))
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
