from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from pitchflow.llm import packing


def cost(lengths, counts, bounds):
    return sum((min(b for b in bounds if b >= n) - n) * c for n, c in zip(lengths, counts))


def test_boundaries_are_optimal():
    r = np.random.default_rng(0)
    for _ in range(60):
        lengths = np.unique(r.integers(1, 60, r.integers(1, 10)))
        counts = r.integers(1, 20, len(lengths))
        for k in (1, 2, 3, 5):
            best = min(cost(lengths, counts, c) for m in range(1, min(k, len(lengths)) + 1) for c in combinations(lengths.tolist(), m) if c[-1] == lengths[-1])
            found = packing.boundaries(lengths, counts, k)
            assert len(found) <= k and found == sorted(found) and cost(lengths, counts, found) == best
    assert packing.boundaries(np.array([]), np.array([]), 4) == []


def check(rows, out, buckets, budget):
    n = sorted(len((t or "").split()) + 1 for _, t in rows)
    assert sorted(r.n_tokens for r in out) == n
    assert sorted(repr(r.doc_id) for r in out) == sorted(repr(d) for d, _ in rows)
    assert len({r.boundary for r in out}) <= buckets
    batches = {}
    for r in out:
        assert r.padding == r.boundary - r.n_tokens >= 0
        batches.setdefault((r.boundary, r.batch), []).append(r.slot)
    for (boundary, _), slots in batches.items():
        assert sorted(slots) == list(range(len(slots)))
        assert len(slots) * boundary <= budget or len(slots) == 1
    for boundary in {r.boundary for r in out}:  # all batches of a bucket but the last are full
        each = max(1, budget // boundary)
        sizes = [len(batches[boundary, i]) for i in range(sum(b == boundary for b, _ in batches))]
        assert all(s == each for s in sizes[:-1]) and 1 <= sizes[-1] <= each


def test_every_row_is_packed(docs):
    rows = [(i, "w " * (i * i % 47)) for i in range(80)] + [(3, "a b"), (3, "a b"), (None, None), (None, ""), (None, "x"), (99, "long " * 30_000)]
    df = docs(rows).selectExpr("*", "1 as boundary", "2 as batch", "3 as cell", "4 as `length`", "5 as n")
    check(rows, packing.pack(df, buckets=4, budget=100).collect(), 4, 100)


def test_given_documents_and_total_padding(sf_docs):
    rows = [(r.doc_id, r.text) for r in sf_docs.collect()]
    out = packing.pack(sf_docs).collect()
    check(rows, out, packing.BUCKETS, packing.TOKEN_BUDGET)
    short = [(n, c) for n, c in zip(*np.unique([r.n_tokens for r in out], return_counts=True)) if n <= 4096]
    one = cost([n for n, _ in short], [c for _, c in short], [max(n for n, _ in short)])
    assert sum(r.padding for r in out) < 0.1 * one


def test_empty_table(docs):
    assert packing.pack(docs([])).count() == 0


def test_long_lengths_are_exact(spark):
    """Boundaries over lengths beyond 4096 are the best there are, to the token."""
    r = np.random.default_rng(2)
    lengths = np.unique(np.concatenate([r.integers(1, 100, 4), r.integers(4097, 6000, 4), r.integers(60_000, 10**9, 3)]))
    counts = r.integers(1, 9, len(lengths))
    rows = [(i, n) for i, n in enumerate(np.repeat(lengths, counts).tolist())]
    df = spark.createDataFrame(rows, "doc_id long, n long").withColumn("text", F.lit("a b"))
    for k in (1, 3, 20):
        out = packing.pack(df, tokens=F.col("n"), buckets=k).collect()
        best = min(cost(lengths, counts, c) for m in range(1, min(k, 4) + 1) for c in combinations(lengths.tolist(), m) if c[-1] == lengths[-1]) if k < 20 else 0
        assert sum(x.padding for x in out) == best and sorted(x.n_tokens for x in out) == sorted(n for _, n in rows)


def test_equal_rows_are_dealt_to_several_blocks(docs):
    """Equal rows do not have to meet in one task, and every slot is still taken once."""
    rows = [(1, "same text here")] * 300 + [(i, "w " * (i % 40)) for i in range(100)]
    check(rows, packing.pack(docs(rows).repartition(8), buckets=3, budget=50).collect(), 3, 50)
