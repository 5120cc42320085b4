from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from pitchflow.llm import suffix_dedup
from pitchflow.llm.common import document_shards
from pitchflow.llm.suffixes import common_prefixes, merge_sorted, suffix_array


def brute(rows, length=50):
    """Straight from the definition: first doc_id of every string, by rising doc_id."""
    first: dict[bytes, float] = {}
    out = []
    order = sorted(rows, key=lambda r: float("inf") if r[0] is None else r[0])
    for d, t in order:
        raw, own = (t or "").encode(), float("inf") if d is None else d
        for s in range(len(raw) - length + 1):
            w = raw[s : s + length]
            first[w] = min(first.get(w, own), own)
    for d, t in order:
        raw, own = (t or "").encode(), float("inf") if d is None else d
        gone = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            if first[raw[s : s + length]] < own:
                gone[s : s + length] = b"\1" * length
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((d, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def random_text(r, n, letters="abcdefghij klmnop "):
    return "".join(r.choice(letters) for _ in range(n))


@pytest.fixture
def small_shards(monkeypatch):
    """Many small shards and buckets, as a large input would have."""
    monkeypatch.setattr(suffix_dedup, "document_shards", lambda rows, label: document_shards(rows, label, 2_000))
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 3_000)


def test_edge_cases_against_brute_force(docs, small_shards):
    r = random.Random(1)
    a, b, c = (random_text(r, 200) for _ in range(3))
    rows = [
        (5, a), (2, a), (9, a), (7, "short"), (8, "short"), (11, None), (12, ""), (13, "x" * 49), (14, "x" * 49),
        (15, "x" * 50), (16, "x" * 400), (17, b + a[20:120] + c), (18, c + b), (19, a[:50]), (20, a[1:50]), (3, "é" * 60 + b[:70]),
        (21, "é" * 26), (21, c), (21, c), (None, c), (None, c), (22, a[:49] + "\n" + a[49:]), (23, (b * 3)[:500]), (24, random_text(r, 12_000) + c + random_text(r, 50)),
    ]
    df = docs(rows).selectExpr("doc_id", "text", "1 as shard", "'d' as digest", "2 as n_bytes", "3 as n_removed")
    assert got(suffix_dedup.removed(df.repartition(3))) == brute(rows)


def test_random_passages_against_brute_force(docs, small_shards):
    r = random.Random(2)
    passages = [random_text(r, r.randint(30, 300), "ab ") for _ in range(12)]
    rows = [(i, "".join(r.choice(passages)[r.randint(0, 20) :] + random_text(r, r.randint(0, 80), "abc ") for _ in range(r.randint(0, 6)))) for i in r.sample(range(10_000), 120)]
    assert got(suffix_dedup.removed(docs(rows).repartition(4))) == brute(rows)


def test_given_documents_against_brute_force(sf_docs, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "document_shards", lambda rows, label: document_shards(rows, label, 60_000))
    rows = [(r.doc_id, r.text) for r in sf_docs.collect()]
    assert got(suffix_dedup.removed(sf_docs)) == brute(rows)


def test_empty_table(docs):
    assert suffix_dedup.removed(docs([])).count() == 0
    assert suffix_dedup.removed(docs([(1, None), (2, "")])).count() == 2


def test_cut_repeats_keeps_columns_and_decodes(docs, spark):
    r = random.Random(5)
    a = random_text(r, 120)
    rows = [(1, a), (2, "é" + a[:60] + "é tail"), (3, a), (4, None), (5, "kept")]
    df = docs(rows).selectExpr("*", "'mine' as digest", "doc_id as kept", "7 as `row`")
    out = {x.doc_id: x for x in suffix_dedup.cut_repeats(df).collect()}
    assert suffix_dedup.cut_repeats(df).columns == df.columns
    assert (out[1].text, out[1].n_chars, out[1].digest, out[1].kept, out[1].row) == (a, 120, "mine", 1, 7)
    assert (out[2].text, out[2].n_chars) == ("éé tail", 7)
    assert (out[3].text, out[3].n_chars) == ("", 0)
    assert (out[4].text, out[5].text) == (None, "kept")


def test_suffix_array_and_common_prefixes():
    rng = np.random.default_rng(0)
    for t in range(120):
        n = int(rng.integers(1, 160))
        text = rng.integers(97, 99 + t % 3, n).astype(np.uint8)
        if t % 3 == 0:
            text = np.tile(text[: max(1, n // 4)], 5)[:n]
            n = len(text)
        raw, depth = text.tobytes(), 50
        beginning = [raw[i : i + depth].ljust(depth, b"\0") for i in range(n)]
        sa, rank = suffix_array(text, depth)
        assert sorted(sa.tolist()) == list(range(n))
        assert [beginning[i] for i in sa] == sorted(beginning)
        lcp = common_prefixes(text, sa, depth)
        for k in range(1, n):
            x, y = beginning[sa[k - 1]], beginning[sa[k]]
            assert (rank[sa[k - 1]] == rank[sa[k]]) == (x == y)
            assert lcp[k] == next((m for m in range(depth) if x[m] != y[m]), depth)


def test_merge_sorted():
    a, b = np.array([1, 4, 6], np.uint64), np.array([0, 4, 5, 6, 9], np.uint64)
    union, both = merge_sorted(a, b)
    assert union.tolist() == [0, 1, 4, 5, 6, 9] and both.tolist() == [4, 6]
