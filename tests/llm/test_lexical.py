"""Ranked lexical search against scores of all pairs."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest

from pitchflow.llm import lexical

ITEMS = "item_id long, text string, doc_id int, score string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def expected(rows, items, k=10):
    docs = [(d, Counter(w), len(w)) for d, w in ((d, words(t)) for d, t in rows) if w]
    n_docs, length = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in set(items):
        found = []
        for d, c, n in docs:
            m = 100 - 75 + (75 * n * n_docs) // length
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t in words(text) if c[t])
            if s > 0:
                found.append((-s, d is None, d or 0))
        out += [(item, r + 1, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


def found(spark, docs, rows, items, k=10):
    table = spark.createDataFrame([(*i, 7, "x") for i in items], ITEMS)
    out = lexical.search(docs(rows).selectExpr("*", "1 as item", "2 as rank", "3 as score", "4 as terms").repartition(3), table, k)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, out.collect()), key=repr)


def corpus(seed, n, vocabulary):
    r = np.random.default_rng(seed)
    p = 1 / np.arange(1, vocabulary + 1)
    return [(i, " ".join(f"w{t}" for t in r.choice(vocabulary, r.integers(1, 60), p=p / p.sum()))) for i in range(n)]


@pytest.mark.parametrize("seed", [0, 1])
def test_equals_all_pairs(spark, docs, seed, monkeypatch):
    rows = corpus(seed, 400, 300) + [(1000 + i, "w5 w17 w250 w251 w252") for i in range(150)]  # a group of copies
    items = [(i, t) for i, t in corpus(seed + 10, 25, 300)] + [(99, "w250 w251 w250 W252 w0")]
    assert found(spark, docs, rows, items) == expected(rows, items)
    monkeypatch.setattr(lexical, "ITEM_BYTES", 400)  # several parts of items
    assert found(spark, docs, rows, items, 3) == expected(rows, items, 3)


def test_edge_cases(spark, docs):
    rows = [
        (5, None), (6, ""), (7, "... !!"), (8, "Straße ÉTÉ été 42"), (None, "the word"), (None, "the word"), (9, "the word"), (9, "the word"),
        (10, "the other word " * 20_000), (11, "x"), (12, "the-word/the_word"), (-3, "The WORD"),
    ]
    items = [(1, "the word"), (1, "the word"), (1, "été 42"), (None, "ÉTÉ"), (2, None), (3, ""), (4, "nothing of it"), (5, "--")]
    assert found(spark, docs, rows, items) == expected(rows, [i for i in items if i[1]])


def test_empty_tables(spark, docs):
    assert found(spark, docs, [], [(1, "a")]) == [] == found(spark, docs, [(1, "a")], []) == found(spark, docs, [(1, None)], [(1, "a")])


def test_blocks_are_skipped_and_bounds_hold():
    """Over shards of any size, what is skipped could not have been among the best; most documents are."""
    rows = corpus(3, 3000, 400)
    items = lexical.Items([(0, b"w350 w351 w3"), (1, b"w0 w1 w2 w390")])
    sizes, term, count, n = [], [], [], []
    for _, t in rows:
        c = Counter(items.number[w.encode()] for w in words(t) if w.encode() in items.number)
        sizes.append(len(c)), n.append(len(words(t)))
        term += sorted(c)
        count += [c[x] for x in sorted(c)]
    keep = np.array(sizes) > 0
    doc = np.flatnonzero(keep)
    sizes, term, count = np.array(sizes)[keep], np.array(term), np.array(count, np.int64)
    weight = lexical.weights(np.bincount(term, minlength=len(items.number)), len(rows))
    m = 25 + (75 * np.array(n)[keep] * len(rows)) // sum(n)
    impact = 1_000_000_000 * count // (1000 * count + 8 * np.repeat(m, sizes))
    shard = lexical.Shard(doc, np.zeros(len(doc), bool), sizes, term, impact, weight)
    for _, own, many in items.queries:
        factor = np.zeros(len(weight), np.int64)
        factor[own] = weight[own] * many
        best = lexical.Best(10)
        scored = shard.search(own, factor, best)
        truth = shard.scores(np.arange(len(doc)), factor)
        order = np.lexsort((doc, -truth))[:10]
        assert best.doc.tolist() == doc[order].tolist() and best.score.tolist() == truth[order].tolist()
        assert scored < len(doc) / 2
    for t in range(len(weight)):
        docs_, first, of, terms, most = shard.blocks(t)
        assert sorted(docs_) == sorted(shard.owner[shard.list_at[t] : shard.list_at[t + 1]])
        for b in range(len(of)):
            top = dict(zip(terms[of[b] : of[b + 1] if b + 1 < len(of) else None], most[of[b] : of[b + 1] if b + 1 < len(of) else None], strict=True))
            for d in docs_[first[b] : first[b + 1]]:
                at = slice(shard.start[d], shard.start[d] + sizes[d])
                assert all(top[x] >= v for x, v in zip(term[at], impact[at], strict=True))
