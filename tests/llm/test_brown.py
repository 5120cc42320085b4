from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from pitchflow.llm import brown


def words(t):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), ""]


def held(d):
    return d is not None and zlib.crc32(str(d).encode()) % 7 == 2


def check_base(rows, out):
    counts = Counter(w for d, t in rows if not held(d) for w in words(t))
    n, v = sum(counts.values()), len(counts)
    want = sorted((repr(d), held(d), len(words(t)), sum(counts[w] > 0 for w in words(t)), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words(t)), 6)) for d, t in rows)
    assert sorted((repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out) == want


def test_given_documents(spark, docs):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(3, "doc_id")
    out = brown.lm_scores(df).collect()
    check_base([(r.doc_id, r.text) for r in df.collect()], out)
    mine = [r for r in out if r.held_out]
    assert sum(r.score for r in mine) > 0.9 * sum(r.base_score for r in mine)  # closer to zero is likelier
    assert all(math.isfinite(r.score) and r.score < 0 and abs(r.perplexity - 10 ** (-r.score / r.n_tokens)) < 1e-6 * r.perplexity for r in out)


def test_edge_cases(docs, monkeypatch):
    monkeypatch.setattr(brown, "BUCKET_BYTES", 10)
    rows = [(i, f"The cat {i % 5} sat\ton the mat{i}") for i in range(40)] + [(100, None), (101, ""), (102, "the " * 30_000), (None, "the cat"), (3, "the cat"), (3, "the cat"), (103, "Ünseen WORDS")]
    out = brown.lm_scores(docs(rows).selectExpr("*", "1 as shard", "2 as held_out", "3 as words", "4 as units").repartition(3)).collect()
    check_base(rows, out)


def test_empty_table_and_nothing_to_learn_from(docs):
    assert brown.lm_scores(docs([])).count() == 0
    only = next(i for i in range(100) if held(i))
    r = brown.lm_scores(docs([(only, "a b")])).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (3, 0, 0, 0.0, 0.0)


def test_model_is_a_distribution():
    """Over all known words and the unknown one, the probabilities after any class add up to one."""
    r = np.random.default_rng(0)
    sizes = np.zeros(brown.UNITS, np.int64)
    types = np.zeros(brown.UNITS, np.int64)
    types[:30] = 1
    types[brown.HEAD : brown.HEAD + 4] = [50, 20, 10, 5]
    sizes[:30] = r.integers(40, 90, 30)
    sizes[brown.HEAD : brown.HEAD + 4] = [50, 50, 55, 60]
    seen = np.flatnonzero(sizes)
    counts = np.zeros((brown.UNITS, brown.UNITS), np.int64)
    text = r.permutation(np.repeat(seen, sizes[seen]))
    np.add.at(counts, (np.concatenate(([0], text[:-1])), text), 1)
    of = brown.Totals(int(sizes.sum()), int(types.sum()), 50, 12, types, [brown.END, *[f"w{i}".encode() for i in range(29)]])
    model = brown.fit(counts, of)
    for before in range(brown.CLASSES):
        # all types of a unit share its class; their discounted counts add up to tokens less types
        known = sum((sizes[u] - of.discount * types[u]) * 10 ** model.step[before, model.of[u]] for u in seen)
        assert abs(known + 10 ** model.unknown[before] - 1) < 1e-6


def test_exchange_finds_planted_classes():
    r = random.Random(0)
    counts = np.zeros((30, 30), np.int64)
    for _ in range(20_000):  # units of one third are followed by those of the next
        a = r.randrange(30)
        counts[a, (a // 10 + 1) % 3 * 10 + r.randrange(10)] += 1
    of = brown.exchange(counts, 3)
    assert [len(set(of[k * 10 : k * 10 + 10])) for k in range(3)] == [1, 1, 1] and len(set(of)) == 3


def test_exchange_never_lowers_the_likelihood():
    r = np.random.default_rng(2)
    counts = r.poisson(0.3, (40, 40)).astype(np.int64)

    def likelihood(of, k):
        m = np.eye(k)[of]
        g = m.T @ counts @ m
        f = lambda x: (x * np.log(np.maximum(x, 1e-300))).sum()
        return f(g) - f(g.sum(0)) - f(g.sum(1))

    order = np.argsort(-(counts.sum(0) + counts.sum(1)), kind="stable")
    start = np.empty(40, np.int64)
    start[order] = np.arange(40) % 6
    values = [likelihood(start, 6), *[likelihood(brown.exchange(counts, 6, rounds), 6) for rounds in (1, 2, 4)]]
    assert values == sorted(values) and values[1] > values[0]


def test_words_move_to_the_class_that_explains_their_neighbours_best():
    """Against the likelihood's change worked out from the whole grid, word by word."""
    r = np.random.default_rng(5)
    k, words = 6, 40
    grid = r.integers(60, 200, (k, k)).astype(float)
    now = r.integers(0, k, words)
    near = r.poisson(0.8, (words, 2 * k))
    word, beside = np.nonzero(near)
    new = brown.moved(grid, now, word, beside, near[word, beside])

    def likelihood(rows, cols, inner):
        f = lambda x: (x * np.log(np.maximum(x, 1e-300))).sum()
        return f(inner) - f(rows) - f(cols)

    for w in range(words):
        left, right, g = near[w, :k].astype(float), near[w, k:].astype(float), now[w]
        gains = []
        for c in range(k):
            # the word's own bigrams on each side, in class c or taken out of its class
            sign = -1.0 if c == g else 1.0
            follow, precede = grid.copy(), grid.copy()
            follow[c] += sign * right
            precede[:, c] += sign * left
            change = sum(
                sign * (likelihood(0 * x, 0 * x, x) - likelihood(0 * x, 0 * x, grid)) for x in (follow, precede)
            )
            for total, n in ((grid.sum(1)[c], right.sum()), (grid.sum(0)[c], left.sum())):
                change -= sign * ((total + sign * n) * math.log(total + sign * n) - total * math.log(total))
            gains.append(change)
        assert gains[new[w]] >= max(gains) - 1e-6 and (new[w] == g or gains[new[w]] > gains[g])


def test_scores_do_not_depend_on_shards(docs, monkeypatch):
    """Words outside the head are exchanged over all shards' counts, however the texts are cut."""
    r = random.Random(3)
    vocabulary = [[f"{kind}{i}" for i in range(900)] for kind in "xyz"]
    rows = [(d, " ".join(r.choice(vocabulary[i % 3]) for i in range(120))) for d in range(150)]
    whole = {x.doc_id: x for x in brown.lm_scores(docs(rows)).collect()}
    monkeypatch.setattr(brown, "BUCKET_BYTES", 3000)
    cut = brown.lm_scores(docs(rows).repartition(5)).collect()
    assert len(cut) == len(rows) and all(abs(x.score - whole[x.doc_id].score) < 1e-6 * abs(x.score) for x in cut)


def test_an_end_rarer_than_the_head(docs):
    learnt = next(i for i in range(100) if not held(i))
    text = " ".join(f"w{i}" for i in range(1500))
    (out,) = brown.lm_scores(docs([(learnt, f"{text} {text}")])).collect()
    assert (out.n_tokens, out.n_known) == (3001, 3001) and math.isfinite(out.score) and out.score < 0
