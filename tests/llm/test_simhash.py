from __future__ import annotations

import random
import re

import numpy as np
import xxhash

from pitchflow.llm import simhash


def brute_fingerprint(text: str | None, k: int) -> int:
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, k=3, radius=2):
    fps = [brute_fingerprint(t, k) for _, t in rows]
    group = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(len(rows)):
                if group[i] != group[j] and (fps[i] ^ fps[j]).bit_count() <= radius:
                    group = [min(group[i], group[j]) if g in (group[i], group[j]) else g for g in group]
                    changed = True
    ids = {}
    for (d, _), g in zip(rows, group):
        ids[g] = min((x for x in (ids.get(g), d) if x is not None), default=None)
    return sorted(((d, f, ids[g]) for (d, _), f, g in zip(rows, fps, group)), key=repr)


def got(df):
    return sorted(((r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in df.collect()), key=repr)


def test_edge_cases_against_brute_force(docs):
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    rows = [(5, None), (4, ""), (9, " \t\n"), (3, "One two"), (8, "one TWO"), (2, "a b c d e"), (7, "a b c d e"),
            (7, "a b c d e"), (None, "a b c d e"), (None, "nothing like it"), (1, long), (6, long + " x"), (10, "ÀÉ x y z ß")]
    df = docs(rows).selectExpr("doc_id", "text", "1 as fp", "2 as component", "doc_id as component_id", "'q' as shard")
    assert got(simhash.near_duplicates(df)) == brute(rows)


def test_random_groups_against_brute_force(docs):
    r = random.Random(3)
    base = [" ".join(r.choice("abcdefgh") * r.randint(1, 3) for _ in range(r.randint(3, 60))) for _ in range(25)]
    rows = [(i, b) for i, b in enumerate(base)]
    for i in range(60):  # few shingles differ, so that chains of near fingerprints appear
        w = r.choice(rows)[1].split()
        w[r.randrange(len(w))] = r.choice("abcdefgh")
        rows.append((100 + i, " ".join(w)))
    df = docs(rows)
    assert got(simhash.near_duplicates(df)) == brute(rows)
    assert got(simhash.near_duplicates(df, radius=6)) == brute(rows, radius=6)


def test_given_documents_against_brute_force(sf_docs):
    rows = [(r.doc_id, r.text) for r in sf_docs.collect()]
    assert got(simhash.near_duplicates(sf_docs)) == brute(rows)


def test_forest_finds_all_pairs():
    r = np.random.default_rng(1)
    centres = r.integers(0, 2**63, 20).astype(np.uint64)
    fps = np.unique(np.concatenate([c ^ (np.uint64(1) << r.integers(0, 64, 30).astype(np.uint64)) for c in centres]))
    keys = r.integers(0, 3, len(fps))
    tree = simhash.BKForest(keys, fps)
    found = {tuple(sorted((int(tree.fps[i]), int(tree.fps[j])))) for a, b in tree.pairs(2) for i, j in zip(a, b)}
    want = {
        tuple(sorted((int(fps[i]), int(fps[j]))))
        for i in range(len(fps)) for j in range(i) if keys[i] == keys[j] and int(fps[i] ^ fps[j]).bit_count() <= 2
    }
    assert found == want


def test_empty_table_and_keep_one(docs):
    assert simhash.near_duplicates(docs([])).count() == 0
    rows = [(3, "x y z"), (1, "x y z"), (2, "other words here"), (None, "x y z"), (4, None), (5, "")]
    kept = simhash.keep_one(docs(rows))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 1, 2, 4]


def test_stars_keep_the_components():
    a, b = simhash.stars(np.array([5, 3, 9, 9, -4]), np.array([3, 2, 8, 7, 8]))
    assert sorted(zip(a.tolist(), b.tolist())) == [(3, 2), (5, 2), (7, -4), (8, -4), (9, -4)]
    assert [len(x) for x in simhash.stars(np.zeros(0, np.int64), np.zeros(0, np.int64))] == [0, 0]


def test_keep_one_of_repeated_and_clashing_ids(docs):
    one, two, three = "first text of some words", "another text, which is longer", "the third one is different again"
    rows = [(1, one), (1, one), (1, one), (9, one)]  # copies of one row
    rows += [(3, two), (5, two), (5, three), (6, three)]  # 5 goes beside 3 and stays beside 6
    rows += [(7, "x y z"), (7, "X y  z"), (7, "X y  z")]  # one id, two spellings of one fingerprint
    rows += [(8, "alpha beta"), (8, "gamma delta")]  # one id, smallest of two components
    rows += [(None, "no id here"), (None, "no id here"), (None, "NO id here"), (None, one)]
    df = docs(rows)
    out = simhash.keep_one(df.repartition(5))
    assert out.dtypes == df.dtypes
    got = sorted((repr(r.doc_id), r.text.lower().split()) for r in out.collect())
    want = [(1, one), (3, two), (5, three), (7, "x y z"), (8, "alpha beta"), (8, "gamma delta"), (None, "no id here"), (None, one)]
    assert got == sorted((repr(d), t.split()) for d, t in want)
    again = simhash.keep_one(df.repartition(2))
    assert sorted(map(repr, again.collect())) == sorted(map(repr, out.collect()))
