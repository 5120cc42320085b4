"""Order MinHash fingerprints against the definition in plain Python."""

from __future__ import annotations

import hashlib
import re

import numpy as np

from pitchflow.llm import order_minhash as omh

NONE = hashlib.md5(b"").hexdigest()[:8] * omh.COMPONENTS


def md5(s):
    return hashlib.md5(s.encode()).hexdigest()


def fingerprint(text):
    runs = re.findall(r"[^\x20\x09-\x0D]{1,16}", text or "")
    if not runs:
        return NONE
    kmers = [" ".join(runs[i : i + 3]) for i in range(max(len(runs) - 2, 1))]
    met: dict[str, int] = {}
    ring = []
    for i, x in enumerate(kmers):
        ring.append((md5(f"{x} {met.get(x, 0)}"), i))
        met[x] = met.get(x, 0) + 1
    ring.sort()
    out = []
    for j in range(64):
        at = sum(p < f"{4 * j:02x}" for p, _ in ring)
        a, b = sorted((ring[at % len(ring)][1], ring[(at + 1) % len(ring)][1]))
        out.append(md5(f"{kmers[a]} {kmers[b]}")[:8])
    return "".join(out)


def alike(a, b):
    return sum(a[8 * j : 8 * j + 8] == b[8 * j : 8 * j + 8] for j in range(64)) / 64


def expected(rows):
    """rows in the order of the documents"""
    texts = [t or "" for _, t in rows]
    out = []
    for i, (d, _) in enumerate(rows):
        t, u = texts[i], texts[(i + 1) % len(rows)]
        half = len(t) // 2
        e = t[: len(t) - half] + u[:half]
        f = fingerprint(t)
        out.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), f, fingerprint(e), alike(f, fingerprint(e)), alike(f, fingerprint(u))))
    return sorted(out, key=repr)


def found(table):
    out = omh.edits(table)
    assert out.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return sorted(map(tuple, out.collect()), key=repr)


def test_equals_definition(spark, docs):
    r = np.random.default_rng(0)
    rows = [(i * 3 % 101, " ".join(r.choice(["a", "bb", "ccc", "über", "x" * 40], r.integers(0, 90)))) for i in range(60)]
    rows += [(500, "one two three " * 3000), (501, "𝒳😀 " * 50), (502, "ein"), (503, "ein zwei"), (-4, "\t\n "), (9999, "y" * 1000)]
    want = sorted(rows, key=lambda x: -x[0])
    clash = docs(rows).selectExpr("*", "1 as at", "2 as block", "'z' as fingerprint", "3 as next_text", "4 as _run").repartition(5)
    assert found(clash) == expected(want)


def test_nulls_ties_and_repeats(spark, docs):
    rows = [(7, "same words in a row here")] * 40 + [(3, None), (2, ""), (None, "the text without an id")]
    assert found(docs(rows).repartition(6)) == expected(rows)
    tied = [(1, f"text number {i} of a tie") for i in range(6)]
    got = found(docs(tied))
    assert sorted(r[3] for r in got) == sorted(fingerprint(t) for _, t in tied)
    assert found(docs([(1, "alone in the table")])) == expected([(1, "alone in the table")])
    assert found(docs([])) == []


def test_likeness_falls_with_edits(spark, docs):
    """Swapped halves have almost the k-mers of the text, and a fingerprint of their own; the share falls with each edit."""
    r = np.random.default_rng(1)
    base = [f"w{x}" for x in r.integers(0, 5000, 400)]
    edited = [base, [*base[:50], "new", *base[51:]], [*base[:50], *(f"n{i}" for i in range(60)), *base[110:]], base[200:] + base[:200], base[::-1]]
    df = docs([(i, " ".join(w)) for i, w in enumerate(edited)])
    prints = {r.doc_id: r.f.hex() for r in omh.with_fingerprint(df, "text", "f").collect()}
    near = [alike(prints[0], prints[i]) for i in range(5)]
    assert near[0] == 1 and 1 > near[1] > near[2] > 0.2 and 0.3 < near[3] < 0.7 and near[4] < 0.1
