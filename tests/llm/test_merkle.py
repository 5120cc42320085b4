"""Merkle manifest against a tree built by hand."""

from __future__ import annotations

import hashlib
import zlib
from itertools import groupby

import pytest

from pitchflow.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h string, g int, idx string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 16]) for i in range(0, len(out[-1]), 16)])
    return out


def siblings(levels, idx):
    for nodes in levels[:-1]:
        at = idx // 16 * 16
        yield nodes[at:idx], nodes[idx + 1 : at + 16]
        idx //= 16


def lower(t):
    return t and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def expected(rows):
    def leaf(r, text):
        return h(field(r[0]), field(r[3]), field(r[2]), field(r[4]), field(text))

    def order(r):
        return (r[3] is not None, (r[3] or "").encode(), r[0] is not None, r[0] or 0, leaf(r, r[1]))

    groups = [list(g) for _, g in groupby(sorted(rows, key=order), key=lambda r: r[3])]
    trees = [levels_of([leaf(r, r[1]) for r in g]) for g in groups]
    whole = levels_of([t[-1][0] for t in trees])
    out = []
    for s, (g, tree) in enumerate(zip(groups, trees, strict=True)):
        for i, r in enumerate(g):
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            now, proof = leaf(r, lower(r[1]) if hit else r[1]), ""
            for left, right in [*siblings(tree, i), *siblings(whole, s)]:
                now, proof = h(*left, now, *right), proof + "".join(left + right)
            out.append((r[0], tree[0][i], tree[-1][0], whole[-1][0], h(proof), now, now == whole[-1][0]))
    return out


def rows(n, source, text="Text {}"):
    return [(i, text.format(i), "en", source, i) for i in range(n)]


CASES = {
    "one row": rows(1, "a"),
    "one run": rows(16, "a"),
    "a run of one": rows(17, "a"),
    "three levels, hot source": rows(600, "a") + rows(40, "b") + rows(3, None) + rows(1, ""),
    "twenty sources": [r for k in range(20) for r in rows(k + 1, f"source é{k}")],
    "nulls, empty, long": [(None, None, None, None, None), (None, "A", "x", "s", 1), (5, "", "en", "s", 0), (6, "Ab " * 70_000, "en", "s", None), (7, "ÉA😀", "-", "-", 3)],
    "ties and repeated rows": rows(20, "a", "Same") + rows(20, "a", "Same") + [(3, f"Other {i}", "en", "a", 1) for i in range(20)],
    "no rows": [],
}


@pytest.mark.parametrize("name", CASES)
def test_equals_tree_built_by_hand(spark, docs, name):
    given = [(*r, "x", 1, "y") for r in CASES[name]]
    found = merkle.checked(spark.createDataFrame(given, SCHEMA).repartition(3), merkle.tampered())
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, expected(CASES[name])))


def test_changed_row_is_found(spark, docs):
    table = docs([(i, f"Text {i}") for i in range(40)])
    found = merkle.checked(table, merkle.F.expr("if(doc_id = 7, 'forged', text)")).collect()
    assert [r.doc_id for r in found if not r.verified] == [7]
    assert all(r.verified for r in merkle.checked(table).collect())
