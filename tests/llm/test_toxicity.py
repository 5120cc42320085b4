from __future__ import annotations

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from pitchflow.llm import toxicity

LABELS = "doc_id long, quality int, toxic int"


def test_gradients_against_differences():
    x, rows = toxicity.numbered([b"the cat sat on a mat", "you are an idiot über all".encode(), b""])
    ids, _ = toxicity.windows_of(rows)
    y = np.array([0, 1, 0], np.float32)
    net = toxicity.Network(np.unique(x.words))
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    grads = net.gradients(x, ids, y)

    def loss():
        z = net.logits(net.gates(net.vectors(x).astype(float)), ids)
        return np.mean(np.log1p(np.exp(-np.where(y == 1, z, -z))))

    for k, p in net.p.items():
        at = np.unravel_index(np.argmax(np.abs(grads[k])), p.shape)
        was, step = p[at], 1e-3
        p[at] = was + step
        up = loss()
        p[at] = was - step
        down = loss()
        p[at] = was
        assert abs((up - down) / (2 * step) - grads[k][at]) < 1e-4 + 1e-2 * abs(grads[k][at]), k


def test_windows_cover_every_word():
    for n in (0, 1, 31, 32, 33, 55, 56, 57, 200):
        cut, owner = toxicity.windows_of([np.arange(1, n + 1, dtype=np.int32)])
        assert cut.shape[1] == toxicity.WINDOW and set(owner) == {0}
        assert set(cut.ravel()) - {0} == set(range(1, n + 1))
        if n:
            assert all((row > 0).any() for row in cut)


def made(n, seed):
    r = random.Random(seed)
    plain = [f"word{i}" for i in range(150)]
    rows = []
    for i in range(n):
        text = [r.choice(plain) for _ in range(r.randint(5, 120))]
        toxic = i % 2
        if toxic:
            for _ in range(1 + len(text) // 25):
                text[r.randrange(len(text))] = r.choice(["scoundrel", "Scoundrel,", "villain"])
        rows.append((i, " ".join(text), toxic))
    return rows


def test_learns_and_holds_out(spark, docs):
    rows = made(400, 1)
    held = {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    labels = spark.createDataFrame([(i, 1, t) for i, _, t in rows], LABELS)
    out = {r.doc_id: r for r in toxicity.toxicity_scores(docs([(i, x) for i, x, _ in rows]), labels).collect()}
    assert {i for i, r in out.items() if r.held_out} == held
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out.values())
    assert np.mean([out[i].predicted == t for i, _, t in rows if i in held]) > 0.95
    flipped = spark.createDataFrame([(i, 1, 1 - t if i in held else t) for i, _, t in rows], LABELS)
    again = {r.doc_id: r.score for r in toxicity.toxicity_scores(docs([(i, x) for i, x, _ in rows]), flipped).collect()}
    assert all(abs(again[i] - out[i].score) < 1e-6 for i in again)


def test_edge_cases(spark, docs):
    rows = made(60, 2)
    more = [(1000, None), (1001, ""), (1002, " \n"), (1003, "word1 " * 40_000 + "scoundrel"), (None, "villain"), (7, rows[7][1]), (7, rows[7][1])]
    df = docs([(i, x) for i, x, _ in rows] + more).selectExpr("*", "1 as score", "2 as toxic", "3 as y")
    labels = spark.createDataFrame([(i, 1, t) for i, _, t in rows] + [(7, 0, 0), (None, 1, 1), (5, 1, None), (6, 1, 9)], LABELS).selectExpr("*", "'t' as text")
    out = toxicity.toxicity_scores(df, labels).collect()
    assert len(out) == 67
    by = {r.doc_id: r.score for r in out}
    assert by[1000] == by[1001] == by[1002] and all(0 <= s <= 1 for s in by.values())


def test_empty_tables_and_one_label(spark, docs):
    none = spark.createDataFrame([], LABELS)
    assert toxicity.toxicity_scores(docs([]), none).count() == 0
    assert [r.predicted for r in toxicity.toxicity_scores(docs([(1, "a b"), (2, None)]), none).collect()] == [0, 0]
    ones = spark.createDataFrame([(i, 1, 1) for i in range(9)], LABELS)
    assert {r.predicted for r in toxicity.toxicity_scores(docs([(i, "a b") for i in range(9)]), ones).collect()} == {1}


def test_short_passages_lie_whole_in_a_window():
    for n in (33, 100, 200):
        cut, _ = toxicity.windows_of([np.arange(1, n + 1, dtype=np.int32)])
        for size in (8, 17):
            for at in range(1, n - size + 2):
                assert any(at in row and at + size - 1 in row for row in cut)


def test_one_labelled_id_in_a_third_of_the_rows_and_long_texts(spark, docs, monkeypatch):
    rows = made(80, 4)
    hot = [(3, f"scoundrel {i}") for i in range(40)]
    long = [(500 + i, "word1 word2 word3 " * 3000 + ("villain" if i % 2 else "")) for i in range(8)]
    labels = spark.createDataFrame([(i, 1, t) for i, _, t in rows] + [(i, 1, i % 2) for i, _ in long], LABELS)
    seen = []
    monkeypatch.setattr(toxicity, "train", lambda texts, y, prior: seen.append((texts, y)))
    df = docs([(i, x) for i, x, _ in rows] + hot + long)
    toxicity.fit(df, labels, F.lit(True))
    texts, y = seen.pop()
    assert len(texts) == 88 and sum(len(t) > 16_384 for t in texts) == 8 and y.sum() == 44
    toxicity.fit(df, labels, F.lit(True), most_bytes=75_000)
    texts, y = seen.pop()
    for v in (0, 1):
        assert sum(len(t) for t, own in zip(texts, y, strict=True) if own == v) <= 75_000
    assert len(texts) == 82  # one long text of each label fits beside the short ones
