from __future__ import annotations

import tracemalloc
import zlib

import numpy as np
from pyspark.sql import functions as F

from pitchflow.llm import quality

LABELS = "doc_id long, quality int, toxic int"


def test_given_documents_held_out_accuracy(spark, docs):
    sf = "/root/testdata/sf0.01"
    table, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    out = {r.doc_id: r for r in quality.quality_scores(table, labels).collect()}
    assert len(out) == table.count()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for d, r in out.items())
    held = [(r.quality, out[r.doc_id].predicted) for r in labels.collect() if out[r.doc_id].held_out]
    assert len(held) > 50 and np.mean([a == b for a, b in held]) > 0.95
    kept = {r.doc_id for r in quality.keep_good(table, labels).collect()}
    assert kept == {d for d, r in out.items() if r.predicted}


def test_held_out_labels_are_not_learnt(spark, docs):
    rows = [(i, "plain words in a line " * 5 if i % 2 else "### *** !!! " * 8) for i in range(80)]
    held = {i for i in range(80) if zlib.crc32(str(i).encode()) % 4 == 2}

    def labels(flip):
        return spark.createDataFrame([(i, (i % 2) ^ (flip and i in held), 0) for i in range(80)], LABELS)

    a, b = ([(r.doc_id, r.score) for r in quality.quality_scores(docs(rows), labels(f)).orderBy("doc_id").collect()] for f in (False, True))
    assert a == b
    assert all(s == i % 2 for i, s in a)


def test_edge_cases(spark, docs):
    good, bad = "the words of a plain text are here and there", "%%% $$$ ||| &&&"
    rows = [(i, good if i % 2 else bad) for i in range(40)] + [(100, None), (101, ""), (102, "x"), (103, good * 20_000), (None, bad), (1, good), (1, good)]
    df = docs(rows).selectExpr("*", "1 as score", "2 as y", "3 as quality", "4 as counts")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(1, 1, 0), (1, 0, 1), (2, None, 0), (None, 1, 1), (3, 7, 1)], LABELS).selectExpr("*", "'t' as text")
    out = quality.quality_scores(df, labels).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out}
    assert by[100].score == by[101].score and 0 < by[100].score < 1  # no terms: the share of label 1
    assert by[103].score >= 0.7 and by[None].score < 0.1 and by[None].held_out is False
    assert quality.keep_good(df, labels).columns == df.columns


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], LABELS)
    assert quality.quality_scores(docs([]), none).count() == 0
    assert [(r.score, r.predicted) for r in quality.quality_scores(docs([(1, "a b")]), none).collect()] == [(1.0, 1)]


def test_votes_are_exact_neighbours():
    r = np.random.default_rng(0)
    counts = r.poisson(0.05, (90, quality.TERMS)).astype(np.float32)
    y = r.integers(0, 2, 60).astype(float)
    model = quality.Model(np.ones(quality.TERMS, np.float32), r.standard_normal((quality.TERMS, 12)).astype(np.float32), np.zeros((0, 12)), y, 0.5, neighbours=5)
    model.vectors = model.project(counts[:60])
    for x, s in zip(model.project(counts[60:]), model.scores(counts[60:])):
        cos = model.vectors @ x
        near = np.argsort(-cos)[:5]
        weight = np.maximum(cos[near], 0).astype(float) ** 8
        assert abs(s - (weight * y[near]).sum() / weight.sum()) < 1e-5


def test_texts_that_differ_in_their_words_alone(spark, docs):
    """Words of equal lengths and letters of one class: only the words themselves tell the labels apart."""
    r = np.random.default_rng(3)
    good, bad = ["stone", "river", "cloud", "field"], ["click", "bonus", "prize", "offer"]
    rows = [(i, " ".join(r.choice(good if i % 2 else bad, 30))) for i in range(120)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i, _ in rows], LABELS)
    out = quality.quality_scores(docs(rows), labels).collect()
    assert any(x.held_out for x in out) and all(x.predicted == x.doc_id % 2 for x in out)


def test_one_labelled_id_in_a_third_of_the_rows(spark, docs):
    rows = [(i, f"plain words {i}") for i in range(60)] + [(5, f"other words {i}") for i in range(30)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)], LABELS)
    model = quality.fit(docs(rows), labels, F.lit(True))
    assert len(model.labels) == 60


def test_driver_holds_the_sample_packed(spark, docs):
    """The sample's counts came to the driver with all their zeros, and were copied several times."""
    r = np.random.default_rng(4)
    rows = [(i, " ".join(r.choice(["stone", "river", "cloud", "field"], 12))) for i in range(2_500)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i, _ in rows], LABELS)
    spread = len(rows) * quality.TERMS * 4
    tracemalloc.start()
    try:
        model = quality.fit(docs(rows), labels, F.lit(True))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(model.labels) == len(rows) and most < 3 * spread


def test_fit_is_that_of_whole_counts(spark, docs):
    r = np.random.default_rng(5)
    rows = [(i, " ".join(r.choice(["Stone", "river,", "cloud", "FIELD", "x1", "é"], int(n)))) for i, n in enumerate(r.integers(0, 40, 1_203))]
    labels = spark.createDataFrame([(i, i % 2, 0) for i, _ in rows], LABELS)
    model = quality.fit(docs(rows), labels, F.lit(True))
    counts = np.stack([quality.term_counts(t.encode()) for _, t in rows])
    idf = (np.log((1 + len(rows)) / (1 + (counts > 0).sum(axis=0))) + 0.1).astype(np.float32)
    x = np.log1p(counts) * idf
    a, b = (quality._latent(p.copy(), n) for p, n in ((x[:, : quality._SHAPE], quality.RANK), (x[:, quality._SHAPE :], quality.WORD_RANK)))
    far = [np.linalg.norm(p, axis=1).mean() for p in (x[:, : quality._SHAPE] @ a, x[:, quality._SHAPE :] @ b)]
    basis = np.zeros((quality.TERMS, quality.RANK + quality.WORD_RANK), np.float32)
    basis[: quality._SHAPE, : quality.RANK], basis[quality._SHAPE :, quality.RANK :] = a, b * (quality.WORD_WEIGHT * far[0] / far[1])
    vectors = quality._unit(x @ basis)
    assert np.array_equal(model.idf, idf)
    assert np.allclose(model.vectors @ model.vectors.T, vectors @ vectors.T, atol=1e-4)
