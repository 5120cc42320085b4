"""Quality classifier (operator 10): nearest-neighbour voting in a latent-semantic space.

A text is counted into hashed terms: trigrams of character classes with a few
whole-text terms on repeated and capital words, and the words themselves. The counts of a bounded sample of
labelled texts give inverse document frequencies and, by singular value decomposition, a latent
space for either kind of term; a vector is made of both parts. The labelled vectors (``MAX_LABELLED`` rows of ``RANK`` and ``WORD_RANK`` numbers) are
broadcast; every text is projected, compared with all of them by blocked exact
cosine products, and its nearest neighbours vote with their similarity.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchflow.llm.common import batched, crc32_mod

#: Bound of the labelled sample that the model is fitted on and that is broadcast.
MAX_LABELLED = 6_000
RANK = 48
NEIGHBOURS = 15
THRESHOLD = 0.7
_HASHED = 1_000
_WORD_TERMS = 24
_SHAPE = _HASHED + _WORD_TERMS
#: Slots of hashed words, dimensions of their latent space, and the mean length of their part of a vector beside 1.
WORD_SLOTS = 1_024
WORD_RANK = 16
WORD_WEIGHT = 0.5
TERMS = _SHAPE + WORD_SLOTS


def _classes() -> np.ndarray:
    """Character class of each byte: letters, capitals, digits and white space are
    four classes, a byte of a longer UTF-8 sequence counts as a letter, and every
    other character is a class of its own."""
    of = np.arange(256, dtype=np.int64)
    of[ord("a") : ord("z") + 1] = ord("a")
    of[128:] = ord("a")
    of[ord("A") : ord("Z") + 1] = ord("A")
    of[ord("0") : ord("9") + 1] = ord("0")
    of[[9, 11, 12, 13]] = 32
    return of


_CLASS = _classes()


def _level(part: int, whole: int) -> int:
    """0 to 7: octave of a share, 7 for a half or more, 0 for none."""
    if not part:
        return 0
    return max(1, 7 + int(np.floor(np.log2(part / whole))) + 1) if part * 2 < whole else 7


def term_counts(text: bytes) -> np.ndarray:
    """Counts of the hashed terms over the whole text."""
    out = np.zeros(TERMS, np.float32)
    if not text:
        return out
    for at in range(0, len(text), 1 << 20):  # long texts in pieces that overlap by two bytes
        c = _CLASS[np.frombuffer(text[at : at + (1 << 20) + 2], np.uint8)]
        if len(c) > 2:
            slot = (((c[:-2] * 131 + c[1:-1]) * 137 + c[2:]) * 2654435761 >> 11) % _HASHED
            out[:_HASHED] += np.bincount(slot, minlength=_HASHED)
    found = text.split()
    if found:
        n = len(found)
        out[_HASHED + _level(sum(map(eq, found, found[1:])), n)] = n
        out[_HASHED + 8 + _level(sum(map(bytes.isupper, found)), n)] = n
        out[_HASHED + 16 + _level(n - len(set(found)), n)] = n
        slots = np.fromiter(map(zlib.crc32, text.lower().split()), np.int64, n) % WORD_SLOTS
        out[_SHAPE:] = np.bincount(slots, minlength=WORD_SLOTS)
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(size > 0, size, 1)


def _latent(x: np.ndarray, rank: int) -> np.ndarray:
    """The first ``rank`` right singular vectors of the rows, each made of length one in place."""
    size = np.linalg.norm(x, axis=1, keepdims=True)
    x /= np.where(size > 0, size, 1)
    _, axes = np.linalg.eigh((x.T @ x).astype(np.float64))  # largest last
    return np.ascontiguousarray(axes[:, ::-1][:, :rank], np.float32)


@dataclass
class Model:
    """Term weights, projection and the labelled vectors; ``prior`` is the labels' mean."""

    idf: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float
    neighbours: int = NEIGHBOURS

    def project(self, counts: np.ndarray) -> np.ndarray:
        return _unit((np.log1p(counts) * self.idf) @ self.basis)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        """Vote of the nearest labelled vectors, weighted by cosine; the prior where
        a text has no terms or the model no labelled rows."""
        if not len(self.labels):
            return np.full(len(counts), self.prior)
        x = self.project(counts)
        sim = x @ self.vectors.T
        k = min(self.neighbours, sim.shape[1])
        near = np.argpartition(sim, sim.shape[1] - k, axis=1)[:, -k:]
        weight = np.maximum(np.take_along_axis(sim, near, axis=1), 0).astype(np.float64) ** 8
        total = weight.sum(axis=1)
        vote = (weight * self.labels[near]).sum(axis=1) / np.where(total > 0, total, 1)
        return np.where(total > 0, np.clip(vote, 0, 1), self.prior)


def labelled(docs: DataFrame, labels: DataFrame, column: str, eligible: Column, most: int) -> DataFrame:
    """(doc_id, y, text) of at most ``most`` labelled documents.

    The sample is the smallest hashes of doc_id, so it is the same on every run.
    A doc_id counts once: with the smaller label of several label rows, with the text of
    the smallest hash of several texts. Labels other than 0 and 1 don't count.
    """
    chosen = (
        labels.where(F.col(column).isin(0, 1) & F.coalesce(eligible, F.lit(False)))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min(column).cast("int").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))


def _packed(counts: np.ndarray) -> tuple[bytes, bytes]:
    """The terms that occur, two bytes each, and their counts."""
    at = np.flatnonzero(counts)
    return at.astype(np.uint16).tobytes(), counts[at].tobytes()


def _unpacked(rows: pa.Table, first: int = 0, last: int = TERMS) -> np.ndarray:
    """Counts of the terms from ``first`` to ``last`` of :func:`_packed` rows."""
    out = np.zeros((len(rows), last - first), np.float32)
    for row, at, n in zip(out, rows.column("terms"), rows.column("counts"), strict=True):
        at = np.frombuffer(at.as_buffer(), np.uint16)
        own = slice(*np.searchsorted(at, (first, last)))
        row[at[own] - first] = np.frombuffer(n.as_buffer(), np.float32)[own]
    return out


def fit(docs: DataFrame, labels: DataFrame, eligible: Column, most: int = MAX_LABELLED, rank: int = RANK) -> Model:
    """Fit on at most ``most`` labelled rows of ``labels.quality`` for which ``eligible`` holds.

    The driver holds the sample's counts packed, and spread out for one kind of term at a time.
    """

    def run(batches):
        for b in batches:
            terms, counts = zip(*[_packed(term_counts(t)) for t in b.column("text").to_pylist()]) if b.num_rows else ((), ())
            columns = [b.column("doc_id"), b.column("y"), pa.array(terms, pa.binary()), pa.array(counts, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "y", "terms", "counts"])

    rows = labelled(docs, labels, "quality", eligible, most).mapInArrow(run, "doc_id long, y int, terms binary, counts binary").toArrow()
    rows = rows.sort_by("doc_id")
    y = np.array(rows.column("y").to_pylist(), np.float64)
    if not len(y):
        return Model(np.ones(TERMS, np.float32), np.eye(TERMS, rank, dtype=np.float32), np.zeros((0, rank), np.float32), y, 1.0)
    known = np.zeros(TERMS, np.int64)
    for at in rows.column("terms"):
        known[np.frombuffer(at.as_buffer(), np.uint16)] += 1
    idf = (np.log((1 + len(y)) / (1 + known)) + 0.1).astype(np.float32)

    def weighed(first: int, last: int) -> np.ndarray:
        x = _unpacked(rows, first, last)
        np.log1p(x, out=x)
        x *= idf[first:last]
        return x

    def part(first: int, last: int, dims: int) -> tuple[np.ndarray, float]:
        axes = _latent(weighed(first, last), dims)
        return axes, np.linalg.norm(weighed(first, last) @ axes, axis=1).mean()

    (shape, far), (words, word_far) = part(0, _SHAPE, rank), part(_SHAPE, TERMS, WORD_RANK)
    basis = np.zeros((TERMS, rank + WORD_RANK), np.float32)
    basis[:_SHAPE, :rank], basis[_SHAPE:, rank:] = shape, words * (WORD_WEIGHT * far / max(word_far, 1e-9))
    model = Model(idf, basis, np.zeros((0, rank + WORD_RANK)), y, float(y.mean()))
    pieces = [model.project(_unpacked(rows.slice(at, 1_000))) for at in range(0, len(y), 1_000)]
    model.vectors = np.concatenate(pieces).astype(np.float32)
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row; NULL texts count as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batched(batches, 256):
            counts = np.stack([term_counts(t) for t in b.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(shared.value.scores(counts))], names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``.

    Only labels of rows whose crc32(doc_id) modulo 4 is not 2 are learnt; rows with
    remainder 2 are held out. A text without terms (NULL, empty) gets the share of
    label 1 in the sample; without any usable label that share is 1. A NULL doc_id
    is not held out. Repeated rows each give a row, an empty table none. Very long texts are counted
    whole. Columns besides doc_id and text are not read.
    """
    model = fit(docs, labels, crc32_mod("doc_id", 4) != 2, most)
    return score(docs, model).select(
        "doc_id",
        F.coalesce(crc32_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> DataFrame:
    """``docs`` without the rows that the classifier rejects (score below 0.7).

    The model scores whole rows, so that every column passes through and rows
    with equal or NULL ids are each judged by their own text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, crc32_mod("doc_id", 4) != 2, most))
    names = docs.columns

    def run(batches):
        for b in batched(batches, 256):
            texts = b.column(names.index("text")).to_pylist()
            good = shared.value.scores(np.stack([term_counts((t or "").encode()) for t in texts])) >= THRESHOLD
            yield b.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)
