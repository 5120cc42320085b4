"""Language-model scores by class-based bigrams (operator 9).

Brown model: P(w | v) = P(C(w) | C(v)) * P(w | C(w)). The token counts of all training
texts are exact: document shards send each of their different words once, cut by
hash into buckets, and get its total back, and its number in the bucket.

Words are assigned to ``CLASSES`` classes by exchange, in two steps. The ``HEAD`` most
frequent words, and one unit per octave of count for all others, are exchanged one
after another while that raises the likelihood of their bigrams. Then every other word seen ``2 ** RARE`` times
or more is exchanged on its own, in ``SWEEPS`` sweeps: shards count its neighbours' classes, buckets
add these counts up and move each word to the class that gives its own bigrams the highest
likelihood, all against the class bigrams of the sweep before. Words seen less often keep the class of
their octave. Emissions are discounted absolutely, and what that frees is the
probability of unknown words; transitions are smoothed by class unigrams.

The driver gets the head words, one number triple per bucket, the bigram
counts of the units and of the classes: all bounded by ``HEAD``, ``CLASSES``, the bucket count and the octaves.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchflow.llm.common import crc32_mod, discard, document_shards, stored

HEAD = 1000
#: Octaves of the count of a word that is not in the head.
_BANDS = 40
UNITS = HEAD + _BANDS
UNKNOWN = UNITS
CLASSES = 48
ROUNDS = 6
#: Octaves of rare words (seen less than 2 ** RARE times), which have no class of their own.
RARE = 2
#: Sweeps over all words that are neither in the head nor rare.
SWEEPS = 2
#: Rows of the likelihood's matrix that are computed at once.
_BLOCK = 1 << 16
#: Bytes of different words that one merging task gets on average.
BUCKET_BYTES = 8 << 20
#: The end of a text, as a word; no word is empty.
END = b""


def tokens(text: bytes) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case, then the end."""
    return [*text.lower().split(), END]


def band(counts: np.ndarray) -> np.ndarray:
    """Clustering unit of words outside the head by their count (1 or more)."""
    return HEAD + np.minimum(np.frexp(counts.astype(np.float64))[1] - 1, _BANDS - 1)


@dataclass
class Totals:
    """Corpus numbers and the head words, most frequent first."""

    tokens: int
    types: int
    once: int
    twice: int
    unit_types: np.ndarray
    head: list[bytes]

    @property
    def discount(self) -> float:
        """Absolute discount from the words seen once and twice."""
        seen = self.once + 2 * self.twice
        return min(0.95, max(0.1, self.once / seen)) if seen else 0.5


def word_totals(shards: DataFrame, buckets: int) -> DataFrame:
    """Rows (bucket, shard, words, counts, ids): for each shard its words with their training
    totals and their numbers in the bucket; and one row with shard -1 per bucket: its most frequent words, with
    tokens, types, words seen once and twice, and types by octave in ``sums``."""
    sent = "bucket long, shard long, words binary, counts binary"
    back = sent + ", ids binary, sums array<long>"

    def count(batches):
        for b in batches:
            shard = b.column("shard").to_numpy()
            for at in np.unique(shard):
                rows = np.flatnonzero(shard == at)
                own = b.take(pa.array(rows))
                counts: Counter = Counter()
                heard = set()
                for text, held in zip(own.column("text").to_pylist(), own.column("held_out").to_pylist(), strict=True):
                    (heard if held else counts).update(tokens(text))
                cells: dict[int, list[bytes]] = {}
                for w in counts.keys() | heard:
                    cells.setdefault(zlib.crc32(w) % buckets, []).append(w)
                for bucket, words in cells.items():
                    yield pa.RecordBatch.from_pydict(
                        {"bucket": [bucket], "shard": [int(at)], "words": [b"\n".join(words)], "counts": [np.array([counts[w] for w in words], np.int64).tobytes()]}
                    )

    def merge(table: pa.Table) -> pa.Table:
        total: Counter = Counter()
        blobs = table.column("words").to_pylist()
        for words, counts in zip(blobs, table.column("counts").to_pylist(), strict=True):
            for w, n in zip(words.split(b"\n"), np.frombuffer(counts, np.int64).tolist(), strict=True):
                total[w] += n
        out = [np.array([total[w] for w in words.split(b"\n")], np.int64).tobytes() for words in blobs]
        known = [n for n in total.values() if n]
        octaves = np.bincount(band(np.array(known)) - HEAD if known else [], minlength=_BANDS).tolist()
        # The end is in the head however rare it is.
        best = [x[1:] for x in sorted((w != END, -n, w) for w, n in total.items() if n)[:HEAD]]
        number = {w: i for i, w in enumerate(total)}
        ids = [np.array([number[w] for w in words.split(b"\n")], np.uint32).tobytes() for words in blobs]
        bucket = table.column("bucket")[0].as_py()
        rows = len(blobs)
        return pa.table(
            {
                "bucket": pa.array([bucket] * (rows + 1), pa.int64()),
                "shard": pa.array([*table.column("shard").to_pylist(), -1], pa.int64()),
                "words": pa.array([*blobs, b"\n".join(w for _, w in best)], pa.binary()),
                "counts": pa.array([*out, np.array([-n for n, _ in best], np.int64).tobytes()], pa.binary()),
                "ids": pa.array([*ids, None], pa.binary()),
                "sums": pa.array([*[None] * rows, [sum(known), len(known), known.count(1), known.count(2), *octaves]], pa.list_(pa.int64())),
            }
        )

    rows = shards.select("shard", "held_out", "text").mapInArrow(count, sent)
    return rows.groupBy("bucket").applyInArrow(merge, back)


def summed(totals: DataFrame) -> Totals:
    """The corpus numbers, and the head: the end, then words by descending count, then bytes."""
    ends = totals.where("shard = -1")
    sums = [int(x or 0) for x in ends.agg(*[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(4 + _BANDS)]).first()]

    def split(batches):
        for b in batches:
            for words, counts in zip(b.column("words").to_pylist(), b.column("counts").to_pylist(), strict=True):
                if counts:
                    yield pa.RecordBatch.from_arrays([pa.array(words.split(b"\n"), pa.binary()), pa.array(np.frombuffer(counts, np.int64))], names=["word", "n"])

    head = ends.select("words", "counts").mapInArrow(split, "word binary, n long").orderBy(F.length("word") > 0, F.desc("n"), "word").limit(HEAD).collect()
    types = np.zeros(UNITS, np.int64)
    types[: len(head)] = 1
    types[HEAD:] = sums[4:]
    if head:
        np.subtract.at(types, band(np.array([r["n"] for r in head])), 1)
    return Totals(*sums[:4], types, [bytes(r["word"]) for r in head])


_DOCS = "doc_id array<long>, held_out array<boolean>, n_tokens array<long>, n_known array<long>, base_score array<double>, emitted array<double>"
_READ = f"shard long, {_DOCS}, words binary, buckets binary, ids binary, units binary"


def _table(schema: str, rows: list[dict]) -> pa.Table:
    plain = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64(), "binary": pa.binary()}
    kinds = plain | {f"array<{k}>": pa.list_(v) for k, v in plain.items()}
    return pa.table({name: pa.array([r.get(name) for r in rows], kinds[kind]) for name, kind in (f.split() for f in schema.split(", "))})


def read_texts(shards: DataFrame, totals: DataFrame, of: Totals) -> DataFrame:
    """One row per shard: its documents' counts, base scores and the parts of their scores that do not
    depend on classes (log10 of the discounted counts); its tokens as numbers of its words; and
    the bucket, the number there and the unit of each of its words."""
    spark = shards.sparkSession
    head = spark.sparkContext.broadcast({w: i for i, w in enumerate(of.head)})

    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        if not len(docs):
            return _table(_READ, [])
        blobs = told.column("words").to_pylist()
        words = [w for x in blobs for w in x.split(b"\n")]
        counts = np.frombuffer(b"".join(told.column("counts").to_pylist()), np.int64)
        bucket = np.repeat(told.column("bucket").to_numpy(), [x.count(b"\n") + 1 for x in blobs]).astype(np.uint32)
        number = {w: i for i, w in enumerate(words)}
        unit = np.where(counts > 0, band(np.maximum(counts, 1)), UNKNOWN).astype(np.uint16)
        for w, i in head.value.items():
            if w in number:
                unit[number[w]] = i
        base = np.log10((counts + 1) / (of.tokens + of.types + 1))
        emitted = np.log10(np.maximum(counts - of.discount, 1e-9))
        out = {f.split()[0]: [] for f in _DOCS.split(", ")}
        seen_words = []
        for d, held, text in zip(docs.column("doc_id").to_pylist(), docs.column("held_out").to_pylist(), docs.column("text").to_pylist(), strict=True):
            seen = tokens(text)
            at = np.fromiter(map(number.__getitem__, seen), np.uint32, len(seen))
            known = counts[at] > 0
            for name, v in zip(out, (d, held, len(seen), int(known.sum()), float(base[at].sum()), float(emitted[at[known]].sum())), strict=True):
                out[name].append(v)
            seen_words.append(at.tobytes())
        ids = b"".join(told.column("ids").to_pylist())
        shard = docs.column("shard")[0].as_py()
        return _table(_READ, [out | {"shard": shard, "words": b"".join(seen_words), "buckets": bucket.tobytes(), "ids": ids, "units": unit.tobytes()}])

    own = totals.where("shard >= 0").select("shard", "bucket", "words", "counts", "ids")
    return shards.select("shard", "doc_id", "held_out", "text").groupBy("shard").cogroup(own.groupBy("shard")).applyInArrow(run, _READ)


class _Shard:
    """A row of :func:`read_texts` as arrays: the tokens' words, the first token of each
    document, and which tokens are learnt."""

    def __init__(self, row: dict):
        self.words = np.frombuffer(row["words"], np.uint32).astype(np.int64)
        self.units = np.frombuffer(row["units"], np.uint16)
        self.buckets = np.frombuffer(row["buckets"], np.uint32)
        self.ids = np.frombuffer(row["ids"], np.uint32)
        many = np.array(row["n_tokens"], np.int64)
        self.first = np.cumsum(many) - many
        self.learnt = np.repeat(~np.array(row["held_out"], bool), many)
        # The words that are exchanged on their own, by bucket.
        own = np.flatnonzero((self.units >= HEAD + RARE) & (self.units < UNKNOWN))
        self.own = own[np.argsort(self.buckets[own], kind="stable")]

    def classes(self, clusters: np.ndarray, told: pa.Table | None) -> np.ndarray:
        """Class of each word: ``told`` by the buckets, or that of its unit; ``CLASSES`` for unknown words."""
        out = np.concatenate((clusters, [CLASSES]))[self.units]
        if told is not None and len(self.own):
            told = told.sort_by("bucket")
            out[self.own] = np.frombuffer(b"".join(told.column("classes").to_pylist()), np.uint8)
        return out


def _before(now: np.ndarray, first: np.ndarray, ends: int) -> np.ndarray:
    """What stands before each token; the end stands before the first one of a text."""
    out = np.empty_like(now)
    out[1:] = now[:-1]
    out[first] = ends
    return out


def bigrams(read: DataFrame, ends: int) -> np.ndarray:
    """Counts of unit pairs over the training texts; ``ends`` is the unit of the end, which also
    stands before the first token."""
    size = UNITS

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                shard = _Shard(row)
                now = shard.units[shard.words].astype(np.int64)
                found, n = np.unique((_before(now, shard.first, ends) * size + now)[shard.learnt], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n.astype(np.int64))], names=["pair", "n"])

    rows = read.select(*_SHARD).mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size * size, np.int64)
    out[rows.column("pair").to_numpy()] = rows.column("n").to_numpy()
    return out.reshape(size, size)


_SHARD = ("n_tokens", "held_out", "words", "buckets", "ids", "units")
_ASKED = "bucket long, shard long, ids binary, now binary, cells binary, n binary, grid array<long>"
_TOLD = "bucket long, shard long, classes binary, types array<long>"


def ask(read: DataFrame, told: DataFrame | None, clusters: np.ndarray, ends: int) -> DataFrame:
    """Rows (bucket, shard, ids, now, cells, n): for each shard its words that are exchanged on their own,
    with their classes, and how often each has a class on its left and right in training texts;
    and one row with bucket -1 per shard: its training bigrams of classes in ``grid``."""

    def asked(row: dict, told: pa.Table | None) -> list[dict]:
        shard = _Shard(row)
        classes = shard.classes(clusters, told)
        now = classes[shard.words]
        before = _before(now, shard.first, int(clusters[ends]))
        grid = np.bincount((before * CLASSES + now)[shard.learnt], minlength=CLASSES * CLASSES)
        out = [{"bucket": -1, "shard": row["shard"], "grid": grid.tolist()}]
        place = np.full(len(classes), -1)
        place[shard.own] = np.arange(len(shard.own))
        at = np.flatnonzero(shard.learnt & (place[shard.words] >= 0))  # never an end, so a token follows
        cell = place[shard.words[at]] * (2 * CLASSES)
        cells, n = np.unique(np.concatenate((cell + before[at], cell + CLASSES + now[at + 1])), return_counts=True)
        buckets, begin = np.unique(shard.buckets[shard.own], return_index=True)
        for bucket, low, high in zip(buckets.tolist(), begin, np.append(begin, len(shard.own))[1:], strict=True):
            words = shard.own[low:high]
            from_, to = np.searchsorted(cells, [low * 2 * CLASSES, high * 2 * CLASSES])
            out.append(
                {
                    "bucket": bucket,
                    "shard": row["shard"],
                    "ids": shard.ids[words].tobytes(),
                    "now": classes[words].astype(np.uint8).tobytes(),
                    "cells": (cells[from_:to] - low * 2 * CLASSES).astype(np.uint32).tobytes(),
                    "n": n[from_:to].astype(np.uint32).tobytes(),
                }
            )
        return out

    return _with_told(read.select("shard", *_SHARD), told, asked, _ASKED)


def _with_told(read: DataFrame, told: DataFrame | None, made, schema: str) -> DataFrame:
    """``made(row, told)`` of each shard's row, with what the buckets told it."""
    if told is None:

        def alone(batches):
            for b in batches:
                for row in b.to_pylist():
                    yield from _table(schema, made(row, None)).to_batches()

        return read.mapInArrow(alone, schema)

    def both(rows: pa.Table, told: pa.Table) -> pa.Table:
        return _table(schema, [x for row in rows.to_pylist() for x in made(row, told)])

    own = told.where("shard >= 0").select("shard", "bucket", "classes")
    return read.groupBy("shard").cogroup(own.groupBy("shard")).applyInArrow(both, schema)


def summed_cells(rows: DataFrame, column: str, size: int) -> np.ndarray:
    """Element-wise sum of the arrays of ``size`` numbers in ``column``."""
    out = np.zeros(size)
    for r in rows.where(F.col(column).isNotNull()).select(F.posexplode(column).alias("at", "n")).groupBy("at").agg(F.sum("n").alias("n")).collect():
        out[r["at"]] = r["n"]
    return out


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300)) * (x > 0)


def moved(grid: np.ndarray, now: np.ndarray, word: np.ndarray, beside: np.ndarray, n: np.ndarray) -> np.ndarray:
    """New class of each word: the one in which its bigrams raise the class likelihood of ``grid`` most, all
    other words staying where they are. Entries are sorted by ``word``; ``beside`` is the class on
    the left, or ``CLASSES`` plus the class on the right. Ties keep the word where it is, then take the least class."""
    classes = len(grid)
    sides = np.concatenate((grid, grid.T))  # by the neighbour's side and class, then by the word's class
    gain = np.zeros((len(now), classes))
    for at in range(0, len(word), _BLOCK):
        w, k, m = word[at : at + _BLOCK], beside[at : at + _BLOCK], n[at : at + _BLOCK].astype(np.float64)
        base = sides[k]
        change = _xlogx(base + m[:, None]) - _xlogx(base)
        mine = (np.arange(len(w)), now[w])
        change[mine] = _xlogx(base[mine]) - _xlogx(np.maximum(base[mine] - m, 0))
        which, first = np.unique(w, return_index=True)
        gain[which] += np.add.reduceat(change, first, axis=0)
    each = np.arange(len(now))
    for side, total in ((beside >= classes, grid.sum(axis=1)), (beside < classes, grid.sum(axis=0))):
        own = np.bincount(word[side], n[side], len(now))[:, None]
        change = _xlogx(total + own) - _xlogx(total)
        change[each, now] = (_xlogx(total[None, :]) - _xlogx(np.maximum(total - own, 0)))[each, now]
        gain -= change
    best = gain.argmax(axis=1)
    return np.where(gain[each, best] > gain[each, now] + 1e-9, best, now)


def assign(asked: DataFrame, grid: np.ndarray) -> DataFrame:
    """For each shard the new classes of the words it asked for, in its order; and one row with shard -1
    per bucket: its words by class in ``types``."""

    def run(table: pa.Table) -> pa.Table:
        def joined(name, kind):
            return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)

        many = np.array([len(x) // 4 for x in table.column("ids").to_pylist()])
        begin = np.cumsum(many) - many
        words, of = np.unique(joined("ids", np.uint32), return_inverse=True)
        now = np.zeros(len(words), np.int64)
        now[of] = joined("now", np.uint8)
        cells = joined("cells", np.uint32).astype(np.int64)
        base = np.repeat(begin, [len(x) // 4 for x in table.column("cells").to_pylist()])
        key, number = np.unique(of[base + cells // (2 * CLASSES)] * (2 * CLASSES) + cells % (2 * CLASSES), return_inverse=True)
        n = np.bincount(number, joined("n", np.uint32).astype(np.float64), len(key))
        new = moved(grid, now, key // (2 * CLASSES), key % (2 * CLASSES), n)
        told, bucket = new[of].astype(np.uint8), table.column("bucket")[0].as_py()
        rows = [{"bucket": bucket, "shard": s, "classes": told[a : a + m].tobytes()} for s, a, m in zip(table.column("shard").to_pylist(), begin, many, strict=True)]
        return _table(_TOLD, [*rows, {"bucket": bucket, "shard": -1, "types": np.bincount(new, minlength=CLASSES).tolist()}])

    return asked.where("bucket >= 0").drop("grid").groupBy("bucket").applyInArrow(run, _TOLD)


_CLASSED = f"shard long, {_DOCS}, classes binary, grid array<long>"


def classed(read: DataFrame, told: DataFrame, clusters: np.ndarray, ends: int) -> DataFrame:
    """One row per shard: its documents' numbers, its tokens' classes, and its training bigrams of classes."""

    def run(row: dict, told: pa.Table) -> list[dict]:
        shard = _Shard(row)
        now = shard.classes(clusters, told)[shard.words]
        grid = np.bincount((_before(now, shard.first, int(clusters[ends])) * CLASSES + now)[shard.learnt], minlength=CLASSES * CLASSES)
        return [row | {"classes": now.astype(np.uint8).tobytes(), "grid": grid.tolist()}]

    return _with_told(read, told, run, _CLASSED)


def exchange(counts: np.ndarray, classes: int, rounds: int = ROUNDS) -> np.ndarray:
    """Class of each unit: starting from units dealt out by falling frequency, each unit in
    turn moves to the class that gives the bigrams the highest class likelihood."""
    units = len(counts)
    weight = counts.sum(axis=0) + counts.sum(axis=1)
    order = np.argsort(-weight, kind="stable")
    of = np.empty(units, np.int64)
    of[order] = np.arange(units) % classes
    member = np.zeros((units, classes))
    member[np.arange(units), of] = 1
    n = counts.astype(np.float64)
    grid = member.T @ n @ member

    for _ in range(rounds):
        moved = 0
        for w in order[weight[order] > 0]:
            left, right, own = n[:, w] @ member, n[w] @ member, n[w, w]
            g = of[w]
            # Without w's own pairs, which move with it.
            left[g] -= own
            right[g] -= own
            rest = grid.copy()
            rest[:, g] -= left
            rest[g, :] -= right
            rest[g, g] -= own
            # What changes if w joins class c: the pairs in row and column c, and the two class totals.
            row, col = rest.sum(axis=1), rest.sum(axis=0)
            row += left  # pairs with w on the right, whatever its class
            col += right
            gain = (_xlogx(rest + right[None, :]) - _xlogx(rest)).sum(axis=1) + (_xlogx(rest + left[:, None]) - _xlogx(rest)).sum(axis=0)
            d = np.diagonal(rest)
            gain += _xlogx(d + left + right + own) - _xlogx(d + right) - _xlogx(d + left) + _xlogx(d)
            gain -= _xlogx(row + right.sum() + own) - _xlogx(row) + _xlogx(col + left.sum() + own) - _xlogx(col)
            best = int(np.argmax(gain))
            if best != g and gain[best] > gain[g] + 1e-9:
                moved += 1
                of[w] = best
                member[w, g], member[w, best] = 0, 1
            else:
                best = g
            rest[:, best] += left
            rest[best, :] += right
            rest[best, best] += own
            grid = rest
        if not moved:
            break
    return of


@dataclass
class Model:
    """``step`` holds log10 P(class | class before) less the log10 size of the class, so that adding
    the log10 of a word's discounted count gives its probability; ``unknown`` is log10 P(unknown | class before)."""

    of: np.ndarray
    step: np.ndarray
    unknown: np.ndarray

    def scores(self, now: np.ndarray, first: np.ndarray, ends: int) -> np.ndarray:
        """Log10 probability of each text's tokens, given their classes, without the words' discounted counts."""
        # Unknown words are followed by what follows words seen once.
        step = np.column_stack((self.step, self.unknown))
        step = np.vstack((step, step[self.of[UNKNOWN]]))
        return np.add.reduceat(step[_before(now, first, ends), now], first)


def fit(counts: np.ndarray, of: Totals, classes: int = CLASSES) -> Model:
    """``counts``: training bigrams of units, each unit being in one class."""
    clusters = exchange(counts, classes)
    member = np.eye(classes)[clusters]
    return fitted(member.T @ counts @ member, of.unit_types @ member, clusters, of.discount)


def fitted(pairs: np.ndarray, types: np.ndarray, clusters: np.ndarray, discount: float) -> Model:
    """``pairs``: training bigrams of classes; ``types``: different words by class."""
    classes, mass = len(pairs), pairs.sum(axis=0)
    unigram = (mass + 1) / (mass.sum() + classes)
    step = (pairs + classes * unigram) / (pairs.sum(axis=1, keepdims=True) + classes)
    # A class without tokens keeps its share for unknown words.
    free = np.where(mass > 0, discount * types / np.maximum(mass, 1), 1)
    full = np.concatenate((clusters, [clusters[HEAD]]))
    return Model(full, np.log10(step) - np.log10(np.maximum(mass, 1)), np.log10(step @ free))


def lm_scores(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity) of every row.

    Texts whose crc32(doc_id) modulo 7 is 2 are held out, all others are learnt. A
    NULL text counts as empty: it has one token, the end. A NULL doc_id is not
    held out. Repeated rows count as often as they occur and each give a row.
    Without any training text every word is unknown and both scores are 0.
    Other columns are not read.
    """
    held = F.coalesce(crc32_mod("doc_id", 7) == 2, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    shards = document_shards(rows, "lm-shards")
    bytes_in = shards.agg(F.sum(F.length("text"))).first()[0] or 0
    # About a third of a shard's text is left when each of its words is taken once.
    totals = stored(word_totals(shards, max(1, bytes_in // (3 * BUCKET_BYTES))), "lm-totals")
    of = summed(totals)
    read = stored(read_texts(shards, totals, of), "lm-units")
    discard(shards)
    discard(totals)
    if not of.tokens:
        model, ends, known = None, 0, read
    else:
        counts = bigrams(read, of.head.index(END))
        clusters, told = exchange(counts, CLASSES), None
        for _ in range(SWEEPS):
            asked, before = stored(ask(read, told, clusters, of.head.index(END)), "lm-asked"), told
            grid = summed_cells(asked, "grid", CLASSES * CLASSES).reshape(CLASSES, CLASSES)
            told = stored(assign(asked, grid), "lm-told")
            for table in (asked, *([before] if before else [])):
                discard(table)
        known = stored(classed(read, told, clusters, of.head.index(END)), "lm-classes")
        discard(read)
        grid = summed_cells(known, "grid", CLASSES * CLASSES).reshape(CLASSES, CLASSES)
        units = np.eye(CLASSES)[clusters[: HEAD + RARE]]
        types = of.unit_types[: HEAD + RARE] @ units + summed_cells(told, "types", CLASSES)
        ends = int(clusters[of.head.index(END)])
        model = read.sparkSession.sparkContext.broadcast(fitted(grid, types, clusters, of.discount))
    names = [f.split()[0] for f in _DOCS.split(", ")]

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                cols = {name: b.column(name)[i].values for name in names}
                score = cols.pop("emitted").to_numpy()
                if model:
                    many = cols["n_tokens"].to_numpy()
                    now = np.frombuffer(b.column("classes")[i].as_py(), np.uint8).astype(np.int64)
                    score = score + model.value.scores(now, np.cumsum(many) - many, ends)
                yield pa.RecordBatch.from_arrays([*cols.values(), pa.array(score)], names=[*cols, "score"])

    scored = known.select(*names, *(["classes"] if model else [])).mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(of.tokens).cast("long").alias("train_tokens"), "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))
