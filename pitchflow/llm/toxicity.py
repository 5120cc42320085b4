"""Toxicity by a bidirectional gated recurrent network (operator 2).

Every text is cut into overlapping windows of words. A word's input is the sum of an
embedding of the word, if it is among the sample's frequent words, and the mean
embedding of its hashed strings of four characters. Forward and backward gated recurrent units read the window, attention
pools their states, and a logistic unit gives the window's score; a text has
the score of its highest window, calibrated on the training texts.

The network is trained in numpy on a bounded sample of labelled texts: first with a
text's label on all of its windows, then, for toxic texts, on the windows that
score highest.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchflow.llm.common import batched, crc32_mod, discard, stored

#: Bounds of the training sample: texts of each label, and bytes of all texts of a label.
MAX_PER_LABEL = 2_000
MAX_SAMPLE_BYTES = 32 << 20
#: Windows start every half window, so a passage of up to 17 words lies whole in one of them.
WINDOW = 32
STRIDE = 16
#: Words with an embedding of their own: the most frequent in the sample, in so many texts at least.
VOCABULARY = 8_000
LEAST_TEXTS = 8
CHAR_SLOTS = 32_768
INPUT = 16
HIDDEN = 8
THRESHOLD = 0.5
_EDGE = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_BATCH = 256
#: Size of the labels' log odds in the first embeddings.
ODDS_SCALE = 1.0
PRIOR_TEXTS = 10
#: Weight decay of a training step, times its rate.
DECAY = 4.0


@dataclass
class Inputs:
    """Different words of some texts: 64-bit hash, slots of the strings of four, their word, their number."""

    words: np.ndarray
    chars: np.ndarray
    owner: np.ndarray
    count: np.ndarray


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def numbered(texts: list[bytes]) -> tuple[Inputs, list[np.ndarray]]:
    """The texts' different words, and each text as numbers of them from 1 on."""
    number: dict[bytes, int] = {}
    rows = [np.array([number.setdefault(w, len(number) + 1) for w in words_of(t)], np.int32) for t in texts]
    bare = [w.strip(_EDGE) or w for w in number]
    size = np.fromiter(map(len, bare), np.int64, len(bare))
    text = np.frombuffer(b" " + b"  ".join(bare) + b"    ", np.uint8).astype(np.uint64)
    with np.errstate(over="ignore"):
        four = text[:-3] << np.uint64(24) | text[1:-2] << np.uint64(16) | text[2:-1] << np.uint64(8) | text[3:]
        gram = (four ^ four >> np.uint64(15)) * np.uint64(0x9E3779B97F4A7C15)
        # A word of n bytes has n strings of four, the blank before it and those behind it included.
        start = np.cumsum(size + 2) - size - 2
        owner = np.repeat(np.arange(len(bare)), size)
        place = np.repeat(start, size) + np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
        chars = (gram[place] >> np.uint64(40)) % np.uint64(CHAR_SLOTS)
        # A word's hash: its bytes, each mixed with its position, added up.
        letter = text[place + 1] * np.uint64(0xD6E8FEB86659FD93) ^ (place - start[owner]).astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
        mixed = (letter ^ letter >> np.uint64(29)) * np.uint64(0xE7037ED1A0B428DB)
        words = np.zeros(len(bare), np.uint64)
        np.add.at(words, owner, mixed)
    return Inputs(words, chars.astype(np.int64), owner, np.maximum(size, 1)), rows


def windows_of(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All windows of the texts, padded with 0, and the text of each; a text without words has one."""
    cut, owner = [], []
    for i, row in enumerate(rows):
        n = max(1, -(-(len(row) - WINDOW) // STRIDE) + 1)
        padded = np.zeros((n - 1) * STRIDE + WINDOW, np.int32)
        padded[: len(row)] = row
        cut.append(np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::STRIDE])
        owner.append(np.full(n, i))
    return np.concatenate(cut), np.concatenate(owner)


class Network:
    """Weights and their use. Gates are stacked update, reset, candidate."""

    def __init__(self, vocabulary: np.ndarray, seed: int = 11):
        """``vocabulary``: hashes of the words with an embedding, ascending."""
        r = np.random.default_rng(seed)
        self.vocabulary = vocabulary

        def some(*shape, scale):
            return (r.standard_normal(shape) * scale).astype(np.float32)

        self.p = {
            "word": np.zeros((len(vocabulary) + 1, INPUT), np.float32),
            "char": some(CHAR_SLOTS, INPUT, scale=0.05),
            "v": some(2 * HIDDEN, scale=0.3),
            "w": some(2 * HIDDEN, scale=0.3),
            "b": np.zeros(1, np.float32),
        }
        for d in "fb":
            self.p |= {f"W{d}": some(INPUT, 3 * HIDDEN, scale=0.3), f"U{d}": some(HIDDEN, 3 * HIDDEN, scale=0.3), f"c{d}": np.zeros(3 * HIDDEN, np.float32)}
        self.scale, self.shift = 1.0, 0.0

    def rows(self, words: np.ndarray) -> np.ndarray:
        """Rows of the word embeddings; the last, which stays zero, for all other words."""
        if not len(self.vocabulary):
            return np.zeros(len(words), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == words, at, len(self.vocabulary))

    def vectors(self, x: Inputs) -> np.ndarray:
        """Input of every word, that of the padding (zeros) first."""
        out = np.zeros((len(x.words) + 1, INPUT), np.float32)
        at = 0
        while at < len(x.words):  # in pieces, by whole words
            end = min(len(x.words), at + 50_000)
            a, b = np.searchsorted(x.owner, (at, end))
            chars = self.p["char"][x.chars[a:b]]
            starts = np.searchsorted(x.owner[a:b], np.arange(at, end))
            sums = np.add.reduceat(chars, np.minimum(starts, max(0, b - a - 1)), axis=0) if b > a else np.zeros((end - at, INPUT), np.float32)
            out[1 + at : 1 + end] = self.p["word"][self.rows(x.words[at:end])] + sums / x.count[at:end, None]
            at = end
        return out

    def gates(self, vectors: np.ndarray) -> dict[str, np.ndarray]:
        return {d: vectors @ self.p[f"W{d}"] + self.p[f"c{d}"] for d in "fb"}

    def states(self, gates: np.ndarray, ids: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """Hidden states (time, unit, window) in the order of the words."""
        x = np.ascontiguousarray(np.take(gates, ids.T, axis=0).transpose(0, 2, 1))
        steps, _, n = x.shape
        u = np.ascontiguousarray(self.p[f"U{d}"].T)
        h = np.zeros((HIDDEN, n), np.float32)
        out = np.empty((steps, HIDDEN, n), np.float32)
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            g = u @ h
            a = x[t]
            zr = 0.5 * np.tanh(0.5 * (a[: 2 * HIDDEN] + g[: 2 * HIDDEN])) + 0.5
            z, r = zr[:HIDDEN], zr[HIDDEN:]
            m = np.tanh(a[2 * HIDDEN :] + r * g[2 * HIDDEN :])
            if keep is not None:
                keep.append((t, h, z, r, m, g[2 * HIDDEN :]))
            h = m + z * (h - m)
            out[t] = h
        return out

    def logits(self, gates: dict[str, np.ndarray], ids: np.ndarray, keep: dict | None = None) -> np.ndarray:
        h = np.concatenate([self.states(gates[d], ids, d, None if keep is None else keep.setdefault(d, [])) for d in "fb"], axis=1)
        energy = np.einsum("tkn,k->tn", h, self.p["v"])
        energy[(ids == 0).T] = -30.0
        weight = np.exp(energy - energy.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = np.einsum("tkn,tn->kn", h, weight)
        if keep is not None:
            keep |= {"h": h, "weight": weight, "pooled": pooled}
        return self.p["w"] @ pooled + self.p["b"][0]

    def gradients(self, x: Inputs, ids: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Gradient of the mean logistic loss over some windows."""
        vectors = self.vectors(x)
        keep: dict = {}
        logit = self.logits(self.gates(vectors), ids, keep)
        n = len(y)
        dl = ((0.5 * np.tanh(0.5 * logit) + 0.5 - y) / n).astype(np.float32)
        h, weight, pooled = keep["h"], keep["weight"], keep["pooled"]
        out = {"w": pooled @ dl, "b": np.array([dl.sum()], np.float32)}
        dpool = self.p["w"][:, None] * dl
        dweight = np.einsum("tkn,kn->tn", h, dpool)
        de = weight * (dweight - (weight * dweight).sum(axis=0))
        out["v"] = np.einsum("tkn,tn->k", h, de)
        dh_all = weight[:, None, :] * dpool[None] + de[:, None, :] * self.p["v"][None, :, None]
        dvec = np.zeros_like(vectors)
        for i, d in enumerate("fb"):
            own, u = dh_all[:, i * HIDDEN : (i + 1) * HIDDEN], self.p[f"U{d}"]
            dx = np.empty((len(ids[0]), 3 * HIDDEN, n), np.float32)
            du = np.zeros_like(u)
            dh = np.zeros((HIDDEN, n), np.float32)
            for t, before, z, r, m, gm in reversed(keep[d]):
                dh = dh + own[t]
                dz, dm = dh * (before - m) * z * (1 - z), dh * (1 - z) * (1 - m * m)
                dr = dm * gm * r * (1 - r)
                dg = np.concatenate((dz, dr, dm * r))
                dx[t] = np.concatenate((dz, dr, dm))
                du += before @ dg.T
                dh = dh * z + u @ dg
            flat = dx.transpose(0, 2, 1).reshape(-1, 3 * HIDDEN)
            at = ids.T.reshape(-1)
            out[f"U{d}"], out[f"c{d}"] = du, flat.sum(axis=0)
            dgate = np.zeros((len(vectors), 3 * HIDDEN), np.float32)
            np.add.at(dgate, at, flat)
            out[f"W{d}"] = vectors.T @ dgate
            dvec += dgate @ self.p[f"W{d}"].T
        dvec = dvec[1:]
        touched = np.flatnonzero(np.abs(dvec).sum(axis=1) > 0)
        out["word"], out["char"] = np.zeros_like(self.p["word"]), np.zeros_like(self.p["char"])
        np.add.at(out["word"], self.rows(x.words[touched]), dvec[touched])
        out["word"][-1] = 0
        rows = np.isin(x.owner, touched)
        np.add.at(out["char"], x.chars[rows], (dvec / x.count[:, None])[x.owner[rows]])
        return out

    def scores(self, texts: list[bytes], raw: bool = False) -> np.ndarray:
        """Score of each text: its highest window's, calibrated (or the logit as it is)."""
        x, rows = numbered(texts)
        ids, owner = windows_of(rows)
        gates = self.gates(self.vectors(x))
        top = np.full(len(texts), -np.inf)
        for at in range(0, len(ids), 2048):
            np.maximum.at(top, owner[at : at + 2048], self.logits(gates, ids[at : at + 2048]))
        return top if raw else 0.5 * np.tanh(0.5 * (self.scale * top + self.shift)) + 0.5


def _subset(x: Inputs, used: np.ndarray) -> Inputs:
    """Inputs of the words ``used`` only (numbers from 0, ascending)."""
    low, high = np.searchsorted(x.owner, used), np.searchsorted(x.owner, used, side="right")
    n = high - low
    pick = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
    return Inputs(x.words[used], x.chars[pick], np.repeat(np.arange(len(used)), n), x.count[used])


def _odds(x: Inputs, rows: list[np.ndarray], y: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For words, then for strings of four: the number of texts with it, and the smoothed log odds
    of toxic against other texts to have it."""
    size = np.bincount(x.owner, minlength=len(x.words))
    start = np.cumsum(size) - size
    counts = [np.zeros((2, n)) for n in (len(x.words), CHAR_SLOTS)]
    for row, label in zip(rows, y.astype(int), strict=True):
        own = np.unique(row) - 1
        n = size[own]
        slots = x.chars[np.repeat(start[own] - np.cumsum(n) + n, n) + np.arange(n.sum())]
        counts[0][label, own] += 1
        counts[1][label, np.unique(slots)] += 1
    texts = np.bincount(y.astype(int), minlength=2)[:, None]
    prior = PRIOR_TEXTS * texts / texts.sum()  # what no text has gets even odds, what few have little more
    shares = [np.log((c + prior) / (texts + PRIOR_TEXTS)) for c in counts]
    return [(c.sum(axis=0), s[1] - s[0]) for c, s in zip(counts, shares, strict=True)]


def train(texts: list[bytes], y: np.ndarray, prior: float, steps: int = 320, rate: float = 0.01, seed: int = 11) -> Network:
    """Train on labelled texts with Adam; ``prior`` is the share of label 1 among all labelled texts.

    After a quarter of the steps, toxic texts are represented by their highest windows, and
    half of the other windows come from those that score too high. Without both
    labels the network stays as it began and gives every text the one label.
    """
    r = np.random.default_rng(seed)
    if len(set(y.tolist())) < 2:
        net = Network(np.zeros(0, np.uint64), seed)
        net.scale, net.shift = 0.0, 8.0 if len(y) and y[0] else -8.0
        return net
    check = r.random(len(y)) < 0.25  # these calibrate the scores
    if len(set(y[check].tolist())) < 2 or len(set(y[~check].tolist())) < 2:
        check[:] = False
    told, truth = [t for t, c in zip(texts, check, strict=True) if c], y[check]
    texts, y = [t for t, c in zip(texts, check, strict=True) if not c], y[~check]
    x, rows = numbered(texts)
    ids, owner = windows_of(rows)
    words, chars = _odds(x, rows, y)
    often = np.argsort(-words[0], kind="stable")[:VOCABULARY]
    often = often[words[0][often] >= LEAST_TEXTS]
    net = Network(np.unique(x.words[often]), seed)
    # Embeddings start from what the sample says by itself: the labels' odds for each word and string.
    net.p["word"][net.rows(x.words[often]), 0] = ODDS_SCALE * words[1][often]
    net.p["char"][:, 1] = ODDS_SCALE * chars[1]
    of = y[owner].astype(np.float32)
    ones, zeros = np.flatnonzero(of == 1), np.flatnonzero(of == 0)
    hard = zeros
    first, second = ({k: np.zeros_like(v) for k, v in net.p.items()} for _ in range(2))
    for step in range(1, steps + 1):
        if step > steps // 4 and step % (steps // 8) == 0:
            gates = net.gates(net.vectors(x))
            logit = np.concatenate([net.logits(gates, ids[at : at + 2048]) for at in range(0, len(ids), 2048)])
            # Toxic texts: the highest window, and all that are toxic by themselves.
            best = np.zeros(len(texts))
            np.maximum.at(best, owner, logit - logit.min())
            high = logit - logit.min() >= best[owner]
            ones = np.flatnonzero((of == 1) & (high | (logit > 0)))
            zeros = np.flatnonzero(of == 0)
            hard = zeros[np.argsort(-logit[zeros])[: max(_BATCH, len(zeros) // 20)]]
        n = _BATCH // 4
        pick = np.concatenate((r.choice(ones, 2 * n), r.choice(zeros, n), r.choice(hard, n)))
        used, back = np.unique(ids[pick], return_inverse=True)
        words = used[used > 0]
        local = back.reshape(len(pick), WINDOW) + (1 if used[0] > 0 else 0)
        for k, g in net.gradients(_subset(x, words - 1), local, of[pick]).items():
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            size = np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8
            net.p[k] = (net.p[k] * (1 - DECAY * rate) - rate * (first[k] / (1 - 0.9**step)) / size).astype(np.float32)
    if not len(truth):
        told, truth = texts, y
    _calibrate(net, net.scores(told, raw=True), truth, prior)
    return net


def _calibrate(net: Network, logit: np.ndarray, y: np.ndarray, prior: float) -> None:
    """One-dimensional logistic fit of the label on a text's highest logit, slightly
    regularised; the labels weigh as much as they do among all labelled texts."""
    each = np.where(y == 1, prior / max(y.mean(), 1e-9), (1 - prior) / max(1 - y.mean(), 1e-9))
    mid = logit.mean()
    a, b = 1.0, 0.0
    for _ in range(50):
        z = logit - mid
        p = 0.5 * np.tanh(0.5 * (a * z + b)) + 0.5
        w = each * p * (1 - p) + 1e-6
        g = np.array([(each * (p - y) * z).sum() + 0.01 * a, (each * (p - y)).sum()])
        m = np.array([[(w * z * z).sum() + 0.01, (w * z).sum()], [(w * z).sum(), w.sum()]])
        step = np.clip(np.linalg.solve(m, g), -1, 1)
        a, b = a - step[0], b - step[1]
    net.scale, net.shift = float(a), float(b - a * mid)


def fit(docs: DataFrame, labels: DataFrame, eligible: Column, most: int = MAX_PER_LABEL, most_bytes: int = MAX_SAMPLE_BYTES) -> Network:
    """Train on at most ``most`` texts of each value of ``labels.toxic`` for which ``eligible`` holds.

    The sample is the smallest hashes of doc_id; of these, whole texts of whatever length
    are taken while a label's texts have at most ``most_bytes`` together, those that
    don't fit left out. A doc_id counts once: with the larger label of several
    label rows, with the text of the smallest hash of several texts. Labels other than 0 and 1 don't count.
    """
    own = labels.where(F.col("toxic").isin(0, 1) & F.coalesce(eligible, F.lit(False))).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("y"))
    share = own.agg(F.avg("y")).first()[0]
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    parts = [own.where(F.col("y") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for v in (0, 1)]
    rows = texts.join(F.broadcast(parts[0].union(parts[1])), "doc_id")
    sample = stored(rows.groupBy("doc_id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text")), "toxicity-sample")
    sizes = sample.select("doc_id", "y", F.octet_length("text").alias("n"), F.xxhash64("doc_id").alias("h")).toArrow().to_pylist()
    taken, room = [], {0: most_bytes, 1: most_bytes}
    for r in sorted(sizes, key=lambda r: (r["h"], r["doc_id"])):
        if r["n"] <= room[r["y"]]:
            room[r["y"]] -= r["n"]
            taken.append((r["doc_id"],))
    chosen = docs.sparkSession.createDataFrame(taken, "doc_id long")
    rows = sample.join(F.broadcast(chosen), "doc_id").toArrow().sort_by("doc_id")
    discard(sample)
    return train([bytes(t) for t in rows.column("text").to_pylist()], np.array(rows.column("y").to_pylist(), np.float64), share or 0.0)


def toxicity_scores(docs: DataFrame, labels: DataFrame, most: int = MAX_PER_LABEL) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``.

    Only labels of rows whose crc32(doc_id) modulo 5 is not 0 are learnt; rows with
    remainder 0 are held out. A NULL or empty text is scored as one window of
    padding; a very long one by all of its windows. A NULL doc_id is not held out. Repeated rows each give a
    row, an empty table none; without usable labels every score is near 0. Columns besides doc_id and text are not read.
    """
    net = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, crc32_mod("doc_id", 5) != 0, most))

    def run(batches):
        for b in batched(batches, 1000):
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(net.value.scores(b.column("text").to_pylist()))], names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double").select(
        "doc_id",
        F.coalesce(crc32_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
