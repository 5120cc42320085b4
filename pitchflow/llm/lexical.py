"""Ranked lexical search by per-term geometric blocking (operator 13).

Every item is a query against all documents; its ``k`` best are exact.

1. One pass over the texts keeps of each document its length and how often it has each of the
   items' terms. Document counts and lengths come from that table.
2. Every task reads that table in shards of ``POSTINGS`` entries at most (one longer
   document makes a shard of its own) and builds an index of each: a posting list a term. A
   list's documents are clustered by similarity, around representatives from the list; each
   cluster is a block with a summary, the maximum of each coordinate over its documents.
3. An item goes through its terms' lists, the heaviest first. A block is skipped only if
   the item's product with its summary is under the item's ``k``-th best score so far; with the
   terms that were already gone through left out of the product, since a document that has
   one of them was met, or skipped by a larger bound, in that term's list. The rest of a
   query is skipped when the lists' own maxima are below that score. All documents of the
   other blocks get their exact score.
4. Each task returns the ``k`` best of each item that it has met; the best of all tasks are the result.

Items are taken in parts of about ``ITEM_BYTES`` of text (one longer item makes its part
longer), one search each, so that what the tasks hold of the items is bounded. Arithmetic
is in 64-bit integers but for the logarithm of a term's weight.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitchflow.llm.common import discard, stored

K = 10
#: Entries (document, term) of an index shard.
POSTINGS = 1 << 19
#: Documents of a block, on average.
BLOCK = 32
#: Blocks evaluated before the bounds of the others are looked at again.
AT_ONCE = 8
#: Random projections that documents are compared by when a list is clustered.
PROJECTIONS = 16
#: Bytes of items' text that a search takes at once.
ITEM_BYTES = 4 << 20
#: Tokens of texts that are counted at once.
TOKENS = 1 << 20

_FORWARD = "doc_id long, n long, terms array<int>, counts array<int>"
_BEST = "item int, doc_id long, score long"
# Bytes of terms: digits, letters (A-Z as a-z) and all beyond ASCII; any other byte parts them.
_TERM = bytes(ord(chr(b).lower()) if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(0x80)) + bytes(range(0x80, 0x100))


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, in order."""
    return text.translate(_TERM).split()


class Items:
    """The items of one part: their terms, numbered, and each item's terms with its own counts."""

    def __init__(self, rows: list[tuple[int, bytes]]):
        self.number: dict[bytes, int] = {}
        self.queries = []
        for item, text in rows:
            own: dict[int, int] = {}
            for t in terms(text):
                i = self.number.setdefault(t, len(self.number))
                own[i] = own.get(i, 0) + 1
            if own:
                self.queries.append((item, np.fromiter(own, np.int64, len(own)), np.fromiter(own.values(), np.int64, len(own))))


def forward(docs: DataFrame, items) -> DataFrame:
    """(doc_id, n, terms, counts) of every document with a term: its number of terms, and which of the items' terms it has how often."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = items.value.number.get
        held: list = []

        def flush():
            sizes = np.array([len(x[1]) for x in held], np.int64)
            found = np.fromiter((i for x in held for i in x[1]), np.int64, sizes.sum())
            doc = np.repeat(np.arange(len(held)), sizes)[found >= 0]
            key, many = np.unique(doc << 32 | found[found >= 0], return_counts=True)
            at = np.searchsorted(key >> 32, np.arange(len(held) + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(at, pa.array(x.astype(np.int32))) for x in (key & 0xFFFFFFFF, many)]
            out = [pa.array([x[0] for x in held], pa.int64()), pa.array(sizes), *lists]
            held.clear()
            return pa.RecordBatch.from_arrays(out, names=["doc_id", "n", "terms", "counts"])

        waiting = 0
        for b in batches:
            texts = pc.cast(b.column("text"), pa.binary())
            for doc_id, text in zip(b.column("doc_id"), texts, strict=True):
                found = [known(t, -1) for t in terms(text.as_py() or b"")]
                if found:
                    held.append((doc_id.as_py(), found))
                    waiting += len(found)
                if waiting >= TOKENS:
                    yield flush()
                    waiting = 0
        if held:
            yield flush()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(count, _FORWARD)


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    """floor(1000 ln((2N + 2) / (2 df + 1))) of each term."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


class Best:
    """The ``k`` best documents of an item so far: by score, then by id; a NULL id comes last."""

    def __init__(self, k: int):
        self.k, self.score, self.doc, self.none = k, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def least(self) -> int:
        """A score that a further document must have, at least."""
        return max(1, int(self.score[-1])) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, doc: np.ndarray, none: np.ndarray) -> None:
        good = score >= self.least()
        score, doc, none = (np.concatenate([a, b[good]]) for a, b in ((self.score, score), (self.doc, doc), (self.none, none)))
        order = np.lexsort((doc, none, -score))[: self.k]
        self.score, self.doc, self.none = score[order], doc[order], none[order]


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each span, one span after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


class Shard:
    """Blocked posting lists of some documents, each of which has at least one of the terms."""

    def __init__(self, doc, none, sizes, term, impact, weight):
        self.doc, self.none, self.sizes, self.term, self.impact = doc, none, sizes, term, impact
        self.start = np.cumsum(sizes) - sizes
        self.n_terms = len(weight)
        order = np.argsort(term, kind="stable")
        self.owner = np.repeat(np.arange(len(doc), dtype=np.int64), sizes)[order]
        self.list_at = np.searchsorted(term[order], np.arange(self.n_terms + 1))
        self.most = np.zeros(self.n_terms, np.int64)
        np.maximum.at(self.most, term, impact)
        directions = np.random.default_rng(0).standard_normal((self.n_terms, PROJECTIONS)).astype(np.float32)
        value = (weight[term] * impact).astype(np.float32)
        sketch = np.stack([np.add.reduceat(directions[term, j] * value, self.start) for j in range(PROJECTIONS)], axis=1)
        self.sketch = sketch / np.maximum(np.linalg.norm(sketch, axis=1, keepdims=True), 1e-30)
        self.lists: dict[int, tuple] = {}

    def blocks(self, t: int):
        """A term's list: its documents block by block, the blocks' starts, and the summaries (start of each block's, terms, maxima)."""
        if t not in self.lists:
            docs = self.owner[self.list_at[t] : self.list_at[t + 1]]
            many = -(-len(docs) // BLOCK)
            near = np.zeros(len(docs), np.int64)
            if many > 1:
                chosen = self.sketch[docs[(np.arange(many) * len(docs)) // many]]
                for at in range(0, len(docs), 4096):
                    near[at : at + 4096] = np.argmax(self.sketch[docs[at : at + 4096]] @ chosen.T, axis=1)
            order = np.argsort(near, kind="stable")
            docs, near = docs[order], near[order]
            first = np.flatnonzero(np.diff(near, prepend=-1))
            block = np.repeat(np.arange(len(first)), np.diff(first, append=len(docs)))
            entry = _spans(self.start[docs], self.sizes[docs])
            key = np.repeat(block, self.sizes[docs]) * self.n_terms + self.term[entry]
            by_key = np.argsort(key, kind="stable")
            key = key[by_key]
            own = np.flatnonzero(np.diff(key, prepend=-1))
            most = np.maximum.reduceat(self.impact[entry[by_key]], own)
            of = np.searchsorted(key[own] // self.n_terms, np.arange(len(first)))
            self.lists[t] = docs, np.append(first, len(docs)), of, key[own] % self.n_terms, most
        return self.lists[t]

    def scores(self, docs: np.ndarray, factor: np.ndarray) -> np.ndarray:
        entry = _spans(self.start[docs], self.sizes[docs])
        ends = np.cumsum(self.sizes[docs])
        return np.add.reduceat(factor[self.term[entry]] * self.impact[entry], ends - self.sizes[docs])

    def search(self, query: np.ndarray, factor: np.ndarray, best: Best) -> int:
        """Bring ``best`` up to date with this shard; ``factor`` is what a unit of a term's impact
        adds, 0 for terms that are not in ``query``. Returns how many documents were scored."""
        gain = factor[query] * self.most[query]
        query = query[np.argsort(-gain, kind="stable")]
        rest = np.cumsum(np.sort(gain))[::-1]
        left, seen, scored = factor.copy(), np.zeros(len(self.doc), bool), 0
        for t, bound in zip(query.tolist(), rest.tolist(), strict=True):
            if bound < best.least():
                break
            docs, first, of, terms_, most = self.blocks(t)
            bounds = np.add.reduceat(left[terms_] * most, of)
            order = np.argsort(-bounds, kind="stable")
            for at in range(0, len(order), AT_ONCE):
                chosen = order[at : at + AT_ONCE]
                chosen = chosen[bounds[chosen] >= best.least()]
                if not len(chosen):
                    break
                met = docs[_spans(first[chosen], first[chosen + 1] - first[chosen])]
                met = met[~seen[met]]
                if len(met):
                    seen[met] = True
                    scored += len(met)
                    best.add(self.scores(met, factor), self.doc[met], self.none[met])
            left[t] = 0
        return scored


def shards(batches: Iterator[pa.RecordBatch], n_docs: int, length: int, weight: np.ndarray, postings: int = POSTINGS) -> Iterator[Shard]:
    """Index shards of the rows of :func:`forward`."""
    held, waiting = [], 0

    def build() -> Shard:
        doc, none, n, sizes, term, count = (np.concatenate(x) for x in zip(*held, strict=True))
        m = 100 - 75 + (75 * n * n_docs) // length
        impact = (1_000_000_000 * count) // (1000 * count + 8 * np.repeat(m, sizes))
        return Shard(doc, none, sizes, term, impact, weight)

    for b in batches:
        sizes = pc.list_value_length(b.column("terms")).to_numpy(zero_copy_only=False).astype(np.int64)
        ids = b.column("doc_id")
        doc, none = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False)
        n = b.column("n").to_numpy(zero_copy_only=False)
        term, count = (b.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("terms", "counts"))
        ends, at = np.cumsum(sizes), 0
        while at < len(sizes):
            done = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + postings - waiting, side="right")))
            has = at + np.flatnonzero(sizes[at:to])
            if len(has):
                held.append((doc[has], none[has], n[has], sizes[has], term[done : ends[to - 1]], count[done : ends[to - 1]]))
                waiting += int(ends[to - 1]) - done
            at = to
            if waiting >= postings or at < len(sizes):
                if held:
                    yield build()
                held, waiting = [], 0
    if held:
        yield build()


def _search_part(docs: DataFrame, rows: list[tuple[int, bytes]], k: int) -> DataFrame | None:
    """(item, doc_id, score): each task's ``k`` best documents of each of these items."""
    spark = docs.sparkSession
    items = Items(rows)
    if not items.queries:
        return None
    held = spark.sparkContext.broadcast(items)
    table = stored(forward(docs, held), "lexical-forward")
    n_docs, length = table.agg(F.count("*"), F.sum("n")).first()
    if not n_docs:
        return None
    df = np.zeros(len(items.number), np.int64)
    for t, many in table.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        df[t] = many
    weight = weights(df, n_docs)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = held.value.queries
        best = [Best(k) for _ in queries]
        factor = np.zeros(len(weight), np.int64)
        for shard in shards(batches, n_docs, length, weight):
            for (_, own, many), found in zip(queries, best, strict=True):
                factor[own] = weight[own] * many
                shard.search(own, factor, found)
                factor[own] = 0
        for (item, _, _), found in zip(queries, best, strict=True):
            if len(found.score):
                cols = [pa.array([item] * len(found.score), pa.int32()), pa.array(found.doc, mask=found.none), pa.array(found.score)]
                yield pa.RecordBatch.from_arrays(cols, names=["item", "doc_id", "score"])

    out = stored(table.mapInArrow(search, _BEST), "lexical-best")
    discard(table)
    return out


def search(docs: DataFrame, benchmark: DataFrame, k: int = K) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents with the highest score above 0 of every item.

    Rows of ``benchmark`` equal in item_id and text are one item; rows that share an id
    and differ in text are items of their own. Every row of ``docs`` is a document of its own,
    repeated rows too. A NULL or empty text, on either side, has no terms and no
    results; a NULL doc_id comes last among equal scores, a NULL item_id is kept. Long texts are read
    as a whole. Extra columns are not read. Without documents or items there are no rows.
    """
    spark = docs.sparkSession
    rows = benchmark.select("item_id", "text").where("text <> ''").distinct()
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // ITEM_BYTES))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)).cast("int"))
    in_part = Window.partitionBy("part").orderBy(F.col("item_id"), F.col("text"))
    rows = stored(rows.withColumn("item", F.row_number().over(in_part)), "lexical-items")
    found = spark.createDataFrame([], "part int, item int, doc_id long, score long")
    for part in range(parts):
        own = [(r[0], bytes(r[1])) for r in rows.where(F.col("part") == part).select("item", F.col("text").cast("binary")).collect()]
        met = _search_part(docs, own, k)
        if met is not None:
            found = found.union(met.select(F.lit(part).alias("part"), "item", "doc_id", "score"))
    by_item = Window.partitionBy("part", "item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(by_item)).where(F.col("rank") <= k)
    return ranked.join(rows.drop("text"), ["part", "item"]).select("item_id", "rank", "doc_id", "score")
