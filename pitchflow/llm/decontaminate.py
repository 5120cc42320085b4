"""Benchmark decontamination by SimHash of item-sized windows (operator 3).

DataFrame functions only. A window of a document has as many words as the item it is
compared with. Similarity is the weighted Jaccard similarity of five-word
shingles, a shingle's weight being its number of occurrences; 0.8 or more is a
hit.

1. Seeds: such a window shares at least 0.8 of the item's shingles, so windows
   without shared shingles need no fingerprint. Every shingle of every
   document is looked up among the items' shingles; documents that share
   enough with an item give every window that holds enough shared shingles
   to be a hit, wherever it starts.
2. Each window gets a 64-bit SimHash. Eight blocks of eight bits index the items'
   fingerprints with all values within two bits of a block; fingerprints
   within 23 bits agree with some block to two bits, so none is missed.
3. The exact similarity of every pair found decides.

The items' shingles are broadcast while they are at most ``BROADCAST_ROWS`` rows,
counted first; beyond that the same join shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchflow.llm.common import stored

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 23
_BLOCKS = 8
#: Rows of a few dozen bytes each that are broadcast at most.
BROADCAST_ROWS = 500_000


def words(text: str = "text") -> Column:
    """Lower-case runs of letters, marks and digits, in order; none for a NULL text."""
    parts = F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{M}\p{N}]+")
    return F.array_remove(parts, "")


def _hash(array: str, at: Column, shingle: int) -> Column:
    return F.xxhash64(*[F.get(F.col(array), at + i) for i in range(shingle)])


def _shingles(array: str, start: Column, count: Column, shingle: int) -> Column:
    """Hashes of ``count`` shingles from word ``start`` (from 0) on."""
    return F.when(count > 0, F.transform(F.sequence(start, start + count - 1), lambda i: _hash(array, i, shingle))).otherwise(F.array().cast("array<bigint>"))


def simhash(hashes: str) -> Column:
    """64-bit SimHash of an array of hashes: a bit is 1 if it is in over half of them."""
    return F.expr(
        f"aggregate(sequence(0, 63), 0L, (f, b) -> f | if(2 * aggregate({hashes}, 0, (n, h) -> n + cast(shiftrightunsigned(h, b) & 1L as int)) > size({hashes}), shiftleft(1L, b), 0L))"
    )


def similarity(a: str, b: str) -> Column:
    """Weighted Jaccard similarity of two arrays of hashes, repeats counted."""
    common = f"aggregate(array_intersect({a}, {b}), 0, (n, x) -> n + least(size(filter({a}, y -> y = x)), size(filter({b}, y -> y = x))))"
    return F.expr(f"{common} / (size({a}) + size({b}) - {common})")


def items(benchmark: DataFrame) -> DataFrame:
    """(item_id, n, shingle, hashes, fp) of the items that have a word; ``shingle`` is 5,
    or the item's number of words if that is less. Repeated rows count once."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), words().alias("w")).where(F.size("w") > 0).distinct()
    rows = rows.withColumn("n", F.size("w")).withColumn("shingle", F.least("n", F.lit(SHINGLE)))
    hashes = None
    for k in range(SHINGLE, 0, -1):
        own = _shingles("w", F.lit(0), F.col("n") - k + 1, k)
        hashes = own if hashes is None else F.when(F.col("shingle") == k, own).otherwise(hashes)
    rows = rows.withColumn("hashes", hashes).withColumn("fp", simhash("hashes"))
    return rows.select("item_id", "n", "shingle", "hashes", "fp")


def _near_blocks(fp: str) -> Column:
    """(block, value) pairs of an item's fingerprint: each block's value, and all values one or two bits from it."""
    masks = [0, *[1 << a for a in range(8)], *[1 << a | 1 << b for a in range(8) for b in range(a)]]
    return F.expr(
        f"flatten(transform(sequence(0, {_BLOCKS - 1}), b -> transform(array({', '.join(map(str, masks))}), m -> struct(b AS block, cast(shiftrightunsigned({fp}, 8 * b) & 255L as int) ^ m AS value))))"
    )


def _blocks(fp: str) -> Column:
    return F.expr(f"transform(sequence(0, {_BLOCKS - 1}), b -> struct(b AS block, cast(shiftrightunsigned({fp}, 8 * b) & 255L as int) AS value))")


def _starts(least: float) -> Column:
    """All starts of windows of ``n`` words that hold enough of the sorted ``places`` of shared
    shingles for a similarity of ``least``, each once.

    What a window and an item have in common is at most the number of such places in it. A
    window with ``m`` places or more, the first of them number ``i``, starts behind place
    ``i - 1``, not behind place ``i``, and reaches to place ``i + m - 1``.
    """
    total = "(n - shingle + 1)"
    # A text shorter than the item has one window, and it may hold fewer shingles than the item.
    m = f"greatest(1, cast(ceil(if(size(w) >= n, {2 * least / (1 + least)!r}D, {least!r}D) * {total} - 1e-9D) as int))"
    low = f"greatest(0, if(i > 0, places[greatest(i - 1, 0)] + 1, 0), places[i + {m} - 1] - {total} + 1)"
    return F.expr(
        f"flatten(transform(sequence(0, size(places) - 1), i -> if(i + {m} > size(places) or {low} > places[i], cast(array() as array<int>), sequence({low}, places[i]))))"
    )


def hits(docs: DataFrame, benchmark: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """(doc_id, text_hash, item_id, similarity, start_word, n_words, distance): the best
    window of each document and item with similarity ``least`` or more.

    ``text_hash`` (xxhash64 of the text) tells apart rows with the same doc_id;
    equal rows give one hit. Rows without words, and items without words, hit
    nothing; a NULL doc_id or item_id is kept as NULL. Items with the same
    item_id and other words are compared one by one. Extra columns are not read.
    """
    found = stored(items(benchmark), "decontaminate-items")
    seeds = found.select("item_id", "n", "shingle", F.size("hashes").alias("total"), F.xxhash64("hashes").alias("which"), F.explode(F.array_distinct("hashes")).alias("h"))
    small = found.agg(F.sum(F.size("hashes"))).first()[0] or 0
    lengths = [r[0] for r in found.select("shingle").distinct().collect()]
    look_up = F.broadcast(seeds) if small <= BROADCAST_ROWS else seeds
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), words().alias("w"))
    pairs = None
    for k in lengths or [SHINGLE]:
        last = F.size("w") - k
        at = texts.where(last >= 0).select("doc_id", "text_hash", "w", F.explode(F.sequence(F.lit(0), last)).alias("p"))
        at = at.select("doc_id", "text_hash", "p", _hash("w", F.col("p"), k).alias("h"))
        own = at.join(look_up.where(F.col("shingle") == k), "h").select("doc_id", "text_hash", "item_id", "which", "total", "p")
        pairs = own if pairs is None else pairs.union(own)
    key = ["doc_id", "text_hash", "item_id", "which"]
    enough = pairs.groupBy(*key, "total").agg(F.sort_array(F.collect_set("p")).alias("places"))
    enough = enough.where(F.size("places") >= F.lit(least) * F.col("total")).select(*key, "places")
    enough = stored(enough, "decontaminate-seeds")

    # Windows of the texts that share enough with an item; keys are joined null-safely.
    left, right = texts.alias("t"), enough.alias("e")
    windows = left.join(right, F.col("t.doc_id").eqNullSafe(F.col("e.doc_id")) & (F.col("t.text_hash") == F.col("e.text_hash")))
    windows = windows.select("t.doc_id", "t.text_hash", "w", F.col("e.which").alias("seed"), "places")
    sizes = found.select(F.xxhash64("hashes").alias("seed"), "n", "shingle").distinct()
    windows = windows.join(F.broadcast(sizes) if small <= BROADCAST_ROWS else sizes, "seed")
    windows = windows.select("*", F.explode(_starts(least)).alias("start"))
    windows = windows.withColumn("start", F.greatest(F.least("start", F.size("w") - F.col("n")), F.lit(0))).withColumn("held", F.least("n", F.size("w") - F.col("start")))
    hashes = None
    for k in lengths or [SHINGLE]:
        own = _shingles("w", F.col("start"), F.col("held") - k + 1, k)
        hashes = own if hashes is None else F.when(F.col("shingle") == k, own).otherwise(hashes)
    windows = windows.withColumn("hashes", hashes).select("doc_id", "text_hash", "n", "start", "hashes").distinct().withColumn("fp", simhash("hashes"))

    index = found.select("item_id", "n", F.col("fp").alias("item_fp"), F.col("hashes").alias("item_hashes"), F.explode(_near_blocks("fp")).alias("x"))
    index = index.select("item_id", "n", "item_fp", "item_hashes", "x.block", "x.value")
    probes = windows.select("*", F.explode(_blocks("fp")).alias("x")).select("doc_id", "text_hash", "n", "start", "hashes", "fp", "x.block", "x.value")
    distance = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))
    # A pair met in several blocks is taken in the first in which it agrees to two bits.
    first = F.expr(f"array_min(filter(sequence(0, {_BLOCKS - 1}), b -> bit_count(shiftrightunsigned(fp ^ item_fp, 8 * b) & 255L) <= 2))")
    met = probes.join(F.broadcast(index) if small <= BROADCAST_ROWS else index, ["n", "block", "value"])
    met = met.where((distance <= RADIUS) & (F.col("block") == first)).withColumn("distance", distance)
    met = met.withColumn("similarity", similarity("hashes", "item_hashes")).where(F.col("similarity") >= least)
    best = met.groupBy("doc_id", "text_hash", "item_id").agg(F.max(F.struct("similarity", (-F.col("start")).alias("place"), (-F.col("distance")).alias("near"), "n")).alias("x"))
    return best.select(
        "doc_id", "text_hash", "item_id", "x.similarity", (-F.col("x.place")).alias("start_word"), F.col("x.n").alias("n_words"), (-F.col("x.near")).alias("distance")
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item."""
    gone = stored(hits(docs, benchmark, least).select("doc_id", "text_hash").distinct(), "decontaminate-hits").alias("g")
    rows = docs.alias("d")
    return rows.join(gone, F.col("d.doc_id").cast("long").eqNullSafe(F.col("g.doc_id")) & (F.xxhash64("d.text") == F.col("g.text_hash")), "left_anti")
