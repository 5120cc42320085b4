"""Packing into length buckets of least padding (operator 5).

The global histogram of lengths gives, by dynamic programming, the boundaries of
``buckets`` length buckets for which padding every document to its bucket's
boundary adds the fewest tokens. Inside a bucket documents are numbered without
gaps, and each run of ``budget // boundary`` of them is one batch.

All lengths are told apart, so the boundaries are optimal for any lengths; the histogram has
a row for each different length, however many documents there are.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchflow.llm.common import in_order, numbered, stored

BUCKETS = 16
TOKEN_BUDGET = 65_536


def word_tokens(text: str = "text") -> Column:
    """Words between ASCII white space, and one end mark; 1 for a NULL or empty text."""
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long") + 1


def boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds, ascending, of at most ``buckets`` buckets with the least total padding.

    ``lengths`` ascending. least[j] is the padding of the first j lengths; the
    best last bucket (i, j] minimises least[i] + L[j] * (C[j] - C[i]) less a
    term of j alone, which is a lower envelope of lines with falling slopes
    -C[i], asked at rising L[j].
    """
    size = [int(x) for x in lengths]
    docs, mass = [0], [0]
    for n, c in zip(size, counts, strict=True):
        docs.append(docs[-1] + int(c))
        mass.append(mass[-1] + n * int(c))
    m = len(size)
    least = [0] + [None] * m
    came: list[list[int]] = []
    for _ in range(min(buckets, m)):
        now, back = [0] + [None] * m, [0] * (m + 1)
        hull: list[tuple[int, int, int]] = []  # slope, offset, i
        head = 0
        for j in range(1, m + 1):
            i = j - 1
            if least[i] is not None:
                line = (-docs[i], least[i] + mass[i], i)
                while len(hull) - head >= 2 and (line[1] - hull[-2][1]) * (hull[-2][0] - hull[-1][0]) <= (hull[-1][1] - hull[-2][1]) * (hull[-2][0] - line[0]):
                    hull.pop()
                hull.append(line)
            x = size[j - 1]
            while len(hull) - head >= 2 and hull[head + 1][0] * x + hull[head + 1][1] <= hull[head][0] * x + hull[head][1]:
                head += 1
            if len(hull) > head:
                now[j] = hull[head][0] * x + hull[head][1] + x * docs[j] - mass[j]
                back[j] = hull[head][2]
        came.append(back)
        least = now
        if least[m] == 0:
            break
    out, j = [], m
    for back in reversed(came):
        if j == 0:
            break
        out.append(size[j - 1])
        j = back[j]
    return out[::-1]


def pack(docs: DataFrame, tokens: Column | None = None, buckets: int = BUCKETS, budget: int = TOKEN_BUDGET) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, boundary, padding, batch, slot.

    ``boundary`` names the bucket, (boundary, batch) the batch, ``slot`` the place
    in it. A document longer than ``budget`` has a batch of its own. Every row is
    packed, also with a NULL or empty text (one token, the end mark), a NULL or
    repeated doc_id; an empty table gives an empty result. Other columns are not
    read.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (word_tokens() if tokens is None else tokens).cast("long").alias("n_tokens"),
        F.xxhash64("doc_id", "text").alias("deal"),
    )
    rows = stored(rows, "packing-lengths")
    histogram = rows.groupBy("n_tokens").agg(F.count("*").alias("docs")).orderBy("n_tokens").toPandas()
    bounds = boundaries(histogram["n_tokens"].to_numpy(), histogram["docs"].to_numpy(), buckets)
    boundary = F.lit(None).cast("long")
    for b in reversed(bounds):
        boundary = F.when(F.col("n_tokens") <= b, F.lit(b)).otherwise(boundary)
    placed = in_order(rows.withColumn("boundary", boundary), [F.col(c) for c in ("boundary", "deal", "doc_id", "n_tokens")], "packing-order")
    numbered_rows = numbered(placed, "boundary", "packing-runs")
    each = F.greatest(F.floor(F.lit(budget) / F.col("boundary")), F.lit(1))
    return numbered_rows.select(
        "doc_id",
        "n_tokens",
        "boundary",
        (F.col("boundary") - F.col("n_tokens")).alias("padding"),
        F.floor(F.col("idx") / each).cast("long").alias("batch"),
        (F.col("idx") % each).cast("long").alias("slot"),
    )
