"""Merkle manifest of a dataset by slot pivots (operator 12).

Every row is a leaf, hashed over its fields. The leaves of a source, in the order of their
ids, are the lowest level of a tree with ``FANOUT`` children a node; the tops of these trees, in
the order of the sources, are the leaves of the tree of the dataset.

A level is one aggregation: children are grouped by parent, and a conditional aggregate
for each slot spreads them into ``FANOUT`` columns. The columns joined are what
the parent hashes; the columns joined without a child's own are its siblings. Proofs
go down the tree: a parent's row has its own path, and gives each child the
siblings in front of it.

Groups are numbered without bringing one to a task (:func:`common.numbered`), and a parent has
``FANOUT`` children however many rows a source has. Paths move with the parents, a sixteenth of
the rows; a leaf's own siblings are only joined to it at the end.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchflow.llm.common import in_order, numbered, stored

FANOUT = 16
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
_SLOTS = [f"c{k}" for k in range(FANOUT)]
_PATH = "array<struct<left:string,right:string>>"


def sha256(text: Column) -> Column:
    """Lower-case hex SHA-256 of the text's UTF-8 bytes."""
    return F.sha2(text, 256)


def field_text(value: Column) -> Column:
    """``-`` for NULL, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(fields: list[Column]) -> Column:
    return sha256(F.concat(*[field_text(f) for f in fields]))


@dataclass
class Tree:
    """``levels``: of each level its parents (g, parent, n, c0 ...), where ``n`` counts the group's
    children on that level. ``tops``: (g, h), the last node of each group."""

    levels: list[DataFrame]
    tops: DataFrame


def build(nodes: DataFrame, label: str) -> Tree:
    """The trees over ``nodes`` (g, idx, n, h): one for each group ``g``, whose ``n`` nodes
    have the numbers ``idx`` from 0 on."""
    levels, tops = [], nodes.where("n = 1").select("g", "h")
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        spread = [F.expr(f"max(if(idx % {FANOUT} = {k}, h, NULL)) AS {c}") for k, c in enumerate(_SLOTS)]
        parents = nodes.where("n > 1").groupBy("g", F.floor(F.col("idx") / FANOUT).alias("parent"), "n").agg(*spread)
        levels.append(stored(parents, f"{label}-{len(levels)}"))
        nodes = levels[-1].select(
            "g", F.col("parent").alias("idx"), F.ceil(F.col("n") / FANOUT).alias("n"), sha256(F.concat_ws("", *_SLOTS)).alias("h")
        )
        tops = tops.union(nodes.where("n = 1").select("g", "h"))
        most = -(-most // FANOUT)
    return Tree(levels, tops)


def _step(own: str) -> Column:
    """Siblings of the child in slot ``own``: the columns to its left, and those to its right, joined.
    A slot without a child is NULL and adds nothing."""
    left = ", ".join(f"if({own} > {k}, {c}, NULL)" for k, c in enumerate(_SLOTS))
    right = ", ".join(f"if({own} < {k}, {c}, NULL)" for k, c in enumerate(_SLOTS))
    return F.expr(f"struct(concat_ws('', {left}) AS left, concat_ws('', {right}) AS right)")


def parents_with_paths(tree: Tree, tops: DataFrame) -> DataFrame:
    """The lowest parents with ``path``, the steps from the parent up, given the ``path`` of each
    group's top in ``tops`` (g, path and any more columns, which are passed down)."""
    more = [c for c in tops.columns if c != "g"]
    found = None
    for parents in reversed(tree.levels):
        last = parents.where(F.col("n") <= FANOUT).join(tops, "g")
        if found is None:
            found = last
            continue
        children = F.least(F.lit(FANOUT), F.col("n") - F.col("parent") * FANOUT)
        each = found.withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), children - 1)))
        passed = [F.concat(F.array(_step("slot")), "path").alias("path") if c == "path" else F.col(c) for c in more]
        down = each.select("g", (F.col("parent") * FANOUT + F.col("slot")).alias("parent"), *passed)
        found = parents.where(F.col("n") > FANOUT).join(down, ["g", "parent"]).select(*last.columns).union(last)
    return found


def paths(nodes: DataFrame, tree: Tree, tops: DataFrame) -> DataFrame:
    """``nodes`` with the ``path`` of each: the siblings (left, right) on every level up to what ``tops`` has a path for."""
    alone = nodes.where("n = 1").join(tops, "g")
    if not tree.levels:
        return alone
    step = _step(f"idx % {FANOUT}")
    below = nodes.where("n > 1").withColumn("parent", F.floor(F.col("idx") / FANOUT))
    met = below.join(parents_with_paths(tree, tops).drop("n"), ["g", "parent"])
    return met.withColumn("path", F.concat(F.array(step), "path")).select(*alone.columns).union(alone)


def folded(leaf: Column, path: str = "path") -> Column:
    """The root that a leaf and its siblings give, level by level."""
    return F.aggregate(F.col(path), leaf, lambda h, s: sha256(F.concat(s["left"], h, s["right"])))


def proof_hash(path: str = "path") -> Column:
    """One hash over all siblings, from the leaf's to the root's, left to right."""
    return sha256(F.array_join(F.transform(F.col(path), lambda s: F.concat(s["left"], s["right"])), ""))


def manifest(docs: DataFrame, given: Column | None = None) -> DataFrame:
    """(doc_id, source, leaf, given_leaf, subroot, root, path): the place of every row in the tree of ``docs``.

    ``given`` is the text that a row is checked with, by default its own; ``given_leaf`` is its leaf.

    A NULL field is hashed as ``-``, unlike an empty text (``0:``); rows with a NULL
    id come first in their source, rows with a NULL source first of all. Repeated rows are leaves of their
    own; rows that share an id go by their leaf. A text of any length is hashed as a
    whole. Extra columns are not read. An empty table has no rows and no root.
    """
    text = F.col("text") if given is None else given
    rows = docs.select(
        F.col("doc_id"), F.col("source"), field_text(F.col("source")).alias("g"),
        leaf_hash([F.col(f) for f in FIELDS]).alias("leaf"),
        leaf_hash([*[F.col(f) for f in FIELDS[:-1]], text]).alias("given_leaf"),
    )
    placed = in_order(rows, [F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("leaf")], "merkle-leaves")
    leaves = stored(numbered(placed, "g", "merkle-runs"), "merkle-numbered")
    own = build(leaves.select("g", "idx", "n", F.col("leaf").alias("h")), "merkle-source")
    named = leaves.where("idx = 0").select("g", "source")
    subroots = named.join(own.tops, "g").select("source", F.lit("").alias("g"), F.col("g").alias("of"), "h")
    subroots = stored(numbered(in_order(subroots, [F.col("source").asc_nulls_first()], "merkle-subroots"), "g", "merkle-subroot-runs"), "merkle-subroot-numbers")
    whole = build(subroots.select("g", "idx", "n", "h"), "merkle-root")
    root = whole.tops.select(F.lit("").alias("g"), F.array().cast(_PATH).alias("path"), F.col("h").alias("root"))
    tops = paths(subroots, whole, root).select(F.col("of").alias("g"), "path", F.col("h").alias("subroot"), "root")
    found = paths(leaves, own, stored(tops, "merkle-tops"))
    return found.select("doc_id", "source", "leaf", "given_leaf", "subroot", "root", "path")


def lower_ascii(text: str = "text") -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.col(text), upper, upper.lower())


def checked(docs: DataFrame, given: Column | None = None) -> DataFrame:
    """The manifest's digests of every row, and whether the row as ``given`` still leads to the root."""
    found = manifest(docs, given).select(
        "doc_id", "leaf", "subroot", "root", proof_hash().alias("proof_sha256"), folded(F.col("given_leaf")).alias("folded_root")
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def tampered(every: int = 5) -> Column:
    """The text, its letters A-Z lowered in the rows whose id's crc32 ``every`` divides; a NULL id is left alone."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0
    return F.when(hit, lower_ascii()).otherwise(F.col("text"))
