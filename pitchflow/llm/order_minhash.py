"""Document fingerprints by Order MinHash (operator 11).

DataFrame functions only. A text is cut into runs of up to ``TOKEN`` characters that are
no white space; ``KMER`` runs in a row are a k-mer, and the ``o``-th occurrence of a k-mer in the text is told
apart from its others. Every numbered k-mer has a place on a ring, its MD5 hash.
A signature has ``COMPONENTS`` components, each with a mark of its own on the ring, all equally far
apart: the component's permutation of the k-mers is their order on the ring from its mark on. Its
minimal ``PICKED`` k-mers are put back into the order that they have in the text and hashed as a tuple.

Two texts share a component if they have the same minimal k-mers in the same order, so the
share of equal components falls with every edit, moved passages included, where MinHash
sees only which k-mers there are. The ring costs one hash a k-mer, whatever the number of components.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchflow.llm.common import block_of, in_order

TOKEN = 16
KMER = 3
PICKED = 2
COMPONENTS = 64
#: Hex digits of a component.
DIGITS = 8
_SPACE = r"\x20\x09-\x0D"


def with_fingerprint(rows: DataFrame, text: str, name: str) -> DataFrame:
    """``rows`` with the fingerprint (binary) of the column ``text`` as the column ``name``.

    A text of fewer than ``KMER`` runs has one k-mer, all of it; a text without any, NULL
    included, has the hash of nothing in each component. Where a text has fewer
    k-mers than are picked, the ring goes round to the first again.
    """
    kept = rows.columns
    runs = rows.withColumn("_run", F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(f"[^{_SPACE}]{{1,{TOKEN}}}"), F.lit(0)))

    def kmer(at: str, *more: str) -> str:
        own = [f"get(_run, {at} + {k})" for k in range(KMER)] + list(more)
        whole = ", ' ', ".join(own)
        return f"if(size(_run) >= {KMER}, concat({whole}), concat_ws(' ', {', '.join(own)}))"

    # Every k-mer as if it were the first of its kind; equal ones then stand together, in the order of the text.
    alike = runs.withColumn(
        "_alike",
        F.expr(f"""if(size(_run) = 0, array(), sort_array(transform(sequence(0, greatest(size(_run) - {KMER}, 0)),
               i -> struct(md5({kmer('i', "'0'")}) AS place, i AS at))))"""),
    )
    # Powers of two up to the number of k-mers, descending, for binary search.
    steps = alike.withColumn("_step", F.expr("transform(sequence(cast(log2(size(_alike) + 1) AS int), 0, -1), t -> shiftleft(1, t))"))
    again = "i > 0 AND get(_alike, i - 1).place = x.place"
    before = "aggregate(_step, 0, (o, s) -> if(i >= o + s AND get(_alike, i - o - s).place = x.place, o + s, o))"
    moved = f"struct(md5({kmer('x.at', f'cast({before} AS string)')}) AS place, x.at AS at)"
    later = steps.withColumn("_later", F.expr(f"filter(transform(_alike, (x, i) -> if({again}, {moved}, NULL)), e -> e IS NOT NULL)"))
    ring = later.withColumn("_ring", F.expr(f"if(size(_later) = 0, _alike, sort_array(concat(filter(_alike, (x, i) -> NOT ({again})), _later)))"))
    marks = ", ".join(f"'{k * 256 // COMPONENTS:02x}'" for k in range(COMPONENTS))
    first = "aggregate(_step, 0, (n, s) -> if(n + s <= size(_ring) AND get(_ring, n + s - 1).place < m, n + s, n))"
    met = ring.withColumn("_first", F.expr(f"transform(array({marks}), m -> {first})"))
    picked = f"sort_array(transform(sequence(0, {PICKED - 1}), p -> get(_ring, (f + p) % size(_ring)).at))"
    component = f"substring(md5(array_join(transform({picked}, a -> {kmer('a')}), ' ')), 1, {DIGITS})"
    nothing = f"repeat(substring(md5(''), 1, {DIGITS}), {COMPONENTS})"
    found = F.expr(f"unhex(if(size(_ring) = 0, {nothing}, array_join(transform(_first, f -> {component}), '')))")
    return met.select(*[F.col(c) for c in kept], found.alias(name))


def fingerprint_text(fingerprint: str) -> Column:
    """Lower-case hex digits of a fingerprint."""
    return F.lower(F.hex(fingerprint))


def likeness(a: str, b: str) -> Column:
    """Share of equal components of two fingerprints, 0 to 1."""
    parts = [f"regexp_extract_all(hex({c}), '.{{{DIGITS}}}', 0)" for c in (a, b)]
    return F.expr(f"size(filter(zip_with({parts[0]}, {parts[1]}, (x, y) -> x = y), e -> e)) / {COMPONENTS}D")


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, fingerprint, next_text, next_fingerprint): every row with the next, by descending id; the first follows the last.

    The rows are dealt to blocks by range and sorted; the first row of each block is also given to the
    block before, so that each block finds all its neighbours alone.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = in_order(rows, [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")], "omh-order").withColumn("block", block_of())
    blocks = [r[0] for r in rows.where(F.col("at") == F.shiftleft("block", 33)).select("block").orderBy("block").collect()]
    before = docs.sparkSession.createDataFrame(list(zip(blocks, [*blocks[-1:], *blocks[:-1]])), "block long, before long")
    known = with_fingerprint(rows, "text", "fingerprint").join(F.broadcast(before), "block")
    first = F.col("at") == F.shiftleft("block", 33)
    own, guest = F.struct(F.col("block").alias("block"), F.lit(0).alias("guest")), F.struct(F.col("before").alias("block"), F.lit(1).alias("guest"))
    dealt = known.select("doc_id", "text", "fingerprint", "at", F.inline(F.when(first, F.array(own, guest)).otherwise(F.array(own))))
    following = Window.partitionBy("block").orderBy("guest", "at")
    met = dealt.withColumns({f"next_{c}": F.lead(c).over(following) for c in ("text", "fingerprint")})
    return met.where("guest = 0").select("doc_id", "text", "fingerprint", "next_text", "next_fingerprint")


def edits(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row.

    The edited text has the first half of the text and the beginning of the next document's text, which is
    as long as what it replaces or all there is. A NULL text is empty. Rows that
    share an id go by their text's hash; repeated rows follow each other. A NULL id comes last. Texts are
    taken whole, whatever their length. Extra columns are not read. An empty table gives no rows.
    """
    half = F.floor(F.char_length("text") / 2).cast("int")
    head = F.substring(F.col("text"), F.lit(1), F.char_length("text") - half)
    rows = with_next(docs).withColumn("edited", F.concat(head, F.substring(F.col("next_text"), F.lit(1), half)))
    rows = with_fingerprint(rows.drop("next_text"), "edited", "edited_fingerprint")
    return rows.select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint_text("fingerprint").alias("fingerprint"), fingerprint_text("edited_fingerprint").alias("edited_fingerprint"),
        likeness("fingerprint", "edited_fingerprint").alias("near_edited"), likeness("fingerprint", "next_fingerprint").alias("near_next"),
    )
