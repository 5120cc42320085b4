"""Removal of repeated byte strings by suffix arrays (operator 4).

A byte goes if a string of ``length`` bytes that covers it also starts in a document
with a smaller doc_id. Documents are held in shards of a few MB.

1. Copies. A text equal to that of a smaller doc_id goes whole if it is long enough;
   only the others are looked at further.
2. Sieve. Of all ``length``-byte strings that hold a given ``_GRAM``-byte string,
   equal ones choose the same such string, the one with the smallest hash, as
   their anchor. Each shard sends its sorted anchor hashes, cut by hash into
   buckets; a bucket merges the shards' sorted runs by binary search and tells
   each shard which of its anchors another document has as well.
3. Shard suffix arrays. Only text around such anchors can repeat. Each shard builds
   the suffix array of this text by Larsson-Sadakane refinement; its ranks
   tell equal surroundings, and each different surrounding of an anchor is
   sent once, with the smallest doc_id that has it.
4. Merge. An anchor's surroundings from all shards meet in its bucket. Where they
   differ, a suffix array over them and its common prefixes (Kasai) of
   ``length`` or more give the classes of equal strings; a class's smallest
   doc_id goes back to every shard that asked.
5. Each shard marks the strings whose smallest doc_id is smaller than its own
   document's, and cuts them out.

A step's result is a written table. What a hot passage sends is one row entry per
shard and different surrounding, however many documents hold it.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchflow.functions.names import col
from pitchflow.llm.common import discard, document_shards, stored
from pitchflow.llm.suffixes import common_prefixes, merge_sorted, suffix_array, words_at

LENGTH = 50
#: Shorter grams give fewer anchors, but more that unrelated documents share by chance.
_GRAM = 32
#: Bytes of anchor hashes, or of surroundings, that one merging task gets on average.
BUCKET_BYTES = 12 << 20
#: A NULL doc_id ranks behind all others.
_NO_ID = np.iinfo(np.int64).max


def _mixed(x: np.ndarray, by: int) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(by)
    return x ^ (x >> np.uint64(29))


def _slide(x: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` (minimum or maximum) of every ``width`` neighbours."""
    done = 1
    while done * 2 <= width:
        x = best(x[:-done], x[done:])
        done *= 2
    return x if done == width else best(x[: len(x) - (width - done)], x[width - done :])


def anchors(text: np.ndarray, begin: np.ndarray, end: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, document, hash) of the anchors of the documents [begin, end) in ``text``.

    Every string of ``length`` bytes in a document holds an anchor that depends on
    nothing but the string.
    """
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if len(text) < length:
        return none
    w = words_at(text)
    grams = len(text) - _GRAM + 1
    with np.errstate(over="ignore"):
        h = w[:grams] * np.uint64(0x9E3779B97F4A7C15)
        h += w[8 : grams + 8] * np.uint64(0xC2B2AE3D27D4EB4F)
        h += w[16 : grams + 16] * np.uint64(0x165667B19E3779F9)
        h += w[24 : grams + 24] * np.uint64(0xD1B54A32D192ED03)
        del w
        h = _mixed(h, 0xD6E8FEB86659FD93)
    width = length - _GRAM + 1
    rank = (h >> np.uint64(32)).astype(np.uint32)  # equal ranks of unequal strings make both anchors
    low = _slide(rank, width, np.minimum)
    edge = np.zeros(width - 1, np.uint32)
    chosen = np.flatnonzero(_slide(np.concatenate((edge, low, edge)), width, np.maximum) == rank)
    doc = np.searchsorted(begin, chosen, side="right") - 1
    inside = (chosen + _GRAM <= end[doc]) & (end[doc] - begin[doc] >= length)
    chosen, doc = chosen[inside], doc[inside]
    with np.errstate(over="ignore"):
        return chosen, doc, _mixed(h[chosen], 0xFF51AFD7ED558CCD)


def _shard_arrays(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, begin, end, doc_id) of a shard's rows."""
    texts = table.column("text").to_pylist()
    end = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
    ids = pc.fill_null(table.column("doc_id"), int(_NO_ID)).to_numpy()
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate(([0], end[:-1])), end, ids


def _spans_of(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenation of starts[i], starts[i] + 1, ... (counts[i] numbers)."""
    total = int(counts.sum())
    return np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(total)


def _by_bucket(keys: np.ndarray, buckets: int):
    """(bucket, indices of its keys) for ascending ``keys``; their order stays."""
    if not len(keys):
        return
    bucket = ((keys >> np.uint64(20)) % np.uint64(buckets)).astype(np.uint16 if buckets < 1 << 16 else np.uint64)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    at = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    for b, part in zip(bucket[at].tolist(), np.split(order, at[1:]), strict=True):
        yield b, part


def sieve(shards: DataFrame, length: int, buckets: int) -> DataFrame:
    """(shard, keys): for each shard, ascending hashes of its anchors that another document has as well."""

    def run(batches):
        for b in batches:
            t = pa.Table.from_batches([b])
            shard = t.column("shard").to_numpy()
            for at in np.unique(shard):
                text, begin, end, ids = _shard_arrays(t.filter(pa.array(shard == at)))
                _, doc, key = anchors(text, begin, end, length)
                keys, first, back = np.unique(key, return_index=True, return_inverse=True)
                several = np.zeros(len(keys), bool)
                several[back[ids[doc] != ids[doc[first]][back]]] = True
                for bucket, part in _by_bucket(keys, buckets):
                    yield pa.RecordBatch.from_pydict(
                        {"bucket": [bucket], "shard": [int(at)], "keys": [keys[part].tobytes()], "several": [keys[part][several[part]].tobytes()]}
                    )

    def merge(table: pa.Table) -> pa.Table:
        shard, blobs = table.column("shard").to_pylist(), [np.frombuffer(x, np.uint64) for x in table.column("keys").to_pylist()]
        runs, shared = list(blobs), [np.frombuffer(x, np.uint64) for x in table.column("several").to_pylist()]
        while len(runs) > 1:  # pairs of runs, then pairs of the merged ones
            merged = [merge_sorted(x, y) for x, y in zip(runs[::2], runs[1::2], strict=False)]
            shared += [both for _, both in merged]
            runs = [x for x, _ in merged] + runs[len(merged) * 2 :]
        hot = np.sort(np.concatenate(shared))
        hot = hot[np.flatnonzero(np.diff(hot, prepend=~hot[:1]))]
        out = {"shard": [], "keys": []}
        for s, own in zip(shard, blobs, strict=True):
            _, both = merge_sorted(hot, own)
            if len(both):
                out["shard"].append(s)
                out["keys"].append(both.tobytes())
        return pa.table({"shard": pa.array(out["shard"], pa.int64()), "keys": pa.array(out["keys"], pa.binary())})

    rows = shards.select("shard", "doc_id", "text").mapInArrow(run, "bucket long, shard long, keys binary, several binary")
    return rows.groupBy("bucket").applyInArrow(merge, "shard long, keys binary")


_ASKED = "bucket long, shard long, keys binary, ids binary, numbers binary, sizes binary, offsets binary, texts binary"


def ask(shards: DataFrame, shared: DataFrame, length: int, buckets: int) -> DataFrame:
    """Surroundings of the shared anchors, by bucket, and the shard's own notes (bucket -1).

    A surrounding is the bytes of all strings of ``length`` bytes that hold the anchor,
    as far as the document goes. Its number counts the shard's different ones.
    The notes list each shared anchor's start of surrounding, document and number.
    """

    def run(docs: pa.Table, keys: pa.Table) -> pa.Table:
        if not len(docs) or not len(keys):
            return _table(_ASKED, [])
        at = docs.column("shard")[0].as_py()
        text, begin, end, ids = _shard_arrays(docs)
        wanted = np.sort(np.concatenate([np.frombuffer(x, np.uint64) for x in keys.column("keys").to_pylist()]))
        place, doc, key = anchors(text, begin, end, length)
        found = wanted[np.minimum(np.searchsorted(wanted, key), len(wanted) - 1)] == key
        place, doc, key = place[found], doc[found], key[found]
        left = np.maximum(place - (length - _GRAM), begin[doc])
        right = np.minimum(place + length, end[doc])
        # Suffix array of the text that surroundings cover; ranks of their first and last strings tell equal ones.
        cover = np.zeros(len(text) + 1, np.int32)
        np.add.at(cover, left, 1)
        np.add.at(cover, right, -1)
        kept = np.cumsum(cover[:-1]) > 0
        to = np.cumsum(kept) - 1
        _, rank = suffix_array(text[kept], length)
        what = (right - left, rank[to[left]] << 32 | rank[to[right - length]], key)
        order = np.lexsort(what)
        new = np.concatenate(([True], np.logical_or.reduce([x[order][1:] != x[order][:-1] for x in what])))
        first, number = order[new], np.empty(len(key), np.int64)
        number[order] = np.cumsum(new) - 1
        least = np.full(len(first), _NO_ID)
        np.minimum.at(least, number, ids[doc])
        rows = [(-1, at, b"", b"", number.astype(np.uint32).tobytes(), doc.astype(np.uint32).tobytes(), left.astype(np.uint32).tobytes(), b"")]
        size = (right - left)[first]
        for bucket, part in _by_bucket(key[first], buckets):
            own = first[part]
            rows.append(
                (
                    bucket,
                    at,
                    key[own].tobytes(),
                    least[part].tobytes(),
                    part.astype(np.uint32).tobytes(),
                    size[part].astype(np.uint8).tobytes(),
                    b"",
                    text[_spans_of(left[own], size[part])].tobytes(),
                )
            )
        return _table(_ASKED, rows)

    return shards.select("shard", "doc_id", "text").groupBy("shard").cogroup(shared.groupBy("shard")).applyInArrow(run, _ASKED)


def _table(schema: str, rows: list[tuple]) -> pa.Table:
    fields = [f.split() for f in schema.split(", ")]
    kinds = {"long": pa.int64(), "binary": pa.binary()}
    return pa.table({name: pa.array([r[i] for r in rows], kinds[kind]) for i, (name, kind) in enumerate(fields)})


_ANSWER = "shard long, numbers binary, low binary, high binary, ids binary"


def answer(asked: DataFrame, length: int) -> DataFrame:
    """For each shard: (surrounding's number, first and last string in it, smallest doc_id
    that has these strings), where that is smaller than the shard's own."""

    def run(table: pa.Table) -> pa.Table:
        n = [len(x) // 8 for x in table.column("keys").to_pylist()]

        def joined(name, kind):
            return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)

        key, ids, number, size, text = joined("keys", np.uint64), joined("ids", np.int64), joined("numbers", np.uint32), joined("sizes", np.uint8).astype(np.int64), joined("texts", np.uint8)
        shard = np.repeat(table.column("shard").to_numpy(), n)
        start = np.cumsum(size) - size
        # Shards' entries with the same anchor and bytes are one surrounding.
        digest = _text_hash(text, start, size)
        what = np.lexsort((digest, size, key))
        new = np.concatenate(([True], (np.diff(key[what]) != 0) | (np.diff(size[what]) != 0) | (np.diff(digest[what]) != 0)))
        group = np.empty(len(key), np.int64)
        group[what] = np.cumsum(new) - 1
        one = what[new]  # an entry of each different surrounding
        least = np.full(len(one), _NO_ID)
        np.minimum.at(least, group, ids)
        # An anchor with one surrounding needs no comparison; the others' strings are classed.
        keys, of, many = np.unique(key[one], return_inverse=True, return_counts=True)
        mixed = np.flatnonzero(many[of] > 1)
        strings = np.maximum(size[one] - length + 1, 0)
        owner = np.repeat(mixed, strings[mixed])
        best = least[owner]
        place = _spans_of(np.zeros(len(mixed), np.int64), strings[mixed])
        if len(mixed):
            own = text[_spans_of(start[one[mixed]], size[one[mixed]])]
            begin = np.cumsum(size[one[mixed]]) - size[one[mixed]]
            sa, _ = suffix_array(own, length)
            klass = np.empty(len(own), np.int64)
            klass[sa] = np.cumsum(common_prefixes(own, sa, length) < length)
            klass = klass[_spans_of(begin, strings[mixed])]
            low = np.full(len(own) + 1, _NO_ID)
            np.minimum.at(low, klass, best)
            best = low[klass]
        # Runs of strings with the same smallest doc_id, for every different surrounding.
        cut = np.concatenate(([True], (np.diff(owner) != 0) | (np.diff(best) != 0))) if len(owner) else np.zeros(0, bool)
        head = np.flatnonzero(cut)
        tail = np.concatenate((head[1:], [len(owner)])) - 1 if len(head) else head
        plain = np.flatnonzero(many[of] == 1)
        run_owner = np.concatenate((owner[head], plain))
        run_low, run_high = np.concatenate((place[head], np.zeros(len(plain), np.int64))), np.concatenate((place[tail], strings[plain] - 1))
        run_id = np.concatenate((best[head], least[plain]))
        order = np.argsort(run_owner, kind="stable")
        run_owner, run_low, run_high, run_id = run_owner[order], run_low[order], run_high[order], run_id[order]
        from_, to = np.searchsorted(run_owner, group), np.searchsorted(run_owner, group, side="right")
        pick = _spans_of(from_, to - from_)
        shard, number = np.repeat(shard, to - from_), np.repeat(number, to - from_)
        rows = []
        for s in np.unique(shard):
            m = shard == s
            p = pick[m]
            rows.append((int(s), number[m].tobytes(), run_low[p].astype(np.uint8).tobytes(), run_high[p].astype(np.uint8).tobytes(), run_id[p].tobytes()))
        return _table(_ANSWER, rows)

    return asked.where("bucket >= 0").groupBy("bucket").applyInArrow(run, _ANSWER)


def _text_hash(text: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte strings at ``start``, told apart together with ``size``."""
    w = words_at(np.concatenate((text, np.zeros(8, np.uint8))))
    h = np.zeros(len(start), np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, int(size.max(initial=0)), 8):
            left = size - at
            part = np.where(left > 0, w[np.minimum(start + at, len(w) - 1)], 0)
            part &= np.where(left >= 8, np.uint64(0xFFFFFFFFFFFFFFFF), ~(np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.clip(left, 0, 7).astype(np.uint64) * np.uint64(8))))
            h = _mixed(h * np.uint64(0x9E3779B97F4A7C15) + part + np.uint64(at), 0xC4CEB9FE1A85EC53)
    return h


def cut(shards: DataFrame, notes: DataFrame, answers: DataFrame, length: int, with_text: bool) -> DataFrame:
    """(doc_id, digest, n_removed, n_spans, kept_sha256[, kept]) of the documents that lose bytes."""
    schema = "doc_id long, digest binary, n_removed long, n_spans long, kept_sha256 string" + ", kept string" * with_text
    notes = notes.select("shard", F.col("numbers").alias("a"), F.col("sizes").alias("b"), F.col("offsets").alias("c"), F.lit(None).cast("binary").alias("d"))
    told = answers.select("shard", F.col("numbers").alias("a"), F.col("low").alias("b"), F.col("high").alias("c"), F.col("ids").alias("d"))
    both = notes.union(told)

    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        out = {f.split()[0]: [] for f in schema.split(", ")}
        if len(docs) and len(told):
            text, begin, end, ids = _shard_arrays(docs)
            is_note = pc.is_null(told.column("d"))

            def joined(mask, name, kind):
                return np.frombuffer(b"".join(told.filter(mask).column(name).to_pylist()), kind)

            number, doc, left = (joined(is_note, c, np.uint32).astype(np.int64) for c in "abc")
            said = pc.invert(is_note)
            of = joined(said, "a", np.uint32).astype(np.int64)
            order = np.argsort(of, kind="stable")
            of, low, high, first = of[order], joined(said, "b", np.uint8)[order].astype(np.int64), joined(said, "c", np.uint8)[order].astype(np.int64), joined(said, "d", np.int64)[order]
            from_, to = np.searchsorted(of, number), np.searchsorted(of, number, side="right")
            pick = _spans_of(from_, to - from_)
            doc, left = np.repeat(doc, to - from_), np.repeat(left, to - from_)
            earlier = first[pick] < ids[doc]
            doc, left, pick = doc[earlier], left[earlier], pick[earlier]
            mark = np.bincount(left + low[pick], minlength=len(text) + 1) - np.bincount(left + high[pick] + length, minlength=len(text) + 1)
            gone = np.cumsum(mark[: len(text)]) > 0
            digests, names = docs.column("digest").to_pylist(), docs.column("doc_id").to_pylist()
            for d in np.unique(doc):
                own = gone[begin[d] : end[d]]
                kept = text[begin[d] : end[d]][~own].tobytes()
                row = (names[d], digests[d], int(own.sum()), int(own[0]) + int((own[1:] & ~own[:-1]).sum()), hashlib.sha256(kept).hexdigest(), kept.decode(errors="ignore"))
                for k, v in zip(out, row, strict=False):
                    out[k].append(v)
        kinds = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
        return pa.table({f.split()[0]: pa.array(out[f.split()[0]], kinds[f.split()[1]]) for f in schema.split(", ")})

    return shards.select("shard", "doc_id", "digest", "text").groupBy("shard").cogroup(both.groupBy("shard")).applyInArrow(run, schema)


def _keyed(docs: DataFrame) -> DataFrame:
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.sha2(raw, 256)).alias("digest"), raw.alias("text"))


def _same(a: str, b: str):
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.digest") == F.col(f"{b}.digest"))


def repeats(docs: DataFrame, length: int = LENGTH, with_text: bool = False) -> tuple[DataFrame, DataFrame]:
    """(documents, changed): every row's doc_id, digest and n_bytes; and of those that lose
    bytes n_removed, n_spans, kept_sha256 (and kept)."""
    documents = stored(_keyed(docs).select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes")), "repeats-documents")
    first = stored(documents.groupBy("digest").agg(F.min("doc_id").alias("first")), "repeats-first")  # a table of its own, so that Spark can split the copies of one text
    copies = documents.join(first, "digest").where((F.col("n_bytes") >= length) & F.col("first").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("first")))
    copies = stored(copies.select("doc_id", "digest", "n_bytes"), "repeats-copies").dropDuplicates(["doc_id", "digest"])
    originals = _keyed(docs).alias("d").join(copies.alias("c"), _same("d", "c"), "left_anti")
    shards = document_shards(originals, "repeats-shards")
    bytes_in = shards.agg(F.sum(F.length("text"))).first()[0] or 0
    shared = stored(sieve(shards, length, max(1, bytes_in * 8 * 2 // ((length - _GRAM + 2) * BUCKET_BYTES))), "repeats-anchors")
    anchors_in = (shared.agg(F.sum(F.length("keys"))).first()[0] or 0) // 8
    asked = stored(ask(shards, shared, length, max(1, anchors_in * (2 * length) // BUCKET_BYTES)), "repeats-asked")
    discard(shared)
    answers = stored(answer(asked, length), "repeats-answers")
    notes = stored(asked.where("bucket = -1").select("shard", "numbers", "sizes", "offsets"), "repeats-notes")
    discard(asked)
    kept = [F.lit("").alias("kept")] * with_text
    whole = copies.select("doc_id", "digest", F.col("n_bytes").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), F.lit(hashlib.sha256().hexdigest()).alias("kept_sha256"), *kept)
    changed = stored(cut(shards, notes, answers, length, with_text).dropDuplicates(["doc_id", "digest"]).unionByName(whole), "repeats-changed")
    for table in (shards, notes, answers):
        discard(table)
    return documents, changed


def removed(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row of ``docs``.

    A NULL text counts as empty; a text shorter than ``length`` loses nothing. A NULL
    doc_id ranks behind all others, and rows with equal doc_ids are not before
    one another. Columns besides doc_id and text are not read; an empty table
    gives an empty result.
    """
    documents, changed = repeats(docs, length)
    return documents.alias("d").join(changed.alias("c"), _same("d", "c"), "left").select(
        "d.doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"),
        F.coalesce("kept_sha256", F.lower(F.hex("d.digest"))).alias("kept_sha256"),
    )


def cut_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with the repeated bytes cut out of ``text``; ``n_chars``, if there, is counted anew.

    Bytes are cut where the strings end, also within a character; what remains of such a
    character is dropped. Rows stay, with an empty text if nothing is left.
    """
    _, changed = repeats(docs, length, with_text=True)
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.sha2(raw, 256)).alias("digest"))
    joined = rows.alias("d").join(changed.select("doc_id", "digest", "kept").alias("c"), _same("d", "c"), "left")
    is_cut = F.col("c.digest").isNotNull()
    fresh = {"text": F.col("c.kept"), "n_chars": F.length("c.kept").cast("long")}
    old = {c: F.col("row").getField(c) for c in docs.columns}
    return joined.select(*[(F.when(is_cut, fresh[c]).otherwise(v) if c in fresh else v).alias(c) for c, v in old.items()])
