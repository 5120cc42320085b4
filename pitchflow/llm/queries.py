"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchflow.llm import brown, decontaminate, extract, itq, lexical, merkle, order_minhash, packing, quality, simhash, suffix_dedup, toxicity, warc
from pitchflow.llm.common import read_table, ship_code


def op1_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract.extract(read_table(spark, sf_dir, "pages"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learnt from the labels that aren't held out."""
    return toxicity.toxicity_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best window of every document and benchmark item with similarity 0.8 or more."""
    found = decontaminate.hits(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "similarity", "n_words")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its repeated strings of 50 bytes."""
    return suffix_dedup.removed(read_table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bucket, batch and slot of every document."""
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back."""
    index = warc.write_archives(read_table(spark, sf_dir, "pages"))
    return warc.read_records(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


def op7_itq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector at cosine 0.95."""
    return itq.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document (3-word shingles, 2 bits)."""
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, radius=2)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op9_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and class-model score of every document."""
    return brown.lm_scores(read_table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learnt from the labels that aren't held out."""
    return quality.quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op11_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return order_minhash.edits(read_table(spark, sf_dir, "documents"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document, every fifth of them checked with a tampered text."""
    return merkle.checked(read_table(spark, sf_dir, "documents"), merkle.tampered())


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten highest-scoring documents of every benchmark item."""
    return lexical.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


QUERIES = [
    op1_extract, op2_toxicity, op3_decontaminate, op4_suffix_dedup, op5_packing, op6_warc, op7_itq, op8_simhash, op9_brown_lm, op10_quality,
    op11_order_minhash, op12_merkle, op13_lexical,
]


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_code(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: _shipped(q) for q in QUERIES}


OP3_SQL = r"""
WITH dw AS (
  SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{M}\p{N}]+'), lambda x: x <> '') AS w FROM documents
), iw AS (
  SELECT item_id, w, len(w) AS n, least(5, len(w)) AS k
  FROM (SELECT item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{M}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark)
  WHERE len(w) > 0
), shingle AS (
  SELECT item_id, k, list_slice(w, p, p + k - 1) AS sh, count(*) AS c FROM iw, unnest(generate_series(1, n - k + 1)) AS u(p) GROUP BY ALL
), pair AS (
  SELECT DISTINCT doc_id, item_id FROM (
    SELECT doc_id, k, list_slice(w, p, p + k - 1) AS sh
    FROM dw, (SELECT DISTINCT k FROM iw), unnest(generate_series(1, len(w) - k + 1)) AS u(p)
  ) JOIN shingle USING (k, sh)
), win AS (
  SELECT doc_id, item_id, s, n, iw.k AS k, n - iw.k + 1 AS total, least(n, len(dw.w)) - iw.k + 1 AS held, dw.w AS w
  FROM pair JOIN dw USING (doc_id) JOIN iw USING (item_id), unnest(generate_series(1, greatest(len(dw.w) - n, 0) + 1)) AS u(s)
), counted AS (
  SELECT doc_id, item_id, s, n, k, total, held, list_slice(w, s + i, s + i + k - 1) AS sh, count(*) AS c
  FROM win, unnest(generate_series(0, held - 1)) AS u(i) GROUP BY ALL
), common AS (
  SELECT doc_id, item_id, s, n, total, held, sum(least(counted.c, shingle.c)) AS common
  FROM counted JOIN shingle USING (item_id, k, sh) GROUP BY ALL
)
SELECT doc_id, item_id, max(common / (total + held - common)) AS similarity, CAST(n AS INTEGER) AS n_words
FROM common GROUP BY doc_id, item_id, n HAVING max(common / (total + held - common)) >= 0.8
"""

OP4_SQL = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n_bytes FROM documents
), w AS (
  SELECT doc_id, s, substr(h, 2 * s + 1, 100) AS w FROM d, unnest(generate_series(0, n_bytes - 50)) AS u(s)
), f AS (
  SELECT w, min(doc_id) AS first_id FROM w GROUP BY w HAVING min(doc_id) < max(doc_id)
), g AS (
  SELECT w.doc_id, w.s FROM w JOIN f ON w.w = f.w WHERE f.first_id < w.doc_id
), n AS (
  SELECT doc_id, s, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 50 THEN 0 ELSE 1 END AS starts FROM g
), k AS (
  SELECT doc_id, s, sum(starts) OVER (PARTITION BY doc_id ORDER BY s) AS span FROM n
), sp AS (
  SELECT doc_id, span, min(s) AS a, max(s) + 50 AS b FROM k GROUP BY doc_id, span
), lost AS (
  SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last_b FROM sp GROUP BY doc_id
), kept AS (
  SELECT p.doc_id, string_agg(substr(d.h, 2 * p.before + 1, 2 * (p.a - p.before)), '' ORDER BY p.a) AS h
  FROM (SELECT doc_id, a, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM sp) p JOIN d USING (doc_id)
  GROUP BY p.doc_id
)
SELECT d.doc_id, CAST(d.n_bytes AS BIGINT) AS n_bytes, CAST(coalesce(lost.n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(lost.n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN lost.doc_id IS NULL THEN d.h ELSE kept.h || substr(d.h, 2 * lost.last_b + 1) END)) AS kept_sha256
FROM d LEFT JOIN lost USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

OP6_SQL = """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, url, strlen(h) AS payload_bytes, sha1(h) AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS last_id FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last_id THEN last_id END AS refers_to, url
FROM m
"""

OP7_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e,
         coalesce(len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                  AND len(list_filter(embedding, lambda x: x <> 0)) > 0, false) AS usable
  FROM embeddings
), link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE a.usable AND b.usable AND list_cosine_similarity(a.e, b.e) >= 0.95
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
)
SELECT v.vec_id, (SELECT count(*) FROM link WHERE link.a = v.vec_id) AS n_links,
       r.component_id, v.vec_id = r.component_id AS kept
FROM v JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) r ON r.a = v.vec_id
"""


OP11_SQL = r"""
WITH doc AS (
  SELECT row_number() OVER (ORDER BY doc_id DESC NULLS LAST) AS rid, doc_id, coalesce(text, '') AS text FROM documents
), pair AS (
  SELECT d.rid, d.doc_id, d.text, left(d.text, length(d.text) - length(d.text) // 2) || left(e.text, length(d.text) // 2) AS edited
  FROM doc d JOIN doc e ON e.rid = d.rid % (SELECT count(*) FROM doc) + 1
), said AS (
  SELECT rid, 0 AS kind, text FROM pair UNION ALL SELECT rid, 1 AS kind, edited FROM pair
), token AS (
  SELECT rid, kind, regexp_extract_all(text, '[^\x20\x09-\x0D]{1,16}') AS w FROM said
), kmer AS (
  SELECT rid, kind, p AS pos, array_to_string(list_slice(w, p, p + 2), ' ') AS x
  FROM token, unnest(generate_series(1, CASE WHEN len(w) = 0 THEN 0 ELSE greatest(len(w) - 2, 1) END)) AS u(p)
), ring AS (
  SELECT rid, kind, pos, x, md5(x || ' ' || (row_number() OVER (PARTITION BY rid, kind, x ORDER BY pos) - 1)) AS place FROM kmer
), placed AS (
  SELECT rid, kind, list(place ORDER BY place) AS places, list(pos ORDER BY place) AS ats, list(x ORDER BY pos) AS xs FROM ring GROUP BY rid, kind
), mark AS (
  SELECT j, printf('%02x', j * 4) AS m FROM range(64) r(j)
), met AS (
  SELECT rid, kind, j, len(list_filter(places, lambda z: z < m)) AS f, len(places) AS n, ats, xs FROM placed, mark
), picked AS (
  SELECT rid, kind, j, xs, least(ats[f % n + 1], ats[(f + 1) % n + 1]) AS a, greatest(ats[f % n + 1], ats[(f + 1) % n + 1]) AS b FROM met
), part AS (
  SELECT rid, kind, j, left(md5(xs[a] || ' ' || xs[b]), 8) AS c FROM picked
), print AS (
  SELECT rid, kind, list(c ORDER BY j) AS cs FROM part GROUP BY rid, kind
), every AS (
  SELECT rid, kind, coalesce(cs, list_transform(range(64), lambda z: left(md5(''), 8))) AS cs FROM said LEFT JOIN print USING (rid, kind)
)
SELECT p.doc_id, CAST(length(p.text) AS BIGINT) AS n_chars, sha256(p.edited) AS edited_sha256,
       array_to_string(a.cs, '') AS fingerprint, array_to_string(b.cs, '') AS edited_fingerprint,
       len(list_filter(range(1, 65), lambda z: a.cs[z] = b.cs[z])) / 64 AS near_edited,
       len(list_filter(range(1, 65), lambda z: a.cs[z] = e.cs[z])) / 64 AS near_next
FROM pair p JOIN every a ON a.rid = p.rid AND a.kind = 0 JOIN every b ON b.rid = p.rid AND b.kind = 1
JOIN every e ON e.rid = p.rid % (SELECT count(*) FROM doc) + 1 AND e.kind = 0
"""

OP12_SQL = """
WITH RECURSIVE doc AS (
  SELECT row_number() OVER () AS rid, doc_id, source, lang, n_chars, text,
         list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: ord(x)::BIGINT)),
           lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, i: xor(c >> 1, 3988292384 * (c & 1)))
         ) AS crc
  FROM documents
), given AS (
  SELECT *, CASE WHEN xor(crc, 4294967295) % 5 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS told FROM doc
), front AS (
  SELECT rid, doc_id, source, coalesce(strlen(source) || ':' || source, '-') AS g, text, told,
         coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS fields
  FROM given
), leaf AS (
  SELECT rid, doc_id, source, g, sha256(fields || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(fields || coalesce(strlen(told) || ':' || told, '-')) AS given_leaf
  FROM front
), place AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY g) AS n FROM leaf
), node(level, g, idx, n, h) AS (
  SELECT 0, g, idx, n, leaf FROM place
  UNION ALL
  SELECT level + 1, g, idx // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY idx)) FROM node WHERE n > 1 GROUP BY level, g, idx // 16, n
), sub AS (
  SELECT g, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS idx, count(*) OVER () AS n
  FROM (SELECT DISTINCT g, source FROM leaf) JOIN (SELECT g, h FROM node WHERE n = 1) USING (g)
), top(level, idx, n, h) AS (
  SELECT 0, idx, n, h FROM sub
  UNION ALL
  SELECT level + 1, idx // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY idx)) FROM top WHERE n > 1 GROUP BY level, idx // 16, n
), step AS (
  SELECT level, g, idx,
         coalesce(string_agg(h, '') OVER (PARTITION BY level, g, idx // 16 ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(h, '') OVER (PARTITION BY level, g, idx // 16 ORDER BY idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM node WHERE n > 1
), top_step AS (
  SELECT level, idx,
         coalesce(string_agg(h, '') OVER (PARTITION BY level, idx // 16 ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(h, '') OVER (PARTITION BY level, idx // 16 ORDER BY idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM top WHERE n > 1
), fold(rid, g, level, idx, h, proof) AS (
  SELECT rid, g, 0, idx, given_leaf, '' FROM place
  UNION ALL
  SELECT rid, f.g, f.level + 1, f.idx // 16, sha256(l || f.h || r), proof || l || r
  FROM fold f JOIN step s ON s.level = f.level AND s.g = f.g AND s.idx = f.idx
), top_fold(rid, level, idx, h, proof) AS (
  SELECT rid, 0, sub.idx, f.h, proof FROM (SELECT rid, g, arg_max(h, level) AS h, arg_max(proof, level) AS proof FROM fold GROUP BY rid, g) f JOIN sub USING (g)
  UNION ALL
  SELECT rid, f.level + 1, f.idx // 16, sha256(l || f.h || r), proof || l || r
  FROM top_fold f JOIN top_step s ON s.level = f.level AND s.idx = f.idx
)
SELECT p.doc_id, p.leaf, sub.h AS subroot, root.h AS root, sha256(e.proof) AS proof_sha256, e.h AS folded_root, e.h = root.h AS verified
FROM place p JOIN sub USING (g) JOIN (SELECT rid, arg_max(h, level) AS h, arg_max(proof, level) AS proof FROM top_fold GROUP BY rid) e USING (rid),
     (SELECT h FROM top WHERE n = 1) root
"""

OP13_SQL = r"""
WITH doc AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), item AS (
  SELECT row_number() OVER () AS iid, item_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM (SELECT DISTINCT item_id, text FROM benchmark)
), total AS (
  SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS length FROM doc WHERE len(w) > 0
), entry AS (
  SELECT rid, doc_id, len(w) AS n, t, count(*) AS tf FROM doc, unnest(w) AS u(t) GROUP BY ALL
), term AS (
  SELECT t, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM entry, total GROUP BY t
), query AS (
  SELECT iid, item_id, t, count(*) AS many FROM item, unnest(w) AS u(t) GROUP BY ALL
), scored AS (
  SELECT iid, item_id, rid, doc_id,
         CAST(sum(many * weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * n_docs) // length))))) AS BIGINT) AS score
  FROM query JOIN entry USING (t) JOIN term USING (t), total GROUP BY ALL
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_decontaminate": OP3_SQL, "op4_suffix_dedup": OP4_SQL, "op6_warc": OP6_SQL, "op7_itq": OP7_SQL,
        "op11_order_minhash": OP11_SQL, "op12_merkle": OP12_SQL, "op13_lexical": OP13_SQL,
    }
