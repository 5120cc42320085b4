"""WARC archives with an index, and coalesced reads of selected records (operator 6).

Writing: every task writes its pages as gzipped WARC records to a file of its own in
the shared folder, and returns an index row per record: file, offset, length,
URL, digest. The index is a written table; it alone says which files count, so
that a file left by a failed task is never read.

Reading: the index rows of the selected records are range-partitioned and sorted
by file and offset; neighbouring byte ranges are fetched with one read.

The archive folder must be one that ``pyarrow.fs`` can open (file, hdfs, s3, gs or abfs).
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from datetime import UTC, datetime

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchflow.llm.common import stored
from pitchflow.session import new_run_dir

#: Payloads below this are always written whole.
REVISIT_BYTES = 1000
FILE_BYTES = 256 << 20
#: Records at most this far apart are fetched together, up to so many bytes.
GAP_BYTES = 256 << 10
READ_BYTES = 16 << 20
#: Archive bytes that one reading task gets on average.
TASK_BYTES = 16 << 20
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX_SCHEMA = "file string, offset long, length long, page_id long, url string, payload_digest string, record_type string"
RECORD_SCHEMA = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def planned(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """(page_id, url, payload, digest, refers_to) of every page; refers_to is the page_id of
    the record that this one revisits.

    Of equal payloads (length and SHA-1) of ``least`` bytes or more the largest page_id is
    the response. Rows that share it are all responses; a NULL page_id revisits,
    unless no equal payload has a page_id.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"), F.sha1(payload).alias("digest"))
    small = stored(rows.where(F.octet_length("payload") >= least).select("page_id", "digest", F.octet_length("payload").alias("size")), "warc-digests")
    first = stored(small.groupBy("digest", "size").agg(F.max("page_id").alias("refers_to")), "warc-last")
    again = small.join(first, ["digest", "size"]).where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
    again = stored(again.select("page_id", "digest", "refers_to").distinct(), "warc-revisits")
    same = F.col("p.page_id").eqNullSafe(F.col("r.page_id")) & (F.col("p.digest") == F.col("r.digest"))
    return rows.alias("p").join(again.alias("r"), same, "left").select("p.page_id", "url", "payload", "p.digest", "refers_to")


def _urn(page_id: int | None) -> str:
    return f"<urn:pitchflow:page:{'none' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One WARC record. A revisit holds the HTTP header only, which states the payload's length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_urn(page_id)}",
        f"WARC-Date: {date}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {_urn(refers_to)}", f"WARC-Profile: {_PROFILE}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """Fields of one record; the digest of a response is that of the payload read."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/1."):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = int(re.search(rb"(?i)content-length: (\d+)", http)[1])
    of = {k: None if (v := fields.get(k, ":none>").rsplit(":", 1)[1][:-1]) == "none" else int(v) for k in ("WARC-Record-ID", "WARC-Refers-To")}
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    whole = fields["WARC-Type"] == "response"
    if whole and (len(payload) != stated or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")
    return {
        "page_id": of["WARC-Record-ID"],
        "url": fields.get("WARC-Target-URI"),
        "payload_bytes": stated,
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": of["WARC-Refers-To"],
        "payload": payload if whole else None,
    }


def write_archives(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write all pages to archives below ``folder`` and return the stored index.

    A NULL html has an empty payload; a NULL url has no target line.
    """
    spark = pages.sparkSession
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder or new_run_dir(spark, "warc"))
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.mkdirs(path)
    root = store.makeQualified(path).toString()
    date = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

    def run(batches):
        fs, base = pafs.FileSystem.from_uri(root)
        name, out, at = None, None, 0
        for b in batches:
            rows = []
            for r in b.to_pylist():
                if out is None or at >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                press = zlib.compressobj(6, zlib.DEFLATED, 31)
                raw = press.compress(record(r["page_id"], r["url"], r["payload"], r["digest"], r["refers_to"], date)) + press.flush()
                out.write(raw)
                rows.append((f"{root}/{name}", at, len(raw), r["page_id"], r["url"], r["digest"], "response" if r["refers_to"] is None else "revisit"))
                at += len(raw)
            if rows:
                yield _batch(INDEX_SCHEMA, rows)
        if out is not None:
            out.close()

    return stored(planned(pages).mapInArrow(run, INDEX_SCHEMA), "warc-index")


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[k]) for i, (_, k) in enumerate(fields)], names=[n for n, _ in fields])


def ranges(rows: list[tuple[str, int, int]]) -> list[list[tuple[str, int, int]]]:
    """Runs of (file, offset, length), sorted, that one read fetches."""
    out: list[list[tuple[str, int, int]]] = []
    for r in rows:
        if out:
            file, offset, length = out[-1][-1]
            if file == r[0] and r[1] - (offset + length) <= GAP_BYTES and r[1] + r[2] - out[-1][0][1] <= READ_BYTES:
                out[-1].append(r)
                continue
        out.append([r])
    return out


def read_records(index: DataFrame) -> DataFrame:
    """The records that the rows of ``index`` (any selection of it) point to."""

    def run(batches):
        held: dict[str, object] = {}
        for b in batches:
            rows = list(zip(*(b.column(c).to_pylist() for c in ("file", "offset", "length")), strict=True))
            out, size = [], 0
            for run_ in ranges(rows):
                file, start, _ = run_[0]
                if file not in held:
                    for f in held.values():
                        f.close()
                    fs, path = pafs.FileSystem.from_uri(file)
                    held = {file: fs.open_input_file(path)}
                raw = held[file].read_at(run_[-1][1] + run_[-1][2] - start, start)
                for _, offset, length in run_:
                    found = parse(zlib.decompress(raw[offset - start : offset - start + length], 31))
                    out.append(tuple(found.values()))
                    size += found["payload_bytes"]
                    if size > READ_BYTES:
                        yield _batch(RECORD_SCHEMA, out)
                        out, size = [], 0
            if out:
                yield _batch(RECORD_SCHEMA, out)
        for f in held.values():
            f.close()

    chosen = index.select("file", "offset", "length")
    # The rows are small, what they point to is not: tasks by the bytes to read.
    tasks = max(1, -(-(chosen.agg(F.sum("length")).first()[0] or 0) // TASK_BYTES))
    return chosen.repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset").mapInArrow(run, RECORD_SCHEMA)
