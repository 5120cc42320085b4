"""Incremental Bronze ingest with Structured Streaming.

Each call is one ``availableNow`` run over the landing files the checkpoint has
not seen yet, in as many micro-batches as the rate limit asks for, and stops. A
micro-batch is one batch folder of the Bronze table: the fields of its own
documents are merged into the schema memory, its match rows are written as text
columns, and texts that are no documents go to the quarantine table with their
file. A failed batch is run again from the checkpoint and replaces its folder, so
a refresh neither loses nor repeats rows.

Which files are new is the checkpoint's business alone: file dates play no part,
and files of any age are taken.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchflow import spec
from pitchflow.sources.landing import (
    RESCUED,
    SchemaStore,
    add_load_time,
    as_stored,
    bronze_schema,
    document_types,
    bronze_rows,
    parsed,
    persist_parsed,
    raw_documents,
    stray_elements,
    typed_columns,
)
from pitchflow.sources.tables import BATCH, ORIGIN, batch_rows, committed_batches, path_exists, read_batches, write_batch

#: The file source forgets files older than this, counted from the newest; a hundred years.
MAX_FILE_AGE = "36500d"
QUARANTINE_SCHEMA = T.StructType(
    [
        T.StructField("value", T.StringType()),
        T.StructField(spec.SOURCE_FILE_COL, T.StringType()),
        T.StructField(spec.LOAD_TIME_COL, T.TimestampType()),
    ]
)
#: A whole document set aside is one value. Row groups, which readers decode at once, and pages are closed by their
#: bytes after every value; by default a hundred values are gathered before the first look.
WHOLE_TEXTS = {
    "parquet.block.size": str(4 << 20),
    "parquet.block.size.row.check.min": "1",
    "parquet.page.size.row.check.min": "1",
    "parquet.enable.dictionary#value": "false",
}


@dataclass
class IngestResult:
    """What one run read: micro-batches, documents, texts set aside, the schema memory after it, and how many
    elements of match lists were no matches and were set aside."""

    batches: int
    documents: int
    malformed: int
    schema: T.StructType
    stray: int = 0


def quarantine_path(bronze_path: str) -> str:
    return f"{bronze_path.rstrip('/')}_apartados"


def _write_aside(texts: DataFrame, bronze_path: str, batch: int) -> None:
    write_batch(add_load_time(texts), quarantine_path(bronze_path), batch, options=WHOLE_TEXTS)


def ingest_landing(
    spark: SparkSession,
    landing: str,
    bronze_path: str,
    state_dir: str,
    *,
    multi_line: bool = False,
    max_files_per_trigger: int | None = None,
    timeout_seconds: int | None = None,
    archive_dir: str | None = None,
) -> IngestResult:
    """Run one incremental ingest of ``landing`` into ``bronze_path``.

    ``state_dir`` holds the stream checkpoint and the schema memory; keep it
    outside the landing folder, on storage every executor shares. If the checkpoint
    is lost, the files that Bronze and the quarantine name as their source are not taken
    again, and the batches go on behind those that are there. With
    ``archive_dir``, files whose batch committed are moved there, so the
    landing folder each trigger lists stays small over a long history.
    """
    state_dir = state_dir.rstrip("/")
    ledger, base = _ledger(spark, bronze_path, state_dir)
    store = SchemaStore(spark, f"{state_dir}/schema")
    reader = spark.readStream.option("maxFileAge", MAX_FILE_AGE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    done: list[tuple[int, int, int]] = []

    def write(text: DataFrame, batch: int) -> None:
        batch += base
        if ledger is not None:
            text = text.join(ledger, spec.SOURCE_FILE_COL, "left_anti")
        found, good, bad, stray, types = document_types(text)
        # Parsed documents are kept only if stray elements are looked for in them, see persist_parsed; texts are parsed again.
        raw = persist_parsed(text) if stray else text
        write_batch(bronze_rows(raw, store.merge(found), types=types), bronze_path, batch)
        if bad or stray:
            parts = [raw.where("v is null").select("value", spec.SOURCE_FILE_COL)] * bool(bad) + [stray_elements(raw)] * bool(stray)
            _write_aside(reduce(DataFrame.union, parts), bronze_path, batch)
        if stray:
            raw.unpersist()
        done.append((good, bad, stray))

    query = (
        raw_documents(reader.text(landing, wholetext=multi_line))
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{state_dir}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    if timeout_seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_seconds):
        query.stop()
        raise TimeoutError(f"bronze ingest did not finish within {timeout_seconds} s")
    schema, _ = store.load()
    good, bad, stray = (sum(n) for n in zip((0, 0, 0), *done, strict=True))
    return IngestResult(len(done), good, bad, schema or T.StructType([]), stray)


def _ledger(spark: SparkSession, bronze_path: str, state_dir: str) -> tuple[DataFrame | None, int]:
    """The files that were ingested under an earlier checkpoint, if there was one, and the number of this checkpoint's first batch.

    Both are written when a checkpoint begins beside existing batches, before its first
    batch, and hold as long as it does.
    """
    path = f"{state_dir}/ledger"
    if not path_exists(spark, f"{state_dir}/checkpoint/offsets"):
        there = [n for p in (bronze_path, quarantine_path(bronze_path)) for n in committed_batches(spark, p) if n < REPLAYED]
        if there:
            stated = T.StructType([T.StructField(spec.SOURCE_FILE_COL, T.StringType())])
            files = [read_batches(spark, p, stated) for p in (bronze_path, quarantine_path(bronze_path))]
            files[0].union(files[1]).distinct().write.mode("overwrite").parquet(f"{path}/from={max(there) + 1}")
    begun = committed_batches(spark, path, "from")
    if not begun:
        return None, 0
    return spark.read.parquet(f"{path}/from={max(begun)}"), max(begun)


#: Batches of replayed texts are numbered from here on, apart from the stream's.
REPLAYED = 1_000_000_000


def replayed_path(bronze_path: str) -> str:
    return f"{bronze_path.rstrip('/')}_repuestos"


#: What a replayed text is known by.
KEYS = T.StructType([T.StructField(spec.SOURCE_FILE_COL, T.StringType()), T.StructField("digest", T.StringType())])
#: Keys that are sent to every executor at most, a few hundred bytes each.
BROADCAST_KEYS = 100_000


def _waiting(aside: DataFrame, replayed: DataFrame, left: list[DataFrame]) -> DataFrame:
    """The texts of ``aside`` whose keys are not among ``replayed``.

    Keys come to the texts, which are whole documents and are not shuffled: those replayed if they are few, else those
    that wait, which are found by their keys alone and added to ``left`` to be unpersisted. Only if both are many, texts are shuffled.
    """
    if (n := replayed.count()) <= BROADCAST_KEYS:
        return aside.join(F.broadcast(replayed), KEYS.names, "left_anti") if n else aside
    left.append(aside.select(*KEYS.names).join(replayed, KEYS.names, "left_anti").distinct().persist(StorageLevel.DISK_ONLY))
    if left[0].count() <= BROADCAST_KEYS:
        return aside.join(F.broadcast(left[0]), KEYS.names, "left_semi")
    return aside.join(replayed, KEYS.names, "left_anti")


def replay_quarantine(spark: SparkSession, bronze_path: str, state_dir: str, fix: Callable[[Column], Column]) -> IngestResult:
    """Feed texts that were set aside back as documents, after ``fix``, which maps their text and gives the same for the same.

    A text is known by its file and the digest of what was set aside. Those that ``fix`` makes a document
    become one batch of Bronze, once: the batch's keys are written after its rows, so a replay that ended between
    the two writes the same batch again. What is still no document stays for a later fix.
    """
    batch = max(committed_batches(spark, replayed_path(bronze_path)), default=REPLAYED - 1) + 1
    # Strays that a replay which ended early set aside are written again with its batch.
    there = [b for b in committed_batches(spark, quarantine_path(bronze_path)) if b != batch]
    aside = read_batches(spark, quarantine_path(bronze_path), QUARANTINE_SCHEMA, there).withColumn("digest", F.sha2("value", 256))
    left: list[DataFrame] = []
    waiting = _waiting(aside, read_batches(spark, replayed_path(bronze_path), KEYS), left)
    raw = parsed(waiting.withColumn("value", fix(F.col("value"))))
    found, good, bad, stray, types = document_types(raw)
    store = SchemaStore(spark, f"{state_dir.rstrip('/')}/schema")
    if good:
        mended = raw.where("v is not null") if bad else raw
        if stray:
            mended = persist_parsed(mended.drop("value"))
        write_batch(bronze_rows(mended, store.merge(found), types=types), bronze_path, batch)
        if stray:
            _write_aside(stray_elements(mended), bronze_path, batch)
        write_batch(mended.select(*KEYS.names).distinct(), replayed_path(bronze_path), batch)
        if stray:
            mended.unpersist()
    for df in left:
        df.unpersist()
    return IngestResult(int(good > 0), good, 0, store.load()[0] or T.StructType([]), stray)


def read_bronze(
    spark: SparkSession,
    bronze_path: str,
    doc_schema: T.StructType | None = None,
    batches: list[int] | None = None,
    typed: bool = False,
    rescued: bool = False,
    numbered: bool = False,
) -> DataFrame:
    """Batch scan of the committed Bronze batches.

    With the schema memory (``doc_schema``) the columns are stated; rows ingested
    before a column appeared read it as NULL, and ``typed`` gives numbers where
    every document had numbers. ``rescued`` adds the values that have no column (``_rescatado``), ``numbered`` the batch (``lote``). Without the memory the files' columns are merged.
    """
    if doc_schema is None:
        if not (committed_batches(spark, bronze_path) if batches is None else batches):
            return read_batches(spark, bronze_path, bronze_schema(T.StructType([])), [])
        found = batch_rows(spark, bronze_path, None, batches).drop(BATCH, ORIGIN)
        return found if rescued else found.drop(RESCUED)
    stated = bronze_schema(as_stored(doc_schema))
    if rescued:
        stated = T.StructType([*stated.fields, T.StructField(RESCUED, T.StringType())])
    rows = read_batches(spark, bronze_path, stated, batches, numbered)
    return typed_columns(rows, doc_schema) if typed else rows


def read_quarantine(spark: SparkSession, bronze_path: str) -> DataFrame:
    """(value, source file, load time) of every text that was set aside."""
    return read_batches(spark, quarantine_path(bronze_path), QUARANTINE_SCHEMA)
