"""Helpers that several operators share: tables in the shared folder, document
shards, connected components."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from pitchflow.session import new_run_dir

#: Text bytes that one document shard holds at most, unless a single document is longer.
SHARD_BYTES = 4 << 20


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Give the executors this package, once per application, for workers that
    don't have it installed."""
    if spark.sparkContext.applicationId not in _shipped:
        root = Path(__file__).resolve().parents[2]
        archive = Path(tempfile.mkdtemp(prefix="pitchflow-code-")) / "pitchflow.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for f in sorted((root / "pitchflow").rglob("*.py")):
                z.write(f, f.relative_to(root))
        spark.sparkContext.addPyFile(str(archive))
        _shipped.add(spark.sparkContext.applicationId)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def shuffle_files_freed(spark: SparkSession):
    """Within it, Spark removes the shuffle files of each finished query.

    Operators of several steps write each step as a table, so the shuffle files
    behind it are of no more use; left alone they would pile up until the
    driver happens to collect its garbage.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and read it again.

    This cuts the lineage: a lost executor costs the tasks of the running step
    only, and nothing is kept on one machine's disk.
    """
    spark = df.sparkSession
    path = new_run_dir(spark, label)
    with shuffle_files_freed(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a table made by :func:`stored` that no later step reads."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def crc32_mod(column: str, mod: int):
    """crc32 of the id's decimal text, modulo ``mod``; NULL for a NULL id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % mod


def batched(frames: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Cut record batches into pieces of at most ``size`` rows."""
    for b in frames:
        for at in range(0, b.num_rows, size):
            yield b.slice(at, size)


# ---------------------------------------------------------------------------
# Document shards
# ---------------------------------------------------------------------------


def document_shards(rows: DataFrame, label: str, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Stored table of ``rows``, which have a binary column ``text``, with a column ``shard`` (long).

    A shard is a run of rows of one input task with ``shard_bytes`` of text at
    most (one longer text makes a shard of its own). Shard numbers are written
    with the rows, so that they hold for every later step, however the table is
    then split.
    """

    def number(batches):
        part, seq, held = TaskContext.get().partitionId(), 0, 0
        for b in batches:
            shards = []
            for n in pc.binary_length(b.column("text")).to_pylist():
                if held and held + n > shard_bytes:
                    seq, held = seq + 1, 0
                held += n
                shards.append((part << 32) + seq)
            yield pa.RecordBatch.from_arrays([pa.array(shards, pa.int64()), *b.columns], names=["shard", *b.schema.names])

    schema = StructType([StructField("shard", LongType()), *rows.schema.fields])
    return stored(rows.mapInArrow(number, schema), label)


# ---------------------------------------------------------------------------
# Connected components
# ---------------------------------------------------------------------------


#: Narrow rows that a task takes at most on average, where :func:`in_tasks` counts the tasks.
TASK_ROWS = 200_000


def in_tasks(df: DataFrame, rows: int) -> DataFrame:
    """``df``, narrow rows grouped by a key, ``rows`` at most, in as many tasks as they need,
    but one for each core at least; never in more than it has.

    The shuffle's partitions are counted for a query's largest tables. A step that writes a
    few rows from each of them would spend its time on starting tasks and closing files.
    """
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS)))


#: Rows of one side of a join that Spark may send to every executor. It judges a table by the bytes of its files, of
#: which ids take few; the driver needs some 250 bytes a row while it makes the table that is sent.
BROADCAST_ROWS = 100_000


def joined_to(df: DataFrame, rows: int) -> DataFrame:
    """``df``, ``rows`` at most, for a join that sends it to every executor only if these are few."""
    return df.hint("merge") if rows > BROADCAST_ROWS else df


def connected_components(edges: DataFrame, label: str = "components", nodes: int = 0) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: long, a != b); component
    is the smallest node reachable.

    Alternating large-star and small-star steps on written tables: every step
    is an aggregation with a map-side part or a join with its written result, so
    that Spark can split a node with many neighbours; no neighbourhood is gathered
    in a task, and nothing but the number of edges and, each round, whether a node
    is unsettled comes to the driver. No round has more edges than the one before. Stops
    when all edges form stars: a node then has larger neighbours only, or a single one.
    ``nodes`` is a bound of the number of nodes, if one is known (:func:`joined_to`).
    """
    ordered = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v")
    now = stored(ordered, label)
    n = now.count()
    most = min(nodes, 2 * n)
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.max("v").alias("top"))
        least = least.select("u", F.least("u", "m").alias("m"), ((F.col("m") > F.col("u")) | (F.col("m") == F.col("top"))).alias("settled"))
        least = stored(in_tasks(least, 2 * n), label)
        if least.where("not settled").isEmpty():
            discard(now)
            return least.select(F.col("u").alias("node"), F.col("m").alias("component"))
        large = both.join(joined_to(least, most), "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(in_tasks(large, n), label)
        lower = stored(in_tasks(large.groupBy("u").agg(F.min("v").alias("m")), n), label)
        small = large.join(joined_to(lower, most), "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(lower).distinct()
        old = [now, least, large, lower]
        now = stored(in_tasks(small, n), label)
        for table in old:
            discard(table)


# ---------------------------------------------------------------------------
# Global order
# ---------------------------------------------------------------------------

#: ``at`` has the block above these bits and the place in the block below them.
PLACE_BITS = 33


def in_order(rows: DataFrame, order: list[Column], label: str) -> DataFrame:
    """Stored table of ``rows`` with a column ``at`` (long) that ascends in ``order``.

    The rows are dealt to blocks by range and sorted there; ``at >> PLACE_BITS`` is the
    block, and within a block the numbers are consecutive from 0 on. Equal rows are told
    apart by where they were read, so that a block never has to hold all copies of a row;
    which of them comes first is not defined.
    """
    spark = rows.sparkSession
    blocks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*order, F.col("_read")]
    dealt = rows.withColumn("_read", F.monotonically_increasing_id()).repartitionByRange(blocks, *keys).sortWithinPartitions(*keys)
    return stored(dealt.drop("_read").withColumn("at", F.monotonically_increasing_id()), label)


def block_of(at: str = "at") -> Column:
    return F.shiftright(at, PLACE_BITS)


def numbered(rows: DataFrame, group: str, label: str) -> DataFrame:
    """Rows of :func:`in_order`, sorted by the column ``group`` first, with ``idx`` (from 0 on) in
    the group and ``n``, the group's rows. No task sees a whole group: blocks count their rows of each
    group, and the counts of the blocks before are added to the place in the block."""
    runs = rows.groupBy(group, block_of().alias("block")).agg(F.min("at").alias("first"), F.count("*").alias("many"))
    by_group = Window.partitionBy(group)
    before = F.coalesce(F.sum("many").over(by_group.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = stored(runs.select(group, "block", "first", before.alias("before"), F.sum("many").over(by_group).alias("n")), label)
    found = rows.withColumn("block", block_of()).join(runs, [group, "block"])
    return found.withColumn("idx", F.col("before") + F.col("at") - F.col("first")).drop("block", "first", "before", "at")
