"""Layer tables: where each table lives and how it is written.

A table is ``<root>/<layer>/<name>`` in Parquet (no Delta jar is assumed).
Optionally it is also registered in the session catalog as
``<layer>.<name>`` with a comment and table properties such as the
``quality`` tag.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from pitchflow.functions.names import quote


def table_path(root: str, layer: str, name: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{name}"


def _sql_str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def write_table(
    df: DataFrame,
    root: str,
    layer: str,
    name: str,
    *,
    partition_by: list[str] | None = None,
    comment: str | None = None,
    properties: dict[str, str] | None = None,
    register: bool = False,
) -> str:
    """Result sink: ``df`` becomes the content of the table ``<root>/<layer>/<name>``.

    Every call writes a folder ``version=<n>`` of its own, which counts once Spark has
    committed it; until then, and if the write fails, readers get the version before as a whole. A
    registered table's location is then switched to the new version. The version before is
    kept for readers that are still on it, older ones and what failed writes left are deleted.
    """
    spark, path = df.sparkSession, table_path(root, layer, name)
    before = list(committed_batches(spark, path, VERSION))
    number = max(before, default=-1) + 1
    df.write.mode("overwrite").partitionBy(*partition_by or []).parquet(f"{path}/{VERSION}={number}")
    if register:
        register_table(
            spark, root, layer, name, comment=comment, properties=properties,
            schema=df.schema, partition_by=partition_by, folder=f"{path}/{VERSION}={number}",
        )
    drop_batches(spark, path, [n for n in batch_folders(spark, path, VERSION) if n < number and n not in before[-1:]], VERSION)
    return path


def register_table(
    spark: SparkSession,
    root: str,
    layer: str,
    name: str,
    *,
    comment: str | None = None,
    properties: dict[str, str] | None = None,
    schema: StructType | None = None,
    partition_by: list[str] | None = None,
    folder: str | None = None,
) -> str:
    """Name the folder ``<layer>.<name>`` in the session catalog, with comment and properties.

    With ``schema`` the columns (and partition columns) are stated, so an
    empty partitioned table registers too; otherwise they are read from
    the files. ``folder`` is where the files are, by default the table's own folder.
    """
    path = folder or table_path(root, layer, name)
    qualified = f"`{layer}`.`{name}`"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}`")
    spark.sql(f"DROP TABLE IF EXISTS {qualified}")
    if schema is None:
        spark.catalog.createTable(f"{layer}.{name}", path=path, source="parquet")
    else:
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
        spark.sql(f"CREATE TABLE {qualified} ({cols}) USING parquet{parts} LOCATION {_sql_str(path)}")
        if partition_by:
            try:  # catalogs that track partitions need them listed once
                spark.sql(f"ALTER TABLE {qualified} RECOVER PARTITIONS")
            except AnalysisException:
                pass  # this catalog finds partitions from the folders at read time
    if comment:
        spark.sql(f"COMMENT ON TABLE {qualified} IS {_sql_str(comment)}")
    if properties:
        listed = ", ".join(f"{_sql_str(k)} = {_sql_str(v)}" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {qualified} SET TBLPROPERTIES ({listed})")
    return qualified


def read_table(spark: SparkSession, root: str, layer: str, name: str, schema: StructType) -> DataFrame:
    """Scan of a full-result table's last committed version (filters on partition columns prune folders).

    The schema is stated, so a table without rows, or without a version, can be read too.
    """
    path = table_path(root, layer, name)
    versions = committed_batches(spark, path, VERSION)
    if not versions:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/{VERSION}={max(versions)}")


# ---------------------------------------------------------------------------
# Tables that grow by batches: one folder per batch, complete once Spark has
# marked it. A batch is written again as a whole if its first write failed.
# ---------------------------------------------------------------------------

BATCH = "lote"
VERSION = "version"
#: Folders of merged batches are numbered from here on; their rows keep the batch's number as a column.
MERGED = 2_000_000_000
ORIGIN = "_lote_origen"
_MERGE_MARK, _MEMBERS = "_unido", "_lotes"
#: Batches are merged once this many are not, into folders of about this size.
MERGE_AT = 16
MERGE_BYTES = 1 << 30


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the file system of ``path`` has it."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(found)


def _folders(spark: SparkSession, path: str, pattern: str) -> list:
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{pattern}")
    return list(found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(found) or [])


def committed_batches(spark: SparkSession, path: str, kind: str = BATCH) -> dict[int, int]:
    """Numbers of the batches whose write was committed, ascending, with the time of that."""
    found = {n: at for n, at in _marked(spark, path, kind).items() if kind != BATCH or n < MERGED}
    if kind == BATCH:
        for members in _merged(spark, path).values():
            found = members | found
    return dict(sorted(found.items()))


def _marked(spark: SparkSession, path: str, kind: str) -> dict[int, int]:
    marks = _folders(spark, path, f"{kind}=*/_SUCCESS")
    return {int(s.getPath().getParent().getName().split("=")[1]): s.getModificationTime() for s in marks}


def _merged(spark: SparkSession, path: str) -> dict[int, dict[int, int]]:
    """The members, with the times of their own writes, of each folder of merged batches that counts, oldest folder first."""
    counted = {int(s.getPath().getParent().getName().split("=")[1]): {} for s in _folders(spark, path, f"{BATCH}=2?????????/{_MERGE_MARK}")}
    for s in _folders(spark, path, f"{BATCH}=2?????????/{_MEMBERS}/*") if counted else []:
        number, at = s.getPath().getName().split("-")
        folder = int(s.getPath().getParent().getParent().getName().split("=")[1])
        if folder in counted:
            counted[folder][int(number)] = int(at)
    return dict(sorted(counted.items()))


def _places(spark: SparkSession, path: str) -> dict[int, int]:
    """The folder that each committed batch is read from: its own if it has one, else the last merged one that holds it."""
    places = {n: folder for folder, members in _merged(spark, path).items() for n in members}
    return places | {n: n for n in _marked(spark, path, BATCH) if n < MERGED}


def batch_folders(spark: SparkSession, path: str, kind: str = BATCH) -> list[int]:
    """Numbers of all batches that have a folder, committed or not."""
    return sorted(int(s.getPath().getName().split("=")[1]) for s in _folders(spark, path, f"{kind}=*"))


def drop_batches(spark: SparkSession, path: str, batches: list[int], kind: str = BATCH) -> None:
    """Delete the folders, each one's marks first, so that none counts while only a part of it is left."""
    for b in batches:
        for name in (f"{kind}={b}/{_MERGE_MARK}", f"{kind}={b}/_SUCCESS", f"{kind}={b}"):
            found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
            found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(found, True)


def _mark(spark: SparkSession, path: str) -> None:
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(mark, True).close()


def pending_batches(spark: SparkSession, source: str, target: str) -> list[int]:
    """Committed batches of ``source`` that ``target`` does not have, or has from before they were last written."""
    done = committed_batches(spark, target)
    return [b for b, at in committed_batches(spark, source).items() if done.get(b, -1) < at]


def write_batch(
    df: DataFrame, path: str, batch: int, partition_by: list[str] | None = None, options: dict[str, str] | None = None
) -> None:
    df.write.mode("overwrite").options(**options or {}).partitionBy(*partition_by or []).parquet(f"{path}/{BATCH}={batch}")


def write_batches(df: DataFrame, path: str, batches: list[int], partition_by: list[str] | None = None) -> None:
    """Write several batches in one job: ``df`` has their rows, and their numbers as the column ``lote``.

    Each batch counts once its own mark is there, which is set after the job; a
    batch without rows gets a mark too.
    """
    spark = df.sparkSession
    drop_batches(spark, path, batches)
    df.write.mode("append").partitionBy(BATCH, *partition_by or []).parquet(path)
    for b in batches:
        _mark(spark, f"{path}/{BATCH}={b}/_SUCCESS")


def read_batches(
    spark: SparkSession, path: str, schema: StructType, batches: list[int] | None = None, numbered: bool = False
) -> DataFrame:
    """The rows of the committed batches, or of some of them; ``numbered`` adds the column ``lote``."""
    stated = StructType([*schema.fields, StructField(BATCH, IntegerType()), StructField(ORIGIN, IntegerType())])
    rows = batch_rows(spark, path, stated, batches)
    rows = rows.withColumn(BATCH, F.coalesce(ORIGIN, BATCH))
    return rows.select(*[F.col(quote(f.name)) for f in schema.fields], *[BATCH] * numbered)


def batch_rows(spark: SparkSession, path: str, stated: StructType | None, batches: list[int] | None) -> DataFrame:
    """Scan of the folders that hold the batches, of these batches only. Rows of merged batches have their number
    in ``_lote_origen``. Without ``stated`` columns, those of the files are merged."""
    places, merged = _places(spark, path), _merged(spark, path)
    wanted: dict[int, list[int]] = {}
    for b in places if batches is None else batches:
        wanted.setdefault(places.get(b, b), []).append(b)
    if not wanted:
        return spark.createDataFrame([], stated or StructType([]))
    reader = spark.read.schema(stated) if stated else spark.read.option("mergeSchema", "true")
    rows = reader.option("basePath", path).parquet(*[f"{path}/{BATCH}={folder}" for folder in sorted(wanted)])
    # Merged folders of which some batches are not asked for, or are read from elsewhere.
    for folder, members in merged.items():
        if folder in wanted and len(members) > len(wanted[folder]):
            rows = rows.where((F.col(BATCH) != folder) | F.col(ORIGIN).isin(wanted[folder]))
    return rows


def merge_batches(
    spark: SparkSession, path: str, schema: StructType, partition_by: list[str] | None = None,
    at: int = MERGE_AT, limit: int = MERGE_BYTES,
) -> int:
    """Merge runs of consecutive small batches into one folder each; the number of folders written.

    Folders are taken in the order of their batches and packed until ``limit`` bytes are reached; a run of fewer
    than ``at`` folders is left for later. ``schema`` are the columns kept. Every batch keeps its number and the
    time of its own write, so the next layer sees nothing new. The merged folder counts from one mark on,
    which is set when all its rows and members are written; the old folders are deleted after that.
    A batch that is there twice because that was cut short is read once, and its old folder goes with the
    next merge. One writer at a time, like every refresh.
    """
    merged, times = _merged(spark, path), committed_batches(spark, path)
    held: dict[int, list[int]] = {}
    for b, folder in _places(spark, path).items():
        held.setdefault(folder, []).append(b)
    there = batch_folders(spark, path)
    # What earlier merges replaced or left unfinished.
    drop_batches(spark, path, [n for n in there if n >= MERGED and n not in held])
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    runs, size = [], 0
    for folder in sorted(held, key=lambda f: min(held[f])):
        at_path = fs_path(f"{path}/{BATCH}={folder}")
        own = at_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(at_path).getLength()
        if not runs or size + own > limit:
            runs.append([])
            size = 0
        runs[-1].append(folder)
        size += own
    number = max([MERGED - 1, *[n for n in there if n >= MERGED], *merged])
    done = [run for run in runs if len(run) >= max(2, at)]
    for run in done:
        number += 1
        members = sorted(b for folder in run for b in held[folder])
        rows = read_batches(spark, path, schema, members, numbered=True).withColumnRenamed(BATCH, ORIGIN)
        # Few files a partition, and a partition with most rows is cut into several.
        rows = rows.hint("rebalance", *[F.col(c) for c in partition_by or []])
        target = f"{path}/{BATCH}={number}"
        rows.write.mode("overwrite").partitionBy(*partition_by or []).parquet(target)
        for b in members:
            _mark(spark, f"{target}/{_MEMBERS}/{b}-{times[b]}")
        _mark(spark, f"{target}/{_MERGE_MARK}")
        drop_batches(spark, path, run)
    return len(done)
