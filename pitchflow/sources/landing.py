"""Landing documents (season JSON) -> Bronze match rows.

A landing document is ``{"temporada": <season>, "data": [<match>, ...]}``.
Two layouts are read:

* ``multi_line=True``: one (possibly pretty-printed) document per file. A file
  is then one task, since it cannot be split.
* ``multi_line=False``: JSON Lines, one document per line, many per file;
  files split at line boundaries, so a large landing drop spreads over all
  executors. This is the layout to use at volume.

The incremental ingest reads documents as text (:func:`raw_documents`) and parses
them itself, so that the fields of exactly the files of a batch are known
(:func:`document_schema`), and a text that is no JSON object is set aside instead
of lost. Stored values are text: a statistic that is a number in one file and
``"n (p%)"`` in the next then never breaks a read, and typed values are a
projection (:func:`typed_columns`).
"""

from __future__ import annotations

import json
import re

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchflow import spec
from pitchflow.functions.names import col, quote, unfused
from pitchflow.sources.tables import BATCH, ORIGIN

ENCODING = "UTF-8"

#: Column of the ingested rows with the values that have no column.
RESCUED = "_rescatado"


def json_options(multi_line: bool, infer_types: bool = False) -> dict[str, str]:
    """Options of the batch landing reader. The encoding is stated: detecting it makes
    the parser take a much slower path for wide string schemas."""
    return {
        "multiLine": str(multi_line).lower(),
        "primitivesAsString": str(not infer_types).lower(),
        "mode": "PERMISSIVE",
        "encoding": ENCODING,
    }


def read_documents(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    *,
    multi_line: bool = False,
    infer_types: bool = False,
) -> DataFrame:
    """Batch read of landing documents (S2, S4); infers the schema when none is given."""
    reader = spark.read.options(**json_options(multi_line, infer_types))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def parsed(texts: DataFrame) -> DataFrame:
    """``texts`` with the document ``v`` of each ``value``; NULL for a text that is no JSON object."""
    # No pattern: it would decode the whole text to see its first character.
    begun = F.startswith(F.ltrim("value", F.lit(" \t\n\x0b\f\r")), F.lit("{"))
    return texts.withColumn("v", F.when(begun, F.try_parse_json("value")))


def raw_documents(text: DataFrame) -> DataFrame:
    """(value, source file, v) of a text read of landing files (:func:`parsed`). Blank lines are no documents."""
    return parsed(text.where(F.trim("value") != "").select("value", F.col("_metadata.file_path").alias(spec.SOURCE_FILE_COL)))


def persist_parsed(raw: DataFrame) -> DataFrame:
    """``raw``, parsed once for all that is made of it. The parsed documents are kept, and the texts of those
    that are none, on the executors' disks: in memory they would take the room of the tasks.

    Spark's writer and reader of these hold up to a hundred pieces of 4 MB, or one document, in a task until they let go of them."""
    none = {"value": F.when(F.col("v").isNull(), F.col("value"))} if "value" in raw.columns else {}
    return raw.withColumns(none).persist(StorageLevel.DISK_ONLY)


def _got(variant: str, path: str, kind: str) -> Column:
    return F.expr(f"try_variant_get({variant}, '{path}', '{kind}')")


def document_elements(raw: DataFrame, field: str = spec.DATA_FIELD) -> DataFrame:
    """(source file, season, pos, e) of the documents of :func:`raw_documents`: one row for each element
    ``e`` of the match list, numbered by ``pos``; one row without element for a document without any.

    What stands in the place of the list, a single match or a value that is none, is
    taken as its only element, so that no document can hide another's matches.
    """
    whole = _got("v", f"$.{field}", "variant")
    listed = F.coalesce(_got("v", f"$.{field}", "array<variant>"), F.when(~F.is_variant_null(whole), F.array(whole)))
    # The document itself stays behind: its rows must not carry a copy of it each.
    docs = raw.where("v is not null").select(spec.SOURCE_FILE_COL, _got("v", "$.temporada", "variant").alias("season"), listed.alias("listed"))
    return docs.select(spec.SOURCE_FILE_COL, "season", F.posexplode_outer("listed").alias("pos", "e"))


def document_schema(raw: DataFrame, field: str = spec.DATA_FIELD) -> tuple[T.StructType, int, int, int]:
    """Fields and types of the documents (numbers kept), how many texts are documents, how many are
    none, and how many elements of match lists are no matches. One aggregation over the parsed documents;
    a second one, element by element, only if something else than lists of matches is among them."""
    return document_types(raw, field)[:4]


def document_types(raw: DataFrame, field: str = spec.DATA_FIELD) -> tuple[T.StructType, int, int, int, dict[str, T.DataType] | None]:
    """:func:`document_schema`, and the types, as they are, of the season and the match fields, for :func:`bronze_rows`.
    The types are None if a text is no document, or if something else than lists of matches is among the documents."""
    # The types are read of the document in place: what is got of it as a variant is built anew, element by element.
    matches = _got("v", f"$.{field}", "array<struct<>>")
    row = raw.agg(
        F.schema_of_variant_agg("v").alias("v"),
        F.count("v").alias("good"),
        F.count_if(F.col("v").isNull()).alias("bad"),
        F.count_if(F.exists(matches, F.isnull)).alias("void"),
    ).first()
    document = _type(row["v"])
    types = {f.name: f.dataType for f in document.fields} if isinstance(document, T.StructType) else {}
    season, data, stray, known = types.get("temporada", T.NullType()), types.get(field, T.NullType()), 0, None
    plain = isinstance(data, T.ArrayType) and isinstance(data.elementType, (T.StructType, T.NullType))
    if isinstance(data, T.NullType) or (plain and not row["void"]):
        match = data.elementType if plain else data
        if not row["bad"]:
            known = {f.name: f.dataType for f in (match.fields if isinstance(match, T.StructType) else [])} | {"temporada": season}
    else:
        found = document_elements(raw, field).withColumn("is_match", _got("e", "$", "struct<>").isNotNull())
        odd = found.agg(
            F.schema_of_variant_agg(F.when(F.col("is_match"), F.col("e"))).alias("s"),
            F.count_if(F.col("e").isNotNull() & ~F.col("is_match")).alias("stray"),
        ).first()
        match, stray = _type(odd["s"]), odd["stray"]
    fields = [T.StructField("temporada", _plain(season))] if row["good"] else []
    if isinstance(match, T.StructType):
        fields.append(T.StructField(field, T.ArrayType(_plain(match), True)))
    return T.StructType(fields), row["good"], row["bad"], stray, known


def _type(of_variants: str) -> T.DataType:
    ddl = re.sub(r"`(?:[^`]|``)*`|\bOBJECT<", lambda m: m[0] if m[0].startswith("`") else "STRUCT<", of_variants)
    return T.DataType.fromDDL(ddl)


def _plain(t: T.DataType) -> T.DataType:
    """Types as a JSON reader would infer them; what has no single type is text."""
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _plain(f.dataType), True) for f in t.fields])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_plain(t.elementType), True)
    if isinstance(t, T.DecimalType):
        return T.DoubleType()
    return t if isinstance(t, (T.LongType, T.DoubleType, T.BooleanType, T.NullType)) else T.StringType()


def as_stored(schema: T.StructType, field: str = spec.DATA_FIELD) -> T.StructType:
    """The schema that documents are read with: all values as text, the match list as a list of structs."""
    fields = []
    for f in schema.fields:
        kind: T.DataType = T.StringType()
        if f.name == field and isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType):
            inner = [T.StructField(g.name, T.StringType(), True) for g in f.dataType.elementType.fields]
            kind = T.ArrayType(T.StructType(inner), True)
        fields.append(T.StructField(f.name, kind, True))
    return T.StructType(fields)


def match_fields(schema: T.StructType, field: str = spec.DATA_FIELD) -> tuple[list[T.StructField], list[T.StructField]]:
    """The remembered match fields that are columns, and those that cannot be.

    Column names are told apart without regard to case, and the season, the audit columns and the
    rescue column are taken. The first of several such fields is the column, for good, since
    the memory keeps the order in which fields were met; the others are rescued.
    """
    data = next((f.dataType for f in schema.fields if f.name == field), None)
    inner = data.elementType.fields if isinstance(data, T.ArrayType) and isinstance(data.elementType, T.StructType) else []
    taken = {"temporada", spec.SOURCE_FILE_COL, spec.LOAD_TIME_COL, RESCUED, BATCH, ORIGIN}
    stored, clashing = [], []
    for f in inner:
        (clashing if f.name.lower() in taken else stored).append(f)
        taken.add(f.name.lower())
    return stored, clashing


def _texts(fields: list[T.StructField]) -> str:
    """A struct type with a text for each field."""
    return f"struct<{','.join(quote(f.name) + ':string' for f in fields)}>".replace("'", "\\'")


#: Types whose values a JSON reader gives as a variant has them. Others (1.50, nested values, a field of several types) may differ.
_AS_WRITTEN = (T.LongType, T.StringType, T.BooleanType, T.NullType)


def bronze_rows(
    raw: DataFrame, schema: T.StructType, field: str = spec.DATA_FIELD, types: dict[str, T.DataType] | None = None
) -> DataFrame:
    """One row per match of the documents of :func:`raw_documents`, all values as text (T8 for the ingest).

    ``_rescatado`` has, as a JSON object, the values whose names cannot be columns, else NULL.

    ``types`` are those that :func:`document_types` found in these documents, whose ``value`` is then at hand. The
    fields of plain types are read of it, with their types; to cast every value of a variant to text is several times dearer.
    """
    stored, clashing = match_fields(schema, field)

    def as_written(name: str) -> bool:
        return types is not None and isinstance(types.get(name, T.NullType()), _AS_WRITTEN)

    def read_as(name: str) -> T.StructField:
        found = types.get(name) if types else None
        return T.StructField(name, found if isinstance(found, (T.LongType, T.BooleanType)) else T.StringType())

    def listed(fields: list[T.StructField]) -> Column:
        kind = _texts(fields)
        return F.coalesce(_got("v", f"$.{field}", f"array<{kind}>"), F.array(_got("v", f"$.{field}", kind)))

    read = [f for f in stored if as_written(f.name)]
    cast = [f for f in stored if f not in read]
    document = T.StructType([read_as("temporada"), T.StructField(field, T.ArrayType(T.StructType([read_as(f.name) for f in read])))])
    docs = raw
    if types is None:
        docs = docs.where("v is not null")
    elif read or as_written("temporada"):
        docs = docs.withColumn("leido", F.from_json("value", document, {"mode": "FAILFAST"}))
    season = F.col("leido.temporada").cast("string") if as_written("temporada") else _got("v", "$.temporada", "string")
    # The generator makes the texts: a projection below a filter on them would make them twice.
    parts = {"leido": F.col(f"leido.{quote(field)}")} if read else {}
    parts |= {"partido": listed(cast)} if cast or not read else {}
    parts |= {RESCUED: listed(clashing)} if clashing else {}
    found = docs.select(season.alias("temporada"), spec.SOURCE_FILE_COL, *[c.alias(n) for n, c in parts.items()])
    found = found.select("temporada", spec.SOURCE_FILE_COL, F.inline(F.arrays_zip(*parts))).where(F.col(next(iter(parts))).isNotNull())
    rescued = F.nullif(F.to_json(RESCUED), F.lit("{}")) if clashing else F.lit(None).cast("string")
    columns = [F.col(f"{'leido' if f in read else 'partido'}.{quote(f.name)}").cast("string").alias(f.name) for f in stored]
    return add_load_time(
        found.select(unfused(F.col("temporada")).alias("temporada"), spec.SOURCE_FILE_COL, *columns, rescued.alias(RESCUED))
    )


def stray_elements(raw: DataFrame, field: str = spec.DATA_FIELD) -> DataFrame:
    """(value, source file) of what stands in a match list and is no match, as JSON text."""
    found = document_elements(raw, field).where(F.col("e").isNotNull() & _got("e", "$", "struct<>").isNull())
    return found.select(F.to_json("e").alias("value"), spec.SOURCE_FILE_COL)


def _merge_types(a: T.DataType, b: T.DataType) -> T.DataType:
    if a == b:
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType):
        return a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merge_schemas(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(_merge_types(a.elementType, b.elementType), True)
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return T.DoubleType()
    return T.StringType()


def merge_schemas(old: T.StructType | None, new: T.StructType | None) -> T.StructType:
    """Union of fields, nested structs merged; known fields keep their place,
    new ones are appended. Conflicting primitive types widen to double or string."""
    if old is None:
        return new or T.StructType([])
    if new is None:
        return old
    incoming = {f.name: f for f in new.fields}
    fields = []
    for f in old.fields:
        if f.name in incoming:
            fields.append(T.StructField(f.name, _merge_types(f.dataType, incoming[f.name].dataType), True))
        else:
            fields.append(f)
    known = {f.name for f in old.fields}
    fields += [T.StructField(f.name, f.dataType, True) for f in new.fields if f.name not in known]
    return T.StructType(fields)


class SchemaStore:
    """Schema memory kept between runs (S3).

    Every batch merges the fields of its own documents into the memory before
    its rows are written, and writes a new version if that changed it.
    Versions are written through Spark, so the store works on any file system the
    cluster shares; a version appears only once its write committed.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def load(self) -> tuple[T.StructType | None, int]:
        try:
            versions = self.spark.read.schema("value string, v int").text(self.path)
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None, 0
            raise
        latest = versions.orderBy(F.col("v").desc()).first()
        if latest is None:
            return None, 0
        return T.StructType.fromJson(json.loads(latest["value"])), int(latest["v"])

    def merge(self, found: T.StructType) -> T.StructType:
        """The memory with the fields of ``found``."""
        old, version = self.load()
        merged = merge_schemas(old, found)
        if merged != old:
            doc = self.spark.createDataFrame([(json.dumps(merged.jsonValue()),)], "value string")
            doc.coalesce(1).write.mode("overwrite").text(f"{self.path}/v={version + 1}")
        return merged


def bronze_schema(doc_schema: T.StructType, field: str = spec.DATA_FIELD) -> T.StructType:
    """Schema of the rows :func:`to_bronze` makes from documents of ``doc_schema``.

    Lets a reader of the Bronze folder state its schema from the schema
    memory instead of merging the footers of every Bronze file.
    """
    season = next((f.dataType for f in doc_schema.fields if f.name == "temporada"), T.StringType())
    return T.StructType(
        [
            T.StructField("temporada", season, True),
            T.StructField(spec.SOURCE_FILE_COL, T.StringType(), True),
            *[T.StructField(f.name, f.dataType, True) for f in match_fields(doc_schema, field)[0]],
            T.StructField(spec.LOAD_TIME_COL, T.TimestampType(), True),
        ]
    )


def typed_columns(bronze: DataFrame, doc_schema: T.StructType) -> DataFrame:
    """Bronze rows with the remembered types; a value that does not fit gives NULL."""
    kinds = {f.name: f.dataType for f in bronze_schema(doc_schema).fields}
    plain = (T.LongType, T.DoubleType, T.BooleanType)
    return bronze.select(*[col(c).try_cast(kinds[c]).alias(c) if isinstance(kinds.get(c), plain) else col(c) for c in bronze.columns])


def explode_matches(docs: DataFrame, field: str = spec.DATA_FIELD, lineage: bool = True) -> DataFrame:
    """One row per match (P1, P2): season, source file, then every match field.

    The source file is captured before the explode (S5); a NULL, absent or empty
    match list gives no row.
    """
    keep = [F.col("temporada") if "temporada" in docs.columns else F.lit(None).cast("string").alias("temporada")]
    if lineage:
        known = spec.SOURCE_FILE_COL in docs.columns
        keep.append(F.col(spec.SOURCE_FILE_COL if known else "_metadata.file_path").alias(spec.SOURCE_FILE_COL))
    kind = docs.schema[field].dataType if field in docs.columns else None
    if not (isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType)):
        return docs.select(*keep).where(F.lit(False))
    one_per_match = docs.select(*keep, F.explode(F.col(quote(field))).alias("partido"))
    return one_per_match.select(*[c for c in one_per_match.columns if c != "partido"], "partido.*")


def add_load_time(df: DataFrame) -> DataFrame:
    """Appends ``_load_timestamp`` (P3): one value per batch or micro-batch."""
    return df.withColumn(spec.LOAD_TIME_COL, F.current_timestamp())


def to_bronze(docs: DataFrame, field: str = spec.DATA_FIELD, lineage: bool = True) -> DataFrame:
    """Bronze chain (T8): explode + flatten + load time."""
    return add_load_time(explode_matches(docs, field, lineage))
