"""Synthetic raw matches derived from the ``orders`` table.

The given tables hold no football data, so each order becomes one match,
row by row (a narrow projection: no shuffle, work grows with ``orders``).
With k = ``o_orderkey`` and c = ``o_custkey``:

* season = order year + 25 (1995-2001 -> 2020-2026); match day = order date + 300 months;
* home ``team_<c % 18>``, away ``team_<(c % 18 + 1 + k % 17) % 18>`` (never the home team);
* score ``Sin jugar`` when k % 23 = 0, ``2d - 1`` when k % 29 = 0, ``1e3 - 7f`` when
  k % 31 = 0 (texts that are no whole numbers), else ``(7k + c) % 5 - (3k + 11c) % 4``;
* date text by k % 3: ``dd-MM-yyyy`` / ``EEEE, MMMM d, yyyy`` / ``EEEE, MMMM d`` (no year);
* statistics: none in 2020, Spanish names in 2021, English names from 2022
  (missing when k % 5 = 0); possession has one name in both languages;
* statistic j (its index in the stat table): plain ``(k + j) % 20``;
  value+pct ``"<100 + (k + j) % 300> (<60 + k % 40>[.5 when k % 4 = 0]%)"``;
  possession ``"<35 + k % 30>[.5 when k % 7 = 0]%"``.

The frame has the landing layout: original field names (spaces, accents),
plain statistics as numbers, the others as strings.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchflow import spec
from pitchflow.functions.memo import app_key, per_application

TEAMS = 18
SEASON_SHIFT_YEARS = 25
SPANISH_SEASON = 2021
ENGLISH_FROM = 2022

ORDER_KEY = "o_orderkey"

#: Documents in a compressed landing file, which one task reads.
DOCUMENTS_PER_FILE = 64


def read_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet")


def _team(n: Column) -> Column:
    return F.concat(F.lit("team_"), F.lpad(n.cast("string"), 2, "0"))


def _stat_value(target: str, j: int, k: Column) -> Column:
    if target in spec.STATS_WITH_PCT:
        return F.concat(
            (F.lit(100) + (k + j) % 300).cast("string"),
            F.lit(" ("),
            (F.lit(60) + k % 40).cast("string"),
            F.when(k % 4 == 0, F.lit(".5")).otherwise(F.lit("")),
            F.lit("%)"),
        )
    if target in spec.STATS_PCT_ONLY:
        return F.concat(
            (F.lit(35) + k % 30).cast("string"),
            F.when(k % 7 == 0, F.lit(".5")).otherwise(F.lit("")),
            F.lit("%"),
        )
    return (k + j) % 20


def raw_matches(orders: DataFrame, keep_key: bool = False) -> DataFrame:
    """One raw match per order, with the landing field names and types.

    Per-row terms every field uses (season, match day, language flags) are
    computed once in a first projection; Catalyst keeps it separate rather
    than inline them into the 131 fields that reference them.
    """
    return orders.select(*_row_terms()).select(*_raw_columns(app_key(orders), keep_key))


def _row_terms() -> list[Column]:
    """What the fields of a match are made of, a few numbers a row."""
    season = (F.year("o_orderdate") + SEASON_SHIFT_YEARS).cast("bigint")
    return [
        F.col(ORDER_KEY),
        F.col("o_custkey"),
        season.alias("_season"),
        F.add_months(F.to_date("o_orderdate"), 12 * SEASON_SHIFT_YEARS).alias("_day"),
        (season == SPANISH_SEASON).alias("_spanish"),
        ((season >= ENGLISH_FROM) & (F.col(ORDER_KEY) % 5 != 0)).alias("_english"),
    ]


@per_application
def _raw_columns(keep_key: bool) -> list[Column]:
    return _fields_of(F.col, keep_key)


def _fields_of(term: Callable[[str], Column], keep_key: bool = False) -> list[Column]:
    """The fields of a match, of the terms of :func:`_row_terms` that ``term`` gives by name."""
    k, c = term(ORDER_KEY), term("o_custkey")
    day, season = term("_day"), term("_season")
    score = (
        F.when(k % 23 == 0, F.lit("Sin jugar"))
        .when(k % 29 == 0, F.lit("2d - 1"))
        .when(k % 31 == 0, F.lit("1e3 - 7f"))
        .otherwise(F.concat(((7 * k + c) % 5).cast("string"), F.lit(" - "), ((3 * k + 11 * c) % 4).cast("string")))
    )
    fecha = (
        F.when(k % 3 == 0, F.date_format(day, "dd-MM-yyyy"))
        .when(k % 3 == 1, F.date_format(day, "EEEE, MMMM d, yyyy"))
        .otherwise(F.date_format(day, "EEEE, MMMM d"))
    )
    cols = [
        season.alias("temporada"),
        fecha.alias("fecha"),
        _team(c % TEAMS).alias("local"),
        _team((c % TEAMS + 1 + k % 17) % TEAMS).alias("visitante"),
        score.alias("marcador"),
        F.concat(F.lit("match/"), k.cast("string")).alias("url"),
    ]
    spanish, english = term("_spanish"), term("_english")
    spanish_cols, english_cols = [], []
    for j, (es, en, target) in enumerate(spec.STATS):
        value = _stat_value(target, j, k)
        if es == en:
            spanish_cols.append(F.when(spanish | english, value).alias(es))
        else:
            spanish_cols.append(F.when(spanish, value).alias(es))
            english_cols.append(F.when(english, value).alias(en))
    key = [k] if keep_key else []
    return [*key, *cols, *spanish_cols, *english_cols]


def season_documents(orders: DataFrame, keys_per_document: int = 5000) -> DataFrame:
    """Landing documents ``{temporada, data: [match, ...]}``.

    A document holds the matches of one season whose order keys fall in one
    block of ``keys_per_document`` consecutive keys. Keys are unique, so no
    document can hold more than that many matches however the seasons or
    teams are skewed, and ``collect_list`` never gathers an unbounded group.
    ``doc`` is the document id, for writers that lay out one document per file.

    Only the terms of the matches are dealt out by document; their fields, many times
    as wide, are made of the terms afterwards, document by document.
    """
    return documents_made_of(orders, lambda key, season, fields: F.struct(*fields), keys_per_document)


def documents_made_of(orders: DataFrame, match: Callable[[Column, Column, list[Column]], Column], keys_per_document: int) -> DataFrame:
    """:func:`season_documents` with other matches: ``match`` makes one of its order key, its season and its other fields."""
    terms = orders.select(*_row_terms())
    docs = _grouped(terms, "_season", F.struct(*terms.columns), keys_per_document)
    made = F.transform(spec.DATA_FIELD, lambda m: match(m[ORDER_KEY], m["_season"], _fields_of(lambda name: m[name])[1:]))
    return docs.withColumn(spec.DATA_FIELD, made)


def documents_of(raw: DataFrame, keys_per_document: int) -> DataFrame:
    """Raw matches with their order key, as landing documents (see :func:`season_documents`)."""
    fields = [c for c in raw.columns if c not in (ORDER_KEY, "temporada")]
    return _grouped(raw, "temporada", F.struct(*[F.col(f"`{f}`") for f in fields]), keys_per_document)


def _grouped(rows: DataFrame, season: str, match: Column, keys_per_document: int) -> DataFrame:
    block = F.floor(F.col(ORDER_KEY) / F.lit(keys_per_document))
    return (
        rows.groupBy(F.col(season).alias("temporada"), block.alias("block"))
        .agg(F.collect_list(match).alias(spec.DATA_FIELD))
        .select(
            F.format_string("%d-%06d", F.col("temporada"), F.col("block")).alias("doc"),
            "temporada",
            spec.DATA_FIELD,
        )
    )


def write_documents(docs: DataFrame, path: str, one_document_per_file: bool = False, compression: str | None = None) -> str:
    """Write landing documents as JSON.

    By default JSON Lines (one document per line, many per file). With
    ``one_document_per_file`` each document goes to its own file under
    ``doc=<id>/``, the layout of a multi-line landing drop. NULL fields are
    left out, as a source that lacks a statistic would do. ``compression`` names
    a codec; a compressed file cannot be split, so files end after some documents.
    """
    written = docs if one_document_per_file else docs.drop("doc")
    writer = written.write.mode("errorifexists")
    if compression:
        writer = writer.option("compression", compression).option("maxRecordsPerFile", DOCUMENTS_PER_FILE)
    if one_document_per_file:
        writer.partitionBy("doc").json(path)
    else:
        writer.json(path)
    return path
