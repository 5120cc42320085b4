"""Silver: from Bronze match rows to canonical typed rows.

Every step is a narrow ``DataFrame -> DataFrame`` projection (no shuffle, no
action), so the chain collapses into one stage and runs unchanged on batch
and streaming input.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchflow import spec
from pitchflow.functions import names, parsing
from pitchflow.functions.memo import app_key, per_application, schema_key
from pitchflow.operators.columns import check_distinct


def _fields(schema: str) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in T.StructType.fromJson(json.loads(schema)).fields}


def _lookup(fields: dict[str, T.DataType], landing_name: str) -> Column | None:
    """Column for a landing field, by sanitized name first, then as written."""
    for candidate in (names.sanitized(landing_name), landing_name):
        if candidate in fields:
            return names.col(candidate)
    return None


def _null(type_name: str) -> Column:
    return F.lit(None).cast(type_name)


def _lookup_or_null(fields: dict[str, T.DataType], landing_name: str, type_name: str) -> Column:
    found = _lookup(fields, landing_name)
    return _null(type_name) if found is None else found


def _field_type(fields: dict[str, T.DataType], landing_name: str) -> T.DataType | None:
    return fields.get(names.sanitized(landing_name), fields.get(landing_name))


def unify_languages(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Base projection plus one column per statistic, Spanish before English.

    * base fields are renamed to their Silver names, season cast to int;
    * each statistic becomes ``coalesce(spanish, english)`` under its Silver name;
      when the two sides have different types both go through string first;
    * a field present in no file becomes a typed NULL instead of an error.

    Field names are looked up sanitized first, then as written, so the input
    may be Bronze as stored or after :func:`sanitize_column_names`. Columns in
    ``keep`` are passed through as they are.
    """
    return df.select(*keep, *_unify_columns(app_key(df), schema_key(df)))


@per_application
def _unify_columns(schema: str) -> list[Column]:
    df = _fields(schema)
    base = [parsing.to_int(_lookup_or_null(df, "temporada", "string")).alias("temporada")]
    for landing, silver in spec.BASE_RENAMES.items():
        base.append(_lookup_or_null(df, landing, "string").alias(silver))
    for landing, silver in spec.AUDIT_RENAMES.items():
        kind = "timestamp" if landing == spec.LOAD_TIME_COL else "string"
        base.append(_lookup_or_null(df, landing, kind).alias(silver))

    stats = []
    for es, en, silver in spec.STATS:
        sides = [(c, _field_type(df, n)) for n in dict.fromkeys([es, en]) if (c := _lookup(df, n)) is not None]
        if not sides:
            expr = _null("string")
        elif len(sides) == 1:
            expr = sides[0][0]
        elif sides[0][1] == sides[1][1]:
            expr = F.coalesce(sides[0][0], sides[1][0])
        else:
            expr = F.coalesce(*[parsing.as_text(c) for c, _ in sides])
        stats.append(expr.alias(silver))
    return [*base, *stats]


def parse_dates(df: DataFrame) -> DataFrame:
    """``fecha_raw`` (string) -> ``fecha`` (date); the raw column is dropped."""
    return df.select(*_date_columns(app_key(df), tuple(df.columns)))


@per_application
def _date_columns(columns: tuple[str, ...]) -> list[Column]:
    fecha = parsing.parse_match_date(F.col("fecha_raw"), F.col("temporada")).alias("fecha")
    return [*[names.col(c) for c in columns if c != "fecha_raw"], fecha]


def parse_score(df: DataFrame) -> DataFrame:
    """Adds ``goles_local``, ``goles_visitante`` and ``resultado`` from ``marcador``."""
    goals, result = _score_columns(app_key(df))
    return df.withColumns(goals).withColumns(result)


@per_application
def _score_columns() -> tuple[dict[str, Column], dict[str, Column]]:
    home, away = parsing.score_goals(F.col("marcador"))
    result = parsing.result_letter(F.col("goles_local"), F.col("goles_visitante"))
    return {"goles_local": names.unfused(home), "goles_visitante": away}, {"resultado": names.unfused(result)}


def split_value_pct(df: DataFrame) -> DataFrame:
    """``"340 (80%)"`` -> ``<c>`` 340 and ``<c>_pct`` 80.0; ``"45%"`` -> 45 (T4, T5).

    Listed columns missing from the input are skipped (T6).
    """
    replaced = _split_columns(app_key(df), frozenset(df.columns))
    return df.withColumns(replaced) if replaced else df


@per_application
def _split_columns(present: frozenset[str]) -> dict[str, Column]:
    replaced: dict[str, Column] = {}
    for c in spec.STATS_WITH_PCT:
        if c in present:
            replaced[c] = parsing.value_part(F.col(c))
            replaced[f"{c}_pct"] = parsing.pct_part(F.col(c))
    for c in spec.STATS_PCT_ONLY:
        if c in present:
            replaced[c] = parsing.percent_only(F.col(c))
    return replaced


def _cast(c: Column, source: T.DataType, target: str) -> Column:
    if target == "int":
        if isinstance(source, T.StringType):
            return parsing.to_int(c)
        return c.try_cast("int")
    if target == "double":
        return c.try_cast("double")
    return c.try_cast(target)


def cast_to_schema(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Select the declared Silver columns in declared order, each cast to its type, after the columns in ``keep``."""
    return df.select(*keep, *_schema_columns(app_key(df), schema_key(df)))


@per_application
def _schema_columns(schema: str) -> list[Column]:
    fields = _fields(schema)
    out = []
    for column in spec.silver_schema():
        if column.name in fields:
            source = fields[column.name]
            if source.simpleString() == column.type:
                out.append(F.col(column.name))
            else:
                out.append(_cast(F.col(column.name), source, column.type).alias(column.name))
        else:
            out.append(_null(column.type).alias(column.name))
    return out


def silver_matches(bronze: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The whole Silver chain (T9): sanitize, unify, dates, score, value/pct, types.

    Unification reads every field by its sanitized name or as written and
    drops the rest, so sanitizing needs no projection of its own here; its
    collision check still runs. Columns in ``keep`` are passed through, in front.
    """
    check_distinct(bronze.columns)
    return (
        bronze.transform(unify_languages, keep)
        .transform(parse_dates)
        .transform(parse_score)
        .transform(split_value_pct)
        .transform(cast_to_schema, keep)
    )
