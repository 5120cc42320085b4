"""Edge values of the cleaning expressions, in both ANSI modes."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pitchflow.functions import parsing


def _one(spark, expr, rows, schema):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr.alias("v")).collect()]


@pytest.mark.parametrize(
    "raw, season, expected",
    [
        ("09-11-2024", 2024, dt.date(2024, 11, 9)),
        ("Saturday, November 9, 2024", 2024, dt.date(2024, 11, 9)),
        ("Friday, May 8", 2026, dt.date(2026, 5, 8)),
        ("October 3", 2023, dt.date(2023, 10, 3)),
        ("not a date", 2021, None),
        (None, 2021, None),
    ],
)
def test_parse_match_date(spark, ansi, raw, season, expected):
    got = _one(
        spark,
        parsing.parse_match_date(F.col("raw"), F.col("season")),
        [(raw, season)],
        "raw string, season int",
    )
    assert got == [expected]


@pytest.mark.parametrize(
    "score, home, away, letter",
    [
        ("2 - 1", 2, 1, "L"),
        ("1 - 3", 1, 3, "V"),
        ("0 - 0", 0, 0, "E"),
        ("Sin jugar", None, None, None),
        ("2d - 1", None, 1, None),
        ("1e3 - 7f", None, None, None),
        ("2 - 1 (4-3)", 2, None, None),
        (None, None, None, None),
    ],
)
def test_score(spark, ansi, score, home, away, letter):
    h, a = parsing.score_goals(F.col("m"))
    df = spark.createDataFrame([(score,)], "m string").select(
        h.alias("h"), a.alias("a"), parsing.result_letter(h, a).alias("r")
    )
    assert tuple(df.first()) == (home, away, letter)


@pytest.mark.parametrize(
    "raw, value, pct",
    [
        ("271 (83%)", 271, 83.0),
        ("120 (62.5%)", 120, 62.5),
        ("12", 12, None),
        ("junk", None, None),
        (None, None, None),
    ],
)
def test_value_pct(spark, ansi, raw, value, pct):
    df = spark.createDataFrame([(raw,)], "s string").select(
        parsing.value_part(F.col("s")).alias("v"), parsing.pct_part(F.col("s")).alias("p")
    )
    assert tuple(df.first()) == (value, pct)


def test_value_pct_from_numbers(spark, ansi):
    df = spark.createDataFrame([(12,)], "s bigint").select(
        parsing.value_part(F.col("s")).alias("v"), parsing.pct_part(F.col("s")).alias("p")
    )
    assert tuple(df.first()) == (12, None)


@pytest.mark.parametrize("raw, expected", [("38%", 38), ("61.5%", 61), ("n/a", None), (None, None)])
def test_percent_only(spark, ansi, raw, expected):
    assert _one(spark, parsing.percent_only(F.col("s")), [(raw,)], "s string") == [expected]


@pytest.mark.parametrize("raw, expected", [("12", 12), ("12.0", 12), ("61.5", 61), (" +7 ", 7), ("-3.", -3), ("", None), ("x", None), ("1e3", None), ("2d", None), ("7f", None), ("99999999999", None)])
def test_to_int(spark, ansi, raw, expected):
    assert _one(spark, parsing.to_int(F.col("s")), [(raw,)], "s string") == [expected]
