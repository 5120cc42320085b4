"""Column expressions for the cleaning layer.

Every function maps ``Column -> Column`` with built-in Spark functions only,
so the work stays inside whole-stage codegen. Each one is ANSI-safe: a value
that does not parse gives NULL, never an error, whatever
``spark.sql.ansi.enabled`` says.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pitchflow import spec


def as_text(col: Column) -> Column:
    """Any primitive as its string form (ints, doubles and strings alike)."""
    return col.cast("string")


def to_int(col: Column) -> Column:
    """Whole number of a text or a number, as a non-ANSI cast gives it.

    Text must be digits with an optional sign and decimal tail, which is cut
    off: ``" 15"`` and ``"8.9"`` give 15 and 8; ``"1e3"``, ``"2d"`` and junk give
    NULL. Numbers are truncated. The pattern is only tried on what is no plain integer.
    """
    cut = F.regexp_extract(as_text(col), r"^\s*([+-]?\d+)(?:\.\d*)?\s*$", 1).try_cast("int")
    return F.coalesce(col.try_cast("int"), F.when(F.typeof(col) == "string", cut))


def to_double(col: Column) -> Column:
    return col.try_cast("double")


def strip_weekday(raw: Column) -> Column:
    """``"Friday, May 2, 2025"`` -> ``"May 2, 2025"``; other strings unchanged."""
    return F.regexp_replace(raw, spec.WEEKDAY_PREFIX_RE, "")


def parse_match_date(raw: Column, season: Column) -> Column:
    """Three-format date cascade; the year comes from the season when missing.

    1. ``dd-MM-yyyy``                       ``02-05-2025``
    2. weekday stripped, ``MMMM d, yyyy``   ``Friday, May 2, 2025``
    3. weekday stripped + ``", <season>"``  ``Friday, May 2``

    The formats exclude each other by their first character and their comma, so
    each text is parsed by the only format it can have: a failed parse costs an exception.
    """
    no_weekday = strip_weekday(raw)
    with_season = F.concat(no_weekday, F.lit(", "), as_text(season))
    return (
        F.when(raw.between("0", "9~"), F.try_to_date(raw, spec.DATE_FORMAT_NUMERIC))
        .when(F.contains(no_weekday, F.lit(",")), F.try_to_date(no_weekday, spec.DATE_FORMAT_TEXT_EN))
        .otherwise(F.try_to_date(with_season, spec.DATE_FORMAT_TEXT_EN))
    )


def score_goals(score: Column) -> tuple[Column, Column]:
    """``"2 - 1"`` -> (2, 1); ``"Sin jugar"`` -> (NULL, NULL); out-of-range parts are NULL."""
    home, away = (F.split_part(score, F.lit(spec.SCORE_SEPARATOR_RE), F.lit(i)) for i in (1, 2))
    return to_int(home), to_int(away)


def result_letter(home_goals: Column, away_goals: Column) -> Column:
    """Result from the home side's view: ``L`` home win, ``V`` away win, ``E`` draw, else NULL."""
    return (
        F.when(home_goals > away_goals, F.lit(spec.RESULT_HOME_WIN))
        .when(home_goals < away_goals, F.lit(spec.RESULT_AWAY_WIN))
        .when(home_goals == away_goals, F.lit(spec.RESULT_DRAW))
        .otherwise(F.lit(None).cast("string"))
    )


def value_part(raw: Column) -> Column:
    """``"51 (72%)"`` -> 51; a plain ``9`` -> 9."""
    return F.regexp_extract(as_text(raw), spec.LEADING_INT_RE, 1).try_cast("int")


def pct_part(raw: Column) -> Column:
    """``"51 (72%)"`` -> 72.0; ``"8 (12.5%)"`` -> 12.5; no bracket -> NULL."""
    return to_double(F.regexp_extract(as_text(raw), spec.BRACKET_PCT_RE, 1))


def percent_only(raw: Column) -> Column:
    """``"38%"`` -> 38; ``"51.7%"`` -> 51 (truncated)."""
    return F.substring_index(F.regexp_extract(as_text(raw), spec.FIRST_NUMBER_RE, 1), ".", 1).try_cast("int")


def flag(cond: Column) -> Column:
    """1 when the condition holds, else 0 (NULL counts as 0)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))
