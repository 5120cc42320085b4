from __future__ import annotations

import pytest

from pitchflow.operators.columns import rename_columns, sanitize_column_names


def test_sanitize_replaces_spaces(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "`Accurate crosses_local` int, `Posesión_local` int, `x. y` int, url int")
    assert sanitize_column_names(df).columns == ["Accurate_crosses_local", "Posesión_local", "x._y", "url"]


def test_sanitize_keeps_clean_names(spark):
    df = spark.createDataFrame([(1,)], "a_b int")
    assert sanitize_column_names(df).columns == ["a_b"]


def test_sanitize_collision_raises(spark):
    df = spark.createDataFrame([(1, 2)], "`A b` int, A_b int")
    with pytest.raises(ValueError):
        sanitize_column_names(df)


def test_rename_keeps_unlisted(spark):
    df = spark.createDataFrame([(1, 2, 3)], "fecha int, `a.b` int, other int")
    out = rename_columns(df, {"fecha": "fecha_raw", "a.b": "ab"})
    assert out.columns == ["fecha_raw", "ab", "other"]
    assert tuple(out.first()) == (1, 2, 3)
