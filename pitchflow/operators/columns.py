"""Name-level projections: rename by dictionary (P4) and sanitize (P5)."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame

from pitchflow.functions.names import sanitized


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Give the columns that ``mapping`` names their new names, spaces, dots and accents taken literally."""
    return df.withColumnsRenamed(mapping)


def sanitize_column_names(df: DataFrame) -> DataFrame:
    """Spaces in column names become ``_``; see :func:`check_distinct`."""
    return df.toDF(*check_distinct(df.columns))


def check_distinct(columns: list[str]) -> list[str]:
    """The sanitized names, in order.

    Raises ``ValueError`` when two columns would share one (``"A b"`` and ``"A_b"``),
    since Spark could not tell them apart.
    """
    clean = [sanitized(c) for c in columns]
    repeated = [n for n, many in Counter(n.lower() for n in clean).items() if many > 1]
    if repeated:
        clash = [c for c, n in zip(columns, clean, strict=True) if n.lower() in repeated]
        raise ValueError(f"sanitizing makes these the same column name: {clash}")
    return clean
