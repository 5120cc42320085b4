"""Helpers for column names that carry spaces, accents or dots, and for wide projections."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quote(name: str) -> str:
    """Backtick-quote a column name so dots and spaces are taken literally."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """``F.col`` for an arbitrary literal name."""
    return F.col(quote(name))


def sanitized(name: str) -> str:
    """Spaces become underscores: ``"Accurate crosses_local"`` -> ``"Accurate_crosses_local"``."""
    return name.replace(" ", "_")


def unfused(value: Column) -> Column:
    """``value``, by way of a lambda; for one column of a wide projection.

    Spark fuses a projection with its neighbours into one method, and the JVM runs a method of over 8000 bytes
    uncompiled. A projection with a lambda is not fused: it is cut into short methods, which are compiled.
    """
    return F.transform(F.array(value), lambda v: v)[0]
