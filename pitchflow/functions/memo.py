"""Build spec-driven column expressions once per Spark application.

A wide projection built from the spec is thousands of Python -> JVM calls
to construct, every time a DataFrame is built. The expressions only depend
on the spec and the input schema, and an unresolved ``Column`` can be reused
by any number of DataFrames, so they are built once per application and
input schema. The application is named explicitly by the caller (from the
input DataFrame), so a cached expression never outlives its JVM, whatever
thread asks.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import DataFrame

T = TypeVar("T")


def app_key(df: DataFrame) -> str:
    """The application the DataFrame belongs to (first argument of memoized builders)."""
    return df.sparkSession.sparkContext.applicationId


def schema_key(df: DataFrame) -> str:
    return df.schema.json()


def per_application(fn: Callable[..., T]) -> Callable[..., T]:
    """Memoize ``fn(app, *hashable_args)``; ``app`` is :func:`app_key` of the input."""
    cache: dict[tuple, T] = {}

    @functools.wraps(fn)
    def wrapper(app: str, *args):
        key = (app, *args)
        if key not in cache:
            if len(cache) > 256:
                cache.clear()
            cache[key] = fn(*args)
        return cache[key]

    return wrapper
