"""Reuse of built Column expressions.

Building a large expression costs one JVM round trip per function call. Columns are immutable and refer to
input columns by name only, so an expression list built once can be reused by every DataFrame of the same
SparkContext. ``column_cache`` memoises a builder per (active SparkContext, arguments).
"""

from __future__ import annotations

import functools

from pyspark import SparkContext


def column_cache(fn):
    cache: dict = {}

    @functools.wraps(fn)
    def wrapper(*args, **kwargs):
        sc = SparkContext._active_spark_context
        key = (id(sc), getattr(sc, "applicationId", None) if sc else None, args, tuple(sorted(kwargs.items())))
        try:
            return cache[key]
        except KeyError:
            value = fn(*args, **kwargs)
            cache[key] = value
            return value
        except TypeError:  # unhashable arguments: build without caching
            return fn(*args, **kwargs)

    wrapper.cache_clear = cache.clear
    return wrapper
