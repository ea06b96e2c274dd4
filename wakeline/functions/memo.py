"""Reuse of built Column expressions.

Large expressions (the 26-field parse, the load checks) take hundreds of py4j
calls to build; they are unresolved expressions, so one built instance serves
every DataFrame of the same SparkContext.
"""

from __future__ import annotations

import functools

from pyspark import SparkContext


def per_context(fn):
    """Memoize ``fn(*hashable_args)`` per active SparkContext."""
    cache: dict = {}

    @functools.wraps(fn)
    def wrapper(*args):
        sc = SparkContext._active_spark_context
        key = (id(sc), sc.applicationId if sc is not None else None, args)
        if key not in cache:
            cache[key] = fn(*args)
        return cache[key]

    return wrapper
