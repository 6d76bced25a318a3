"""Stable buckets of an id."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def stable_bucket(column: str | Column, buckets: int | Column, method: str = "murmur3") -> Column:
    """Bucket ``0 .. buckets - 1`` of an id, the same on every run.

    ``murmur3`` is Spark's own ``hash``; its value is widened before ``abs``, which would otherwise fail
    on the smallest int. ``md5`` can be computed by any engine.
    """
    column = F.col(column) if isinstance(column, str) else column
    if method == "murmur3":
        value = F.abs(F.hash(column).cast("long"))
    elif method == "md5":
        value = F.conv(F.substring(F.md5(column), 1, 8), 16, 10).cast("long")
    else:
        raise ValueError(f"unknown bucket method {method!r}")
    return value % buckets
