"""Joins of a large table with one that is expected to be small."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from stintlake.session import stage


def join_small(left: DataFrame, right: DataFrame, on: list[str] | Column, how: str = "left") -> DataFrame:
    """Join with ``right`` staged, so that the planner broadcasts it only if its bytes allow.

    The size of an aggregate is not known before it has run; Spark would then
    shuffle the large side by what may be a handful of keys. A staged table has
    a size.
    """
    return left.join(stage(right, "small"), on, how)
