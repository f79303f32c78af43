"""Helpers for plans that the optimizer would make do work twice."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def where_computed(df: DataFrame, condition: str) -> DataFrame:
    """Filters after the columns are made.

    Moved below the projections, a condition on a column that is dear to make would be
    evaluated there once more; the optimizer moves nothing below a column that isn't
    deterministic.
    """
    return df.withColumn("_at", F.monotonically_increasing_id()).filter(f"({condition}) and _at >= 0").drop("_at")


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is made once, however often and deep in lambdas it is used:
    a column of its own would be put into the lambdas, and made at each of their turns."""
    return F.get(F.transform(F.array(value), use), 0)
