"""Sorts and top-k. PostgreSQL puts NULLs first on DESC and
last on ASC (D10); these helpers do the same."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key(spec) -> Column:
    """``'col'`` / ``'-col'`` (descending) / Column -> sort Column, PG null order."""
    if isinstance(spec, Column):
        return spec
    if spec.startswith("-"):
        return F.col(spec[1:]).desc_nulls_first()
    return F.col(spec).asc_nulls_last()


def sort(df: DataFrame, keys: Sequence) -> DataFrame:
    """O1 / O2: global sort (range-partitioned by Spark)."""
    return df.orderBy(*[key(k) for k in keys])


def top(df: DataFrame, k: int, keys: Sequence) -> DataFrame:
    """O3: top-k; planned as TakeOrderedAndProject (k rows per task, merged)."""
    return df.orderBy(*[key(x) for x in keys]).limit(k)
