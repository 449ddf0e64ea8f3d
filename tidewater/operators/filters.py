"""Predicates. Written on typed columns so that Catalyst pushes
them into the Parquet scan (``PushedFilters``); JSON-path predicates cannot
push down, which is why silver views are projected first."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _day(d) -> Column:
    if isinstance(d, Column):
        return d
    if isinstance(d, str):
        d = dt.date.fromisoformat(d)
    return F.lit(d)


def where_path(df: DataFrame, col, value) -> DataFrame:
    """Equality on a column or a ``path(...)`` Column."""
    return df.filter(_c(col) == F.lit(value))


def where_in(df: DataFrame, col, values: Iterable) -> DataFrame:
    """P2."""
    return df.filter(_c(col).isin(list(values)))


def where_present(df: DataFrame, col, present: bool = True) -> DataFrame:
    """``IS NOT NULL`` (or ``IS NULL``)."""
    return df.filter(_c(col).isNotNull() if present else _c(col).isNull())


def since(df: DataFrame, col, day) -> DataFrame:
    """P5: ``col::date >= day`` -- written as a bound on the column itself so
    that it reaches the scan (``col >= day 00:00``)."""
    return df.filter(_c(col) >= _day(day))


def in_period(df: DataFrame, col, lo, hi) -> DataFrame:
    """``col::date BETWEEN lo AND hi`` (both ends inclusive)."""
    return df.filter((_c(col) >= _day(lo)) & (_c(col) < F.date_add(_day(hi), 1)))


def since_any(df: DataFrame, cols: Sequence, day) -> DataFrame:
    """Any of the dates on or after ``day`` (``a >= d OR b >= d``)."""
    return df.filter(reduce(lambda a, b: a | b, [F.coalesce(_c(c) >= _day(day), F.lit(False)) for c in cols]))


def last_days(df: DataFrame, col, as_of, n: int) -> DataFrame:
    """``col >= as_of - n days`` up to the end of ``as_of``; ``as_of`` is a
    parameter (not ``now()``) so results repeat."""
    d = _day(as_of)
    return df.filter((_c(col) >= F.date_sub(d, n)) & (_c(col) < F.date_add(d, 1)))


def missing_any(df: DataFrame, flags: Sequence) -> DataFrame:
    """P10: ``NOT a OR NOT b``."""
    return df.filter(reduce(lambda a, b: a | b, [~_c(f) for f in flags]))


def where_nonzero(df: DataFrame, col) -> DataFrame:
    """``col::numeric <> 0``."""
    return df.filter(_c(col).try_cast("decimal(38,18)") != F.lit(0))


def where_if(df: DataFrame, col, value=None) -> DataFrame:
    """Filter only when a value is given."""
    return df if value is None else df.filter(_c(col) == F.lit(value))


def filter_sales(df: DataFrame, hotel=None, status=None, start=None, end=None,
                 day_col: str = "data", hotel_col: str = "hotel", status_col: str = "status") -> DataFrame:
    """Mart filters; each argument optional."""
    df = where_if(df, hotel_col, hotel)
    df = where_if(df, status_col, status)
    if start is not None:
        df = df.filter(_c(day_col) >= _day(start))
    if end is not None:
        df = df.filter(_c(day_col) <= _day(end))
    return df


def by_key(df: DataFrame, col, value) -> DataFrame:
    """Key lookup (Parquet min/max statistics skip row groups)."""
    return df.filter(_c(col) == F.lit(value))


def changed_between(df: DataFrame, col, lo, hi=None) -> DataFrame:
    """Changed since ``lo`` (inclusive), optionally before ``hi`` (exclusive)."""
    out = df.filter(_c(col) >= _day(lo))
    return out if hi is None else out.filter(_c(col) < _day(hi))


def starting_from(df: DataFrame, col, day) -> DataFrame:
    """Occurrences that start on or after ``day``."""
    return df.filter(_c(col) >= _day(day))


def not_future(df: DataFrame, col, as_of) -> DataFrame:
    """Drop rows dated after ``as_of``."""
    return df.filter(_c(col) < F.date_add(_day(as_of), 1))
