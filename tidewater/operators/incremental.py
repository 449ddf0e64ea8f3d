"""Incremental batch and calendar helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators.joins import without
from tidewater.operators.filters import _day


def lookback(df: DataFrame, ts_col: str, as_of, days: int) -> DataFrame:
    """Rows of the ``days`` days up to and including ``as_of``; re-loading
    them is safe because the upsert is idempotent."""
    d = _day(as_of)
    return df.filter((F.col(ts_col) >= F.date_sub(d, days)) & (F.col(ts_col) < F.date_add(d, 1)))


def bounds(df: DataFrame, col: str, start: str = "start", end: str = "end") -> DataFrame:
    """One-row frame of the first and last day of ``col`` (partial aggregate)."""
    return df.agg(F.min(F.to_date(col)).alias(start), F.max(F.to_date(col)).alias(end))


def date_chunks(span: DataFrame, n: int, start: str = "start", end: str = "end") -> DataFrame:
    """``n``-day chunks with inclusive ends; the last chunk is clipped."""
    return (span.select(F.explode(F.sequence(F.col(start), F.col(end), F.expr(f"INTERVAL {n} DAYS"))).alias("chunk_inicio"),
                        F.col(end).alias("_end"))
                .select("chunk_inicio", F.least(F.date_add("chunk_inicio", n - 1), F.col("_end")).alias("chunk_fim")))


def calendar(span: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """one row per day with year, month, ``MMM/yyyy`` and quarter label.

    Its size is the number of days in the span, not the size of the data."""
    d = F.col("data")
    return (span.select(F.explode(F.sequence(F.col(start), F.col(end))).alias("data"))
                .select(d, F.year(d).alias("ano"), F.month(d).alias("mes"),
                        F.date_format(d, "MMM/yyyy").alias("mes_nome"),
                        F.concat(F.lit("T"), F.quarter(d).cast("string")).alias("trimestre")))


def missing_days(df: DataFrame, col: str, span: DataFrame | None = None) -> DataFrame:
    """T4: days of the span with no row in ``df``."""
    span = span if span is not None else bounds(df, col)
    days = calendar(span).select("data")
    loaded = df.select(F.to_date(col).alias("data"))
    return without(days, loaded, "data").select(F.col("data").alias("dia"))


def gone(ids: DataFrame, snapshot: DataFrame, key: str, snapshot_key: str | None = None) -> DataFrame:
    """T5: ids (e.g. those in PAUSED) that the latest snapshot no longer has."""
    return without(ids.select(key), snapshot, key, snapshot_key or key)


def work_list(df: DataFrame, key: str) -> DataFrame:
    """Distinct ids to fetch next."""
    return df.select(key).distinct()
