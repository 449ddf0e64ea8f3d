"""Aggregations. All are partial (map-side) aggregates, so a
group that holds a third of the rows is combined in every task before the
shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.joins import left_lookup


def _list(x) -> list:
    return [x] if isinstance(x, str) else list(x)


def count_where(cond: Column) -> Column:
    """``COUNT(*) FILTER (WHERE cond)``."""
    return F.count_if(F.coalesce(cond, F.lit(False)))


def sum_where(col: Column, cond: Column, zero_if_empty: bool = True) -> Column:
    """``COALESCE(SUM(col) FILTER (WHERE cond), 0)``."""
    s = F.sum(F.when(cond, col))
    return F.coalesce(s, F.lit(0)) if zero_if_empty else s


def mart(df: DataFrame, by: Sequence, measures: Mapping[str, Column]) -> DataFrame:
    """Grouped conditional measures; ``by`` may hold expressions."""
    by = [F.col(b) if isinstance(b, str) else b for b in by]
    return df.groupBy(*by).agg(*[c.alias(n) for n, c in measures.items()])


def coverage(left: DataFrame, right: DataFrame, key: str, by: Sequence[str],
             right_key: str | None = None, names=("total", "com", "sem")) -> DataFrame:
    """Per group, rows of ``left``, how many have a match in
    ``right`` and how many do not (``COUNT(*)``, ``COUNT(r.key)``)."""
    rk = right_key or key
    keys = right.select(F.col(rk).alias("_cov_key")).distinct()
    j = left_lookup(left.select(*by, key), keys.withColumn("_cov_hit", F.col("_cov_key")),
                    key, "_cov_key", ["_cov_hit"], grows=True)
    total, com, sem = names
    return (j.groupBy(*by)
             .agg(F.count(F.lit(1)).alias(total), F.count("_cov_hit").alias(com))
             .withColumn(sem, F.col(total) - F.col(com)))


def main_value(df: DataFrame, by, col: str, name: str = "main", count_name: str | None = None) -> DataFrame:
    """``MODE() WITHIN GROUP (ORDER BY col)`` per group; ties -> smallest.

    Two partial aggregates: counts per (group, value), then per group the value
    with ``min_by(value, (-count, value))``. NULL values never win (as in
    PostgreSQL's ``mode``) but still count in ``count_name`` (``COUNT(*)``)."""
    by = _list(by)
    counts = df.groupBy(*by, col).agg(F.count(F.lit(1)).alias("_n"))
    present = F.col(col).isNotNull()
    aggs = [F.min_by(F.col(col), F.when(present, F.struct(-F.col("_n"), F.col(col)))).alias(name)]
    if count_name:
        aggs.append(F.sum("_n").alias(count_name))
    return counts.groupBy(*by).agg(*aggs)


def count_distinct_tuple(*cols) -> Column:
    """``COUNT(DISTINCT (a, b, c))`` -- a row value, so tuples with a NULL
    field still count (unlike ``count(DISTINCT a, b, c)``)."""
    return F.count_distinct(F.struct(*[F.col(c) if isinstance(c, str) else c for c in cols]))


def sum_decimal(col, p: int = 12, s: int = 2) -> Column:
    """``SUM(x::numeric(p,s))`` -- exact, order independent."""
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(c.cast(f"decimal({p},{s})"))


def table_counts(tables: Mapping[str, DataFrame], name_col: str = "tabela",
                 count_col: str = "registros") -> DataFrame:
    """One row per table with its row count, stacked."""
    parts = [df.agg(F.count(F.lit(1)).alias(count_col)).select(F.lit(n).alias(name_col), count_col)
             for n, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def nest(df: DataFrame, by: Sequence[str], fields: Sequence, order: Sequence[str], name: str = "items") -> DataFrame:
    """Rows of each group as one ordered array of structs, in one pass.

    For groups that are one record by nature (an order's lines, a document's
    events): the array must fit in a row. A group without such a bound is not
    nested but written as ordered lines (``sinks.export``). Elements are
    ``struct(fields...)`` in the order of ``order``."""
    by, order = list(by), list(order)
    flds = [F.col(f) if isinstance(f, str) else f for f in fields]
    elem = F.struct(*[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)], *flds)
    drop = [f"_o{i}" for i in range(len(order))]
    arr = F.transform(F.sort_array(F.collect_list(elem)), lambda x: x.dropFields(*drop))
    return df.groupBy(*by).agg(arr.alias(name))
