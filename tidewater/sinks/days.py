"""Materialised results whose day partitions are swapped one by one (K4).

A table is a folder of generations, ``<base>/g=<n>/<column>=<day>/``. A refresh
writes a generation that holds only the days it recomputed, and names them in
``_days``: a day that has become empty is named there and has no folder. Readers
take each day from the newest complete generation that names it, so untouched
days keep their files, and a refresh becomes visible all at once, when its
``_SUCCESS`` is there. What passes through the driver is the list of days, as
with any partitioned table.

A generation that names no days in particular (``None``) holds the whole table.
``vacuum`` removes what no reader takes any more.
"""

from __future__ import annotations

import datetime as dt
import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.sinks.tables import _fs, by_partition, read_schema, write_schema

_GENERATION = re.compile(r"g=(\d+)$")
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    with_text = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(with_text, "UTF-8")
    finally:
        with_text.close()


def generations(spark: SparkSession, base: str, complete: bool = True) -> list[int]:
    found = [int(m[1]) for n in _names(spark, base) if (m := _GENERATION.search(n))]
    return sorted(g for g in found if not complete or "_SUCCESS" in _names(spark, f"{base}/g={g}"))


def write_days(df: DataFrame, base: str, column: str, days: list | None = None) -> int:
    """Swap in the rows of ``days`` (dates, or None for rows without a day; all
    rows of ``df`` must be of these days), or the whole table. Returns the generation."""
    spark = df.sparkSession
    n = max(generations(spark, base, complete=False), default=-1) + 1
    path = f"{base}/g={n}"
    named = None if days is None else sorted(NO_DAY if x is None else str(x) for x in days)
    # what the days are must be known before the generation is complete
    _write_text(spark, f"{base}/_days-{n}", json.dumps(named))
    write_schema(spark, f"{base}/_schema-{n}", df.schema)
    by_partition(df, [column]).write.mode("append").partitionBy(column).parquet(path)
    return n


def current_days(spark: SparkSession, base: str) -> dict[str, int]:
    """day (as in the folder names) -> the generation that its rows are read from."""
    taken: dict[str, int] = {}
    gone: set[str] = set()
    for g in reversed(generations(spark, base)):
        named = json.loads(_read_text(spark, f"{base}/_days-{g}"))
        here = {n.split("=", 1)[1] for n in _names(spark, f"{base}/g={g}") if "=" in n}
        for day in here - gone - taken.keys():
            taken[day] = g
        if named is None:
            break
        gone |= set(named) - here
    return taken


def read_days(spark: SparkSession, base: str) -> DataFrame | None:
    """The table; None before its first generation."""
    done = generations(spark, base)
    if not done:
        return None
    schema = read_schema(spark, f"{base}/_schema-{done[-1]}")
    taken, out = current_days(spark, base), None
    for g in done:
        here = {n.split("=", 1)[1] for n in _names(spark, f"{base}/g={g}") if "=" in n}
        mine = {day for day in here if taken.get(day) == g}
        if not mine:
            continue
        # one root for each generation; days that a newer one has are pruned
        column = next(n.split("=", 1)[0] for n in _names(spark, f"{base}/g={g}") if "=" in n)
        rows = spark.read.schema(schema).parquet(f"{base}/g={g}").select(*schema.names)
        if mine != here:
            rows = rows.where(in_days(column, [_day(x) for x in sorted(mine)]))
        out = rows if out is None else out.unionByName(rows)
    return out if out is not None else spark.createDataFrame([], schema)


def _day(folder: str) -> dt.date | None:
    return None if folder == NO_DAY else dt.date.fromisoformat(folder)


def vacuum(spark: SparkSession, base: str, keep: int = 2) -> int:
    """Remove day folders that the newest ``keep`` generations and the table as it is now do not need; returns how many."""
    taken, removed = current_days(spark, base), 0
    for g in generations(spark, base, complete=False)[:-keep or None]:
        for n in _names(spark, f"{base}/g={g}"):
            if "=" in n and taken.get(n.split("=", 1)[1]) != g:
                fs, p = _fs(spark, f"{base}/g={g}/{n}")
                fs.delete(p, True)
                removed += 1
    return removed


def days_of(rows: DataFrame, column: str) -> list:
    """The distinct days of some rows (as many as a table has partitions at most)."""
    return [r[0] for r in rows.select(F.col(column).cast(T.DateType())).distinct().collect()]


def in_days(column: str, days: list):
    """Predicate on a partition column that prunes: one of the days, None included."""
    known = [x for x in days if x is not None]
    hit = F.col(column).isin(known) if known else F.lit(False)
    return (hit | F.col(column).isNull()) if len(known) < len(days) else hit
