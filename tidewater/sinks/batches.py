"""Keyed tables that are merged when they are read.

A table is a folder of segments, ``<base>/seg=<first>-<last>/``. A batch writes
one segment with the next sequence number, so its cost follows the batch and not
the table: no row that it does not hold is read or written. A segment has at most
one row per key; a row with ``_deleted`` says that the key is gone.

``read_merged`` takes the row of the newest segment for each key. The oldest
segment, which holds most of the table, is only scanned and filtered by the keys
of the newer ones (an anti join, a broadcast one while those are small by Spark's
own size check); the newer ones are reduced to one row per key first.

``compact`` keeps the number of segments small: newer segments are merged into
one once there are ``fanout`` of them that are large together beside the next
older one, so that every row is rewritten a logarithmic number of times. The
merged segment covers its parts: readers use it from the moment that it is
complete, and what they read stays the same. Parts are removed by the compaction
after, so that a reader that has just listed them can finish.

A segment without ``_SUCCESS`` (a failed job) is not read, and its number not
used again. There is one writer at a time, as for the other tables here.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.joins import one_per_key, without
from tidewater.sinks.tables import _fs, _list, dedupe_last

_SEGMENT = re.compile(r"seg=(\d+)-(\d+)$")
DELETED, SEQ = "_deleted", "_seq"


@dataclass(frozen=True)
class Segment:
    first: int
    last: int
    path: str
    bytes: int  # of its data files
    complete: bool

    def covers(self, other: Segment) -> bool:
        return self != other and self.first <= other.first and other.last <= self.last


def all_segments(spark: SparkSession, base: str) -> list[Segment]:
    """Every segment folder, by sequence (metadata only)."""
    fs, p = _fs(spark, base)
    out = []
    for st in fs.listStatus(p) if fs.exists(p) else []:
        m = _SEGMENT.search(st.getPath().getName())
        if m:
            files = {f.getPath().getName(): f.getLen() for f in fs.listStatus(st.getPath())}
            data = sum(n for name, n in files.items() if not name.startswith(("_", ".")))
            out.append(Segment(int(m[1]), int(m[2]), f"{base}/{st.getPath().getName()}", data, "_SUCCESS" in files))
    return sorted(out, key=lambda s: (s.first, s.last))


def segments(spark: SparkSession, base: str) -> list[Segment]:
    """The segments that make up the table, oldest first: complete ones that no other complete one covers."""
    done = [s for s in all_segments(spark, base) if s.complete]
    return [s for s in done if not any(o.covers(s) for o in done)]


def last_seq(spark: SparkSession, base: str) -> int:
    """The newest batch of the table; -1 if there is none."""
    return max((s.last for s in segments(spark, base)), default=-1)


def append_batch(updates: DataFrame, base: str, key, order=(), stamp: str | None = "extracted_at", deleted: str | None = None) -> int:
    """K1: add a batch; its rows replace those of their keys. Returns its number.

    The batch is de-duplicated first, the last row of a key by ``order`` wins
    (K2; not if ``order`` is empty, for a batch with one row per key).
    ``deleted`` names a boolean column that marks keys as gone. Applying a
    batch again gives the same table."""
    spark, key = updates.sparkSession, _list(key)
    batch = dedupe_last(updates, key, order) if order else updates
    if stamp:
        batch = batch.withColumn(stamp, F.current_timestamp())
    gone = F.coalesce(F.col(deleted), F.lit(False)) if deleted else F.lit(False)
    batch = batch.withColumn(DELETED, gone)
    batch = batch.drop(deleted) if deleted and deleted != DELETED else batch
    n = max((s.last for s in all_segments(spark, base)), default=-1) + 1
    batch.write.mode("error").parquet(f"{base}/seg={n}-{n}")
    return n


def delete_keys(ids: DataFrame, base: str, key) -> int:
    """Remove the given keys (tombstones; the rows go when they are merged with the oldest segment)."""
    return append_batch(ids.select(*_list(key)).distinct().withColumn(DELETED, F.lit(True)), base, key, stamp=None, deleted=DELETED)


def _read(spark: SparkSession, segment: Segment) -> DataFrame:
    # read by its own path: the folder's name is no column
    return spark.read.parquet(segment.path).withColumn(SEQ, F.lit(segment.last))


def _merged(spark: SparkSession, parts: list[Segment], key: list[str], with_deleted: bool) -> DataFrame | None:
    parts = [s for s in parts if s.bytes]  # a batch without rows has no files
    if not parts:
        return None
    oldest, newer = _read(spark, parts[0]), None
    for s in parts[1:]:
        rows = _read(spark, s)
        newer = rows if newer is None else newer.unionByName(rows, allowMissingColumns=True)
    out = oldest
    if newer is not None:
        if len(parts) > 2:
            newer = one_per_key(newer, key, [SEQ], take=[c for c in newer.columns if c not in key], largest=True)
        out = newer.unionByName(without(oldest, newer.select(*key), key), allowMissingColumns=True)
    out = out.drop(SEQ)
    return out if with_deleted else out.where(~F.col(DELETED)).drop(DELETED)


def read_merged(spark: SparkSession, base: str, key) -> DataFrame | None:
    """The table: the newest row of each key that is not deleted. None before the first file."""
    return _merged(spark, segments(spark, base), _list(key), False)


def changed_keys(spark: SparkSession, base: str, key, since: int) -> DataFrame | None:
    """The keys of batches after ``since``, deleted ones too (after a compaction
    that joined older batches to them, also keys of those). None if there are none."""
    parts = [s for s in segments(spark, base) if s.last > since and s.bytes]
    out = None
    for s in parts:
        rows = spark.read.parquet(s.path).select(*_list(key))
        out = rows if out is None else out.unionByName(rows)
    return out.distinct() if out is not None else None


def changed_rows(spark: SparkSession, base: str, key, since: int) -> DataFrame | None:
    """The newest rows of the keys of batches after ``since``, with ``_deleted``;
    only the segments of those batches are read. None if there are none."""
    return _merged(spark, [s for s in segments(spark, base) if s.last > since], _list(key), True)


def to_merge(parts: list[Segment], fanout: int, ratio: float) -> list[Segment]:
    """The newest segments that are to become one, oldest first; none if it is not worth it yet."""
    chosen = parts[-1:]
    for s in reversed(parts[:-1]):
        if s.bytes > ratio * sum(c.bytes for c in chosen):
            break
        chosen.insert(0, s)
    return chosen if len(chosen) >= fanout else []


def compact(spark: SparkSession, base: str, key, fanout: int = 4, ratio: float = 2.0, all_of_it: bool = False) -> bool:
    """Merge segments if it is due (or ``all_of_it``); readers see no difference."""
    parts = segments(spark, base)
    chosen = parts if all_of_it and len(parts) > 1 else to_merge(parts, fanout, ratio)
    if not chosen:
        return False
    covered = [s for s in all_segments(spark, base) if s not in parts and any(p.covers(s) for p in parts)]
    oldest = chosen[0] == parts[0]  # nothing older is left that a tombstone would hide
    rows = _merged(spark, chosen, _list(key), with_deleted=not oldest)
    if rows is None:
        return False
    if oldest:
        rows = rows.withColumn(DELETED, F.lit(False))
    rows.hint("rebalance").write.mode("overwrite").parquet(f"{base}/seg={chosen[0].first}-{chosen[-1].last}")
    for s in covered:
        fs, p = _fs(spark, s.path)
        fs.delete(p, True)
    return True
