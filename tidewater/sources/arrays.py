"""JSON arrays of any size, read in many tasks.

``landed`` gives a file as one row, so that one task parses it and 2 GB are its
limit. Here a file is read in the splits of Spark's text reader, which takes a
closing brace for the end of a line, and only the records are ever parsed:

1. A task cannot know whether its split begins inside a string, nor how deep.
   So it summarises the split for both cases: quotes modulo 2, the change of
   depth, what was opened at which depth (relative to its start), and the place
   of the last such opening. It writes the split in groups of about a megabyte,
   each with the summary of what precedes it in the split (``grouped``).
2. Running sums over the splits of a file, one small row each, tell the true
   state at the start of each split, and so of each group (``states``).
3. Every group is then cut by itself: records that lie in it whole, and the
   pieces of those that cross its borders, which meet by the offset of the
   record's first byte (``records_in``).

No row holds more than a group or a record. ``array_files`` gives one row per
file with the error of a file that is no such array: strings or brackets that do
not close, a second value after the array, no array at all. As with the parsers
of whole files, a file with an error has no records. Not noticed is what stands
between two records in place of the comma.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewater.session import scratch_dir

GROUP_BYTES = 1 << 20
CLOSE = "}"
DEEPEST = 1024  # levels of nesting that a summary tells apart below its start

_OPENED = pa.list_(pa.struct([("d", pa.int32()), ("lists", pa.int64()), ("objects", pa.int64()), ("last", pa.int64())]))
_GROUPS = pa.schema([
    ("file_path", pa.string()), ("file_name", pa.string()), ("file_time", pa.int64()), ("file_bytes", pa.int64()),
    ("block", pa.int64()), ("at", pa.int64()),
    ("size", pa.int64()), ("body", pa.binary()), ("quotes", pa.int32()), ("depth0", pa.int32()), ("depth1", pa.int32()),
    ("opened0", _OPENED), ("opened1", _OPENED)])
_OPENED_DDL = "array<struct<d:int,lists:bigint,objects:bigint,last:bigint>>"
_GROUPS_DDL = ("file_path string, file_name string, file_time long, file_bytes long, block long, at long, size long, body binary, quotes int, "
               f"depth0 int, depth1 int, opened0 {_OPENED_DDL}, opened1 {_OPENED_DDL}")

_STEP = np.zeros(256, dtype=np.int8)
_STEP[[ord(c) for c in "[{"]] = 1
_STEP[[ord(c) for c in "]}"]] = -1


def lexed(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(places of brackets, their steps, whether each has an odd number of quotes before it, quotes) of a text that begins at no escape."""
    if b"\\" in data:
        data = re.sub(rb"(?s)\\.", b"__", data)
    chars = np.frombuffer(data, np.uint8)
    places = np.flatnonzero(_STEP[chars])
    quotes = np.flatnonzero(chars == ord('"'))
    return places, _STEP[chars[places]].astype(np.int32), np.searchsorted(quotes, places) % 2 == 1, len(quotes)


class Summary:
    """What lies between the start of a split and some place in it, for a split that begins outside (0) or inside (1) a string."""

    def __init__(self):
        self.quotes, self.depth, self.opened = 0, [0, 0], [{}, {}]

    def add(self, data: bytes, at: int) -> None:
        places, steps, odd, quotes = lexed(data)
        chars = np.frombuffer(data, np.uint8)
        for h in (0, 1):
            outside = odd == bool((self.quotes + h) % 2)
            p, s = places[outside], steps[outside]
            before = self.depth[h] + np.cumsum(s) - s
            up = (s == 1) & (before <= 2) & (before >= -DEEPEST)
            for d in np.unique(before[up]).tolist():
                mine = p[up & (before == d)]
                lists = int((chars[mine] == ord("[")).sum())
                had = self.opened[h].get(d, (0, 0, 0))
                self.opened[h][d] = (had[0] + lists, had[1] + len(mine) - lists, at + int(mine[-1]))
            self.depth[h] += int(s.sum())
        self.quotes = (self.quotes + quotes) % 2

    def row(self) -> dict:
        opened = [[{"d": d, "lists": a, "objects": b, "last": c} for d, (a, b, c) in sorted(x.items())] for x in self.opened]
        return {"quotes": self.quotes, "depth0": self.depth[0], "depth1": self.depth[1], "opened0": opened[0], "opened1": opened[1]}


def _library_in_tasks(spark: SparkSession) -> None:
    """Let Python workers import this library where it lies at the same path on every machine (else ship it with ``--py-files``)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    have = [x for x in env.get("PYTHONPATH", "").split(os.pathsep) if x]
    if root not in have:
        env["PYTHONPATH"] = os.pathsep.join([*have, root])


def grouped(spark: SparkSession, path: str, chosen: Callable[[DataFrame], DataFrame] | None = None, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """The splits of the files (those that ``chosen``, a filter over
    ``file_name``, keeps: Spark opens no others) as groups, each with the summary of its split up
    to it; a last row of each split, without bytes, has the whole summary."""
    _library_in_tasks(spark)
    # as in ``landed``: a file that cannot be read does not stop the others; one that is read in part does not close its brackets
    r = (spark.read.option("lineSep", CLOSE).option("recursiveFileLookup", True).option("ignoreCorruptFiles", True)
         .option("ignoreMissingFiles", True))
    chunks = r.text(path).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_name").alias("file_name"),
        F.unix_micros("_metadata.file_modification_time").alias("file_time"), F.col("_metadata.file_size").alias("file_bytes"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("chunk"))
    if chosen:
        chunks = chosen(chunks)
    close, who_names = CLOSE.encode(), ("file_path", "file_name", "file_time", "file_bytes", "block")

    def tasks(batches):
        here, summary, parts, size, at, out = None, None, [], 0, 0, []

        def group():
            data = b"".join(parts)
            out.append({**dict(zip(who_names, here)), "at": at, "size": size, "body": data, **summary.row()})
            summary.add(data, at)

        def end():
            out.append({**dict(zip(who_names, here)), "at": None, "size": at, "body": None, **summary.row()})

        for batch in batches:
            *who, data = [batch.column(i) for i in range(6)]
            for i in range(batch.num_rows):
                now = tuple(c[i].as_py() for c in who)
                # the reader takes the brace for the end of a line: it stands before all chunks but the first of a file
                chunk = data[i].as_py()
                if now != here:
                    if here is not None:
                        if size:
                            group()
                            at += size
                        end()
                    here, summary, parts, size, at = now, Summary(), [], 0, 0
                    chunk = chunk if now[4] == 0 else close + chunk
                else:
                    chunk = close + chunk
                parts.append(chunk)
                size += len(chunk)
                if size >= group_bytes:
                    group()
                    at, parts, size = at + size, [], 0
                    if len(out) >= 8:
                        yield pa.RecordBatch.from_pylist(out, schema=_GROUPS)
                        out.clear()
        if here is not None:
            if size:
                group()
                at += size
            end()
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_GROUPS)

    return chunks.mapInArrow(tasks, _GROUPS_DDL)


def _opened(case: F.Column, d: F.Column, field: str) -> F.Column:
    """A field of the entry for relative depth ``d`` in the summary of the case that holds."""
    entry = F.get(F.filter(F.when(case == 1, F.col("opened1")).otherwise(F.col("opened0")), lambda x: x["d"] == d), F.lit(0))
    return entry[field]


def states(groups: DataFrame, depth: int) -> tuple[DataFrame, DataFrame]:
    """(groups, files): every group with the state at its start: ``inside`` a
    string, ``level``, ``section`` (values opened in the outer array so far),
    ``open_at`` (where the last value at ``depth`` began) and ``off``; every file
    with its state at the end."""
    ends = groups.where("body is null").drop("body", "at")
    by_file = W.partitionBy("file_path").orderBy("block")  # one row for each split of a file
    before = by_file.rowsBetween(W.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    s = ends.withColumn("inside", (F.coalesce(F.sum("quotes").over(before), zero) % 2).cast("int")) \
        .withColumn("base", F.coalesce(F.sum("size").over(before), zero)) \
        .withColumn("change", F.when(F.col("inside") == 1, F.col("depth1")).otherwise(F.col("depth0")))
    s = s.withColumn("level", F.coalesce(F.sum("change").over(before), zero).cast("int"))
    at = lambda d, field: F.coalesce(_opened(F.col("inside"), F.lit(d) - F.col("level"), field), zero)
    s = s.withColumn("lists", at(1, "lists")).withColumn("objects", at(1, "objects")) \
        .withColumn("outer", at(0, "lists") + at(0, "objects")).withColumn("outer_lists", at(0, "lists")) \
        .withColumn("last", F.col("base") + _opened(F.col("inside"), F.lit(depth) - F.col("level"), "last"))
    s = s.withColumn("section", F.coalesce(F.sum(F.col("lists") + F.col("objects")).over(before), zero)) \
        .withColumn("open_at", F.max("last").over(before))
    # a brace that ends a file is lost to the reader (as is a byte order mark of three bytes)
    lost = F.when((F.max("file_bytes") - F.sum("size")).isin(1, 4) & (F.sum("quotes") % 2 == 0), 1).otherwise(0)
    files = s.groupBy("file_path", "file_name", "file_time").agg(
        (F.sum("quotes") % 2).alias("inside"), (F.sum("change") - lost).alias("level"), F.sum("lists").alias("lists"), F.sum("objects").alias("objects"),
        F.sum("outer").alias("outer"), F.sum("outer_lists").alias("outer_lists"))
    split = s.select("file_path", "block", F.col("inside").alias("_inside"), F.col("level").alias("_level"), F.col("section").alias("_section"),
                     F.col("open_at").alias("_open_at"), "base")
    g = groups.where("body is not null").join(split, ["file_path", "block"])
    within = lambda d, field: _opened(F.col("_inside"), F.lit(d) - F.col("_level"), field)
    return g.select(
        "file_path", "file_name", "file_time", (F.col("base") + F.col("at")).alias("off"), "body",
        ((F.col("_inside") + F.col("quotes")) % 2).cast("int").alias("inside"),
        (F.col("_level") + F.when(F.col("_inside") == 1, F.col("depth1")).otherwise(F.col("depth0"))).alias("level"),
        (F.col("_section") + F.coalesce(within(1, "lists") + within(1, "objects"), zero)).alias("section"),
        F.greatest("_open_at", F.col("base") + within(depth, "last")).alias("open_at")), files


def cut(data: bytes, off: int, inside: int, level: int, section: int, open_at: int | None, depth: int) -> list[tuple]:
    """(section, offset of the value, place of the piece, whole, bytes) of the values at ``depth`` in a group."""
    places, steps, odd, _ = lexed(data)
    outside = odd == bool(inside)
    places, steps = places[outside], steps[outside]
    after = level + np.cumsum(steps)
    up = steps == 1
    starts, ends = places[up & (after == depth + 1)], places[~up & (after == depth)]
    sections = section + np.searchsorted(places[up & (after == 2)], starts, side="right") if depth > 1 else np.zeros(len(starts), np.int64)
    out = []
    if level > depth:  # the rest of a value that began in a group before
        end = int(ends[0]) + 1 if len(ends) else len(data)
        out.append((section, open_at, off, False, data[:end]))
        ends = ends[1:]
    for i, (a, s) in enumerate(zip(starts.tolist(), sections.tolist())):
        if i < len(ends):
            out.append((s, off + a, off + a, True, data[a:int(ends[i]) + 1]))
        else:
            out.append((s, off + a, off + a, False, data[a:]))
    return out


_VALUES = pa.schema([("file_path", pa.string()), ("file_name", pa.string()), ("file_time", pa.int64()), ("section", pa.int64()),
                     ("off", pa.int64()), ("piece", pa.int64()), ("whole", pa.bool_()), ("value", pa.binary())])
_VALUES_DDL = ("file_path string, file_name string, file_time long, section long, off long, piece long, whole boolean, value binary")


def records_in(groups: DataFrame, depth: int) -> DataFrame:
    """(file_path, file_name, file_time, section, off, value): the text of every object at ``depth``."""
    def tasks(batches):
        for batch in batches:
            for r in batch.to_pylist():
                found = cut(r["body"], r["off"], r["inside"], r["level"], r["section"], r["open_at"], depth)
                yield pa.RecordBatch.from_pylist(
                    [{"file_path": r["file_path"], "file_name": r["file_name"], "file_time": r["file_time"], "section": s, "off": at,
                      "piece": piece, "whole": whole, "value": data} for s, at, piece, whole, data in found], schema=_VALUES)

    who = ["file_path", "file_name", "file_time"]
    found = groups.mapInArrow(tasks, _VALUES_DDL)
    whole = found.where("whole").select(*who, "section", "off", "value")
    # the pieces of one value: a group of bounded size
    joined = found.where("not whole").groupBy(*who, "off").agg(
        F.min("section").alias("section"), F.array_sort(F.collect_list(F.struct("piece", "value"))).alias("pieces"))
    # a letter per byte: joined as text, in one go
    letters = F.array_join(F.transform("pieces", lambda x: F.decode(x["value"], "ISO-8859-1")), "")
    joined = joined.select(*who, "section", "off", F.encode(letters, "ISO-8859-1").alias("value"))
    # sections count from 0; a value that is no object is no record
    return whole.union(joined).select(
        "file_path", "file_name", F.timestamp_micros("file_time").alias("file_time"), (F.col("section") - 1).alias("section"), "off",
        F.col("value").cast("string").alias("value")).where(F.startswith(F.col("value"), F.lit("{")))


def scan_arrays(spark: SparkSession, path: str, depth: int = 1, chosen: Callable[[DataFrame], DataFrame] | None = None,
                group_bytes: int = GROUP_BYTES) -> tuple[DataFrame, DataFrame]:
    """(records, files) of the JSON arrays under ``path``: the objects in the
    array (``depth`` 1) or in the arrays within it (2), and the files with their
    ``error``, NULL if they are good. The groups are written once, to the shared folder."""
    folder = f"{scratch_dir(spark)}/groups-{uuid.uuid4().hex}"
    grouped(spark, path, chosen, group_bytes).write.option("compression", "zstd").parquet(folder)
    groups, files = states(spark.read.parquet(folder), depth)
    error = F.when((F.col("inside") != 0) | (F.col("level") != 0) | (F.col("outer") > 1), F.lit("not JSON")) \
        .when(F.col("outer_lists") == 0, F.lit("no array at $"))
    if depth > 1:
        error = error.when(F.col("objects") > 0, F.lit("a section is no array"))
    return records_in(groups, depth), files.select(
        "file_path", "file_name", F.timestamp_micros("file_time").alias("file_time"), F.col("lists").alias("sections"), error.alias("error"))
