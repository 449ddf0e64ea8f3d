"""Backfills with a ledger of their chunks.

A backfill is a range of days in chunks. Each chunk is one idempotent load; what
became of it is a row of the ledger, a merged-on-read table keyed by (job, chunk):
state, counts, the error if it failed, and when. A chunk that fails leaves the
others committed. A re-run takes only what is not done.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.incremental import date_chunks
from tidewater.sinks.batches import append_batch, compact, read_merged
from tidewater.streaming.ingest import Parser, ingest_days

LEDGER = "job string, start date, end date, state string, counts map<string,bigint>, error string"
KEY = ["job", "start", "end"]
DONE, FAILED = "done", "failed"


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """(job, start, end, state, counts, error, at): the last state of every chunk that was tried."""
    rows = read_merged(spark, path, KEY)
    return rows if rows is not None else spark.createDataFrame([], LEDGER + ", at timestamp")


def chunks_of(spark: SparkSession, start: str, end: str, days: int) -> list[tuple]:
    """The ``days``-day chunks of a range, as dates."""
    span = spark.range(1).select(F.lit(start).cast("date").alias("start"), F.lit(end).cast("date").alias("end"))
    return [tuple(r) for r in date_chunks(span, days).orderBy("chunk_inicio").collect()]


def open_chunks(spark: SparkSession, path: str, job: str, chunks: Sequence[tuple]) -> list[tuple]:
    """The chunks that the ledger does not have as done."""
    done = ledger(spark, path).where((F.col("job") == job) & (F.col("state") == DONE)).select("start", "end").collect()
    return [c for c in chunks if c not in {tuple(r) for r in done}]


def backfill(spark: SparkSession, path: str, job: str, chunks: Sequence[tuple], load: Callable[[str, str], dict]) -> dict:
    """Run ``load(start, end)``, which returns counts, for every open chunk and
    record the outcome. An error of Spark or of the data (``PySparkException``,
    ``ValueError``) fails its chunk only; others, such as a lost session, stop
    the run. Returns the chunks by outcome: done, failed, skipped."""
    todo = open_chunks(spark, path, job, chunks)
    out = {"done": [], "failed": [], "skipped": [c for c in chunks if c not in todo]}
    for chunk in todo:
        state, counts, error = DONE, {}, None
        try:
            counts = {k: int(v) for k, v in (load(*map(str, chunk)) or {}).items() if v is not None}
        except (PySparkException, ValueError) as e:
            state, error = FAILED, f"{type(e).__name__}: {str(e)[:500]}"
        row = spark.createDataFrame([(job, *chunk, state, counts, error)], LEDGER)
        append_batch(row, path, KEY, stamp="at")
        out[state].append(chunk)
    compact(spark, path, KEY)
    return out


def ingest_chunks(spark: SparkSession, source_dir: str, start: str, end: str, parse: Parser, table_base: str, key: str,
                  partition: Column, ledger_path: str, job: str, days: int = 30, order="arrival") -> dict:
    """``ingest_days`` chunk by chunk, with a ledger."""
    def load(lo: str, hi: str) -> dict:
        ingest_days(spark, source_dir, lo, hi, parse, table_base, key, partition, order)
        return {}
    return backfill(spark, ledger_path, job, chunks_of(spark, start, end, days), load)
