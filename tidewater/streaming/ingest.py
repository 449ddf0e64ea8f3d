"""Daily / continuous ingest of landed files into keyed bronze tables.

``ingest_stream`` is a Structured Streaming job: a file source (the
checkpoint remembers which files were read, which is S9 for free), a parser
from ``tidewater.sources``, and ``foreachBatch`` doing the idempotent upsert
(K1) into a partitioned table, of which a batch rewrites only the partitions it
touches. ``trigger(availableNow=True)`` drains what has landed and stops -- the daily job -- and a re-run after a failure re-applies
the same batch, which the upsert makes harmless.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import checkpoint_dir
from pyspark.sql import Column

from tidewater.sinks.tables import dedupe_last, upsert_partitioned
from tidewater.sources.files import landed, landed_stream, select_files

Parser = Callable[[DataFrame], DataFrame]


def upsert_last(rows: DataFrame, table: str, key: str, partition: Column, order) -> DataFrame:
    """Upsert with the last arrival of a key winning; the order itself is not stored."""
    batch = dedupe_last(rows, key, order)
    return upsert_partitioned(batch.drop("arrival"), table, key, partition, ())


def ingest_stream(spark: SparkSession, source_dir: str, parse: Parser, table_base: str, key: str,
                  name: str, partition: Column, order="arrival", glob: str | None = None, max_files: int = 1000,
                  checkpoint: str | None = None):
    """Drain ``source_dir`` into ``table_base`` and return the finished query.

    The stream checkpoint lives under ``spark.checkpoint.dir`` (shared
    storage; read from the session, never a machine-local folder). It must
    stay the same between runs of one stream: it is what skips the files
    already ingested."""
    cp = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}"

    def batch(df: DataFrame, epoch_id: int) -> None:
        upsert_last(parse(df), table_base, key, partition, order)

    q = (landed_stream(spark, source_dir, glob, max_files).writeStream
         .foreachBatch(batch).option("checkpointLocation", cp)
         .trigger(availableNow=True).queryName(name).start())
    q.awaitTermination()
    return q


def ingest_day(spark: SparkSession, source_dir: str, day: str, parse: Parser, table_base: str, key: str,
               partition: Column, order="arrival") -> DataFrame:
    """T1 batch form: the files whose name carries ``day`` (default
    yesterday is the caller's choice), parsed and upserted."""
    files = select_files(landed(spark, source_dir), include=day.replace("-", r"[-]?"))
    return upsert_last(parse(files), table_base, key, partition, order)


def ingest_days(spark: SparkSession, source_dir: str, start: str, end: str, parse: Parser, table_base: str,
                key: str, partition: Column, order="arrival") -> DataFrame:
    """T3 backfill: every landed file whose name carries a day in
    [``start``, ``end``] -- one read over the whole range, one idempotent
    upsert (the reference loops over 30-day chunks and goes on after a failed
    one; here a file that does not parse is a reject and stops nothing)."""
    from tidewater.sources.files import file_day
    files = landed(spark, source_dir)
    files = files.filter(file_day().between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return upsert_last(parse(files), table_base, key, partition, order)


def ingest_lookback(spark: SparkSession, source_dir: str, as_of: str, days: int, parse: Parser, table_base: str,
                    key: str, partition: Column, order="arrival") -> DataFrame:
    """Re-load the ``days`` days up to ``as_of`` to catch late changes
    (3 days for maintenance, 7 for the ledger in the reference); safe because
    the upsert is idempotent."""
    start = spark.range(1).select(F.date_sub(F.lit(as_of).cast("date"), days).cast("string")).first()[0]
    return ingest_days(spark, source_dir, start, as_of, parse, table_base, key, partition, order)
