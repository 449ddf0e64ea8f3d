"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import scratch_dir

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: White space that separates words in the contracts: space and \t \n \v \f \r.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def python_tasks(spark: SparkSession, rows: int = 256, mb: int = 16) -> None:
    """Bound the Arrow batches of Python tasks by rows and bytes (texts can be
    very long), and let the workers import this library where it lies at the
    same path on every machine (else ship it with ``--py-files``)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(mb << 20))
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "")
    if ROOT not in have.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (have, ROOT) if x)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, ``spark.checkpoint.dir``; without one, a
    cluster is an error, and only a master on one machine gets a folder there."""
    return scratch_dir(spark)


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and written to the shared folder (reliable
    checkpoint): later steps read it again and lost executors cost only tasks."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: like ``cut``, but
    compressed and readable by column. The folder is the job's scratch space."""
    path = f"{shared_dir(df.sparkSession)}/staged-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def col(df: DataFrame, name: str) -> Column:
    return df[f"`{name}`"]


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id, text): no other column of ``docs`` can clash with an operator's own."""
    return docs.select(col(docs, id_col).alias("doc_id"), col(docs, text_col).alias("text"))


def positional(docs: DataFrame) -> DataFrame:
    """Columns renamed by position (c0, c1, ...), so that no name can clash."""
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])


def row_key(doc_id: Column, text: Column) -> Column:
    """Stands for a row of documents: equal for equal (doc_id, text), NULLs
    included, else different but for a clash of two 64-bit hashes."""
    return F.struct(F.xxhash64(doc_id.cast("string"), doc_id.isNull()).alias("a"),
                    F.xxhash64(text, text.isNull(), F.lit(7)).alias("b"))


SMALL_SIDE = 2_000_000  # rows of a few numbers that may be broadcast; larger sides are shuffled


def small(df: DataFrame, rows: int = SMALL_SIDE) -> DataFrame:
    """``df`` (already written), to be broadcast if it is known to be small, else shuffled."""
    return F.broadcast(df) if df.count() <= rows else df
