"""A corpus pipeline of the training-data operators (part of subpackage ``llm``).

``STAGES`` are (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. Each stage works on all that its predecessor kept.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import bpe, decontamination, langid, line_dedup, simhash
from tidewater.llm.common import shared_dir, table
from tidewater.llm.queries import vocabulary_file


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (no letter), or with one told with a score under 0.5, go."""
    path = vocabulary_file("piece_bpe_32k.model")
    return langid.keep_known(docs, langid.train(langid.labelled_rows(docs), path), path)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go, but for the first; every document stays."""
    return line_dedup.dedup_lines(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    return simhash.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are contaminated by the benchmark go."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit) and the decoded text of every document."""
    coded = bpe.encode(docs, vocabulary_file("word_bpe_49k.json"))
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [("language_id", language_id), ("line_dedup", line_dedup_stage), ("simhash_near_dedup", simhash_stage),
          ("decontamination", decontamination_stage), ("bpe", bpe_stage)]

#: SQL cannot express language ID, SimHash or BPE; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
