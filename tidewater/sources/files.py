"""Landed files as rows, file selection and skip-known.

Every reader here returns ``(value, file_path, file_name)`` with one row per
file (``wholetext``): Spark packs many small files into one task
(``maxPartitionBytes`` + ``openCostInBytes``), so a folder of a million
documents is a million rows spread over the cluster, never a driver loop.
Bad UTF-8 bytes become U+FFFD (S11, ``errors='replace'``).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.scalar import digits, map_code
from tidewater.operators.joins import without

BOM = "﻿"


def _file_columns() -> list:
    return ["value", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_name").alias("file_name"),
            F.col("_metadata.file_modification_time").alias("file_time")]


def landed(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = True) -> DataFrame:
    """Whole files under ``path`` (optionally ``pathGlobFilter``)."""
    # a file that cannot be read, or that vanished after listing, does not stop
    # the others; ``unread_files`` finds those and the jobs report them
    r = spark.read.option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", True)
    return r.text(path, wholetext=True).select(*_file_columns())  # text() sets wholetext itself: an option for it is lost


def landed_stream(spark: SparkSession, path: str, glob: str | None = None, max_files: int = 1000) -> DataFrame:
    """The same rows as a file stream (T1); the checkpoint remembers files seen."""
    r = (spark.readStream.format("text").option("wholetext", True).option("maxFilesPerTrigger", max_files)
         .option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True))
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path).select(*_file_columns())


def select_files(df: DataFrame, include: str | None = None, exclude: str | None = None,
                 col: str = "file_name") -> DataFrame:
    """Keep file names matching regex ``include`` and not ``exclude``.

    The predicate is on ``_metadata.file_name``, which Spark evaluates while
    listing: files it rejects are never opened (the scan's ``numFiles`` counts
    only the selected ones).

    Catalogue of the reference's selections:
    POS notes ``include=r'\\d{4}-\\d{2}-\\d{2}.*\\.json$'`` (plus ``exclude='GCM'``, D21);
    line items ``include='GCM'``; tax notes ``include=r'\\.xml$', exclude=r'(-can\\.xml$)|(^CFe)'``;
    cancellations ``include=r'-can\\.xml$'``."""
    if include:
        df = df.filter(F.regexp_like(F.col(col), F.lit(include)))
    if exclude:
        df = df.filter(~F.regexp_like(F.col(col), F.lit(exclude)))
    return df


def key_from_name(col: str = "file_name", n: int = 44):
    """44-digit key in a file name (``re.search(r'(\\d{44})')``)."""
    return digits(F.col(col), n)


def only_new(files: DataFrame, loaded: DataFrame, file_key, loaded_key: str) -> DataFrame:
    """Files whose key is not loaded yet (anti-join). ``file_key``
    is a Column computed from the file row (e.g. ``key_from_name()`` or the
    file name itself). The anti-join runs after the read, so loaded files are
    still opened; for large landing areas use ``ingest_stream``, whose
    checkpoint skips seen files before reading them."""
    f = files.withColumn("_file_key", file_key)
    return without(f, loaded, "_file_key", loaded_key).drop("_file_key")


def file_day(col: str = "file_name"):
    """Day carried by a file name (``..._2026-02-19.json``), NULL if none."""
    return F.nullif(F.regexp_extract(F.col(col), r"(\d{4}-\d{2}-\d{2})", 1), F.lit("")).try_cast("date")


def new_files(spark: SparkSession, path: str, loaded: DataFrame, loaded_key: str, file_key=None,
              include: str | None = None, exclude: str | None = None) -> DataFrame:
    """S8 + S9 without opening loaded files: ``(value, file_path, file_name)``
    of the files under ``path`` that pass the name selection and whose key
    (``file_key``, a Column over ``file_name``; default the file name) is not
    in ``loaded``.

    Candidates come from the ``binaryFile`` source with only ``path``
    selected, so no content is read; the selection and the anti-join run on
    that listing. The surviving paths are then read -- the only file contents
    opened. The path list goes through the driver, which already holds the
    whole listing (Spark lists files there), so it is bounded by it."""
    fresh = fresh_files(spark, path, loaded, loaded_key, file_key, include, exclude)
    paths = [r.file_path for r in fresh.select("file_path").collect()]
    if not paths:
        return spark.createDataFrame([], "value string, file_path string, file_name string, file_time timestamp")
    # one listing of the folder; the path set is a metadata predicate that
    # Spark applies while listing, so only these files are opened (passing
    # the paths themselves would list each one as a root: a job per path)
    return landed(spark, path).filter(F.col("file_path").isin(paths))


def fresh_files(spark: SparkSession, path: str, loaded: DataFrame, loaded_key: str, file_key=None,
                include: str | None = None, exclude: str | None = None) -> DataFrame:
    """``(file_path, file_name)`` of the files that ``new_files`` is to read, from a listing that opens none."""
    listing = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
                    .option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True).load(path)
                    .select(F.col("path").alias("file_path"),
                            F.regexp_extract(F.col("path"), r"([^/]+)$", 1).alias("file_name")))
    listing = select_files(listing, include, exclude)
    return only_new(listing, loaded, file_key if file_key is not None else F.col("file_name"), loaded_key)


def listed_files(spark: SparkSession, path: str) -> DataFrame:
    """``(file_path, file_name)`` of all files under ``path``, from a listing that opens none."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
            .select(F.col("path").alias("file_path"), F.regexp_extract(F.col("path"), r"([^/]+)$", 1).alias("file_name")))


def unread_files(listed: DataFrame, read: DataFrame, by: str = "file_name") -> DataFrame:
    """``(file_name, error)`` of listed files of which no row came out of the
    read (``read`` has at least one row per file that could be opened). With
    ``by='file_path'`` files of one name in several folders are told apart."""
    return without(listed.select(by, "file_name").distinct() if by != "file_name" else listed.select(by).distinct(), read, by).select(
        "file_name", F.lit("file cannot be read").alias("error"))


def arrival(files: DataFrame, pos=None):
    """Order in which documents arrived: day in the file name, time of the
    file, file name, place in the file. The last one wins an upsert (K1, K2)."""
    time = F.col("file_time") if "file_time" in files.columns else F.lit(None).cast("timestamp")
    return F.struct(file_day().alias("day"), time.alias("time"), F.col("file_name").alias("name"),
                    (pos if pos is not None else F.lit(0)).cast("int").alias("pos")).alias("arrival")


def folder_of(col: str = "file_path"):
    """Name of the folder holding the file."""
    return F.regexp_extract(F.col(col), r"/([^/]+)/[^/]+$", 1)


def with_folder_code(df: DataFrame, code_map: Mapping[str, str], name: str = "hotel",
                     col: str = "file_path") -> DataFrame:
    """Site code from the share/folder name."""
    return df.withColumn(name, map_code(folder_of(col), code_map, fallback="self"))


def strip_bom(col: str = "value"):
    return F.regexp_replace(F.col(col), "^" + BOM, "")
