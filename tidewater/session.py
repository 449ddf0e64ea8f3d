"""SparkSession builder with the settings every job here relies on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings that change results, not only speed.
SEMANTIC_CONF = {
    # Day boundaries (V11, F11) and instant parsing depend on the zone; pin it.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # a JSON object with a repeated key keeps the last value, as the
    # reference's Python loaders do (the default rejects the document)
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Settings for scale: AQE re-plans joins from runtime sizes (a side is only
# broadcast when its measured size is under the threshold), coalesces small
# shuffle partitions and splits skewed ones.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor": "0.2",
    "spark.sql.files.maxPartitionBytes": "128MB",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # lineage cuts (reliable checkpoints in the shared folder) are removed
    # once nothing references them, so daily upserts do not pile them up
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app: str = "tidewater",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the semantic and scale settings.

    ``shuffle_partitions`` defaults to ``$TIDEWATER_SHUFFLE_PARTITIONS`` or
    Spark's own default; on a cluster size it to input bytes / 128 MB.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**SEMANTIC_CONF, **SCALE_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    parts = shuffle_partitions or os.environ.get("TIDEWATER_SHUFFLE_PARTITIONS")
    if parts:
        b = b.config("spark.sql.shuffle.partitions", str(parts))
    spark = b.getOrCreate()
    for k, v in SEMANTIC_CONF.items():
        spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Shared folder for lineage cuts and stream checkpoints.

    Read from ``spark.checkpoint.dir`` (the cluster names it). Only when it is
    unset -- local runs and tests -- is ``fallback`` installed.
    """
    ctx_dir = spark.sparkContext.getCheckpointDir()
    if ctx_dir:
        return ctx_dir
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        spark.sparkContext.setCheckpointDir(current)
        return current
    if not fallback:
        raise RuntimeError("spark.checkpoint.dir is not set; pass a shared fallback folder")
    spark.sparkContext.setCheckpointDir(fallback)
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


def scratch_dir(spark: SparkSession) -> str:
    """``checkpoint_dir``; a master on one machine (``local[*]``) gets a folder
    there where none is set, a cluster never does."""
    alone = spark.sparkContext.master.split("[")[0] == "local"
    return checkpoint_dir(spark, "file:///tmp/checkpoints" if alone else None)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the result-changing settings to an existing session (the driver's)."""
    for k, v in SEMANTIC_CONF.items():
        spark.conf.set(k, v)
    for k in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled",
              "spark.sql.adaptive.coalescePartitions.enabled"):
        spark.conf.set(k, "true")
    return spark
