"""Skew probe: one key holds a third of all rows -- how much of the work
lands in a single task?

Derives a hot-key line-item table from the driver data (a third of the rows
moved to order key 0), runs each operator and its naive form, and reads
Spark's event log (written to a scratch folder) to report, per job, the
largest share of shuffled bytes any single task of a post-shuffle stage
read (bytes, not rows: a partial collect_list ships few rows but big ones).

    python tools/skew_probe.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tidewater.operators import left_lookup, main_value, with_next  # noqa: E402
from tidewater.operators.aggregates import nest  # noqa: E402
from tidewater.session import build_session  # noqa: E402
from tidewater.sinks import dedupe_last  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    logdir = tempfile.mkdtemp(prefix="tidewater-eventlog-")
    # Emulate a large table at probe size: many map tasks, no coalescing of
    # reduce partitions, no broadcast, and AQE's skew thresholds scaled down
    # to this data size (on a cluster they are 128 MB / 3x the median).
    spark = build_session("local[8]", shuffle_partitions=16, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": logdir,
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256KB"})
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    hot = (li.withColumn("l_orderkey", F.when(F.col("l_partkey") % 3 == 0, F.lit(0)).otherwise(F.col("l_orderkey")))
             .repartition(16))   # many map tasks, as a large multi-file table has
    orders = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", "o_orderstatus")

    runs = {
        "dedupe_last (row_number = 1, partial limit)": lambda: dedupe_last(hot, ["l_orderkey"], ["l_shipdate", "l_partkey", "l_suppkey", "l_linenumber"]),
        "dedupe naive (row_number window)": lambda: hot.withColumn(
            "rn", F.row_number().over(Window.partitionBy("l_orderkey").orderBy(
                F.desc("l_shipdate"), F.desc("l_partkey"), F.desc("l_suppkey"), F.desc("l_linenumber")))).filter("rn = 1"),
        "mode (two partial aggregates)": lambda: main_value(hot, "l_orderkey", "l_returnflag", "m"),
        "mode naive (mode aggregate)": lambda: hot.groupBy("l_orderkey").agg(F.mode("l_returnflag").alias("m")),
        "lead bucketed": lambda: with_next(hot, ["l_orderkey"], ["l_shipdate", "l_partkey", "l_suppkey", "l_linenumber"],
                                           ["l_shipdate"], width=86400 * 30),
        "lead naive (window per group)": lambda: with_next(hot, ["l_orderkey"], ["l_shipdate", "l_partkey", "l_suppkey",
                                                                                 "l_linenumber"], ["l_shipdate"], strategy="group"),
        "lookup hot left key": lambda: left_lookup(hot, orders, "l_orderkey", "o_orderkey", ["o_orderstatus"]),
    }
    marks = {}
    for name, build in runs.items():
        spark.sparkContext.setJobGroup(name, name)
        t0 = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        marks[name] = round(time.perf_counter() - t0, 2)
    spark.stop()

    # --- read the event log: tasks per stage, records per task
    stage_group, tasks = {}, defaultdict(list)
    for path in glob.glob(f"{logdir}/**/*", recursive=True):
        if os.path.isdir(path) or "appstatus" in os.path.basename(path):
            continue
        raw = open(path, "rb").read()
        if path.endswith(".zstd"):
            import io
            import zstandard
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode("utf-8").splitlines():
            if line.strip():
                e = json.loads(line)
                ev = e.get("Event")
                if ev == "SparkListenerJobStart":
                    g = e.get("Properties", {}).get("spark.jobGroup.id")
                    for sid in e.get("Stage IDs", []):
                        stage_group[sid] = g
                elif ev == "SparkListenerTaskEnd":
                    m = e.get("Task Metrics") or {}
                    r = m.get("Shuffle Read Metrics") or {}
                    tasks[e["Stage ID"]].append(r.get("Remote Bytes Read", 0) + r.get("Local Bytes Read", 0))
    print(f"one key = 1/3 of rows; fair share of one of 16 tasks = {1/16:.1%}")
    print(f"{'operator':40s} {'sec':>6s} {'max task share of shuffled bytes':>33s}")
    for name in runs:
        worst = 0.0
        for sid, recs in tasks.items():
            if stage_group.get(sid) != name or not recs or sum(recs) == 0 or len(recs) < 2:
                continue
            if sum(recs) < 100_000:   # the small per-bucket / per-partition helper stages
                continue
            worst = max(worst, max(recs) / sum(recs))
        print(f"{name:40s} {marks[name]:6.2f} {worst:31.1%}")


if __name__ == "__main__":
    main()
