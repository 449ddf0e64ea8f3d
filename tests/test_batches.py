"""Merge-on-read tables: latest wins, tombstones, cost of a batch, compaction."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tidewater.sinks import append_batch, changed_keys, compact, delete_keys, last_seq, read_merged, segments
from tidewater.sinks.batches import all_segments, to_merge, Segment

ROW = "id long, v string"


def rows(spark, base, key="id"):
    df = read_merged(spark, base, key)
    return {} if df is None else {r.id: r.v for r in df.collect()}


def put(spark, base, values, **more):
    return append_batch(spark.createDataFrame(list(values.items()), ROW), base, "id", stamp=None, **more)


def test_the_newest_row_of_a_key_wins(spark, tmp):
    base = f"{tmp}/t"
    assert read_merged(spark, base, "id") is None and last_seq(spark, base) == -1
    assert [put(spark, base, x) for x in ({1: "a", 2: "a", 3: "a"}, {2: "b", 4: "b"}, {2: "c"})] == [0, 1, 2]
    assert rows(spark, base) == {1: "a", 2: "c", 3: "a", 4: "b"}
    put(spark, base, {2: "c"})                                              # the same batch again
    assert rows(spark, base) == {1: "a", 2: "c", 3: "a", 4: "b"}
    delete_keys(spark.createDataFrame([(1,), (9,), (1,)], "id long"), base, "id")
    assert rows(spark, base) == {2: "c", 3: "a", 4: "b"}
    put(spark, base, {1: "back"})
    assert rows(spark, base) == {1: "back", 2: "c", 3: "a", 4: "b"}
    assert {r.id for r in changed_keys(spark, base, "id", 3).collect()} == {1, 9} and changed_keys(spark, base, "id", 5) is None
    assert read_merged(spark, base, "id").columns == ["id", "v"]


def test_order_picks_the_last_row_and_marks_delete(spark, tmp):
    base = f"{tmp}/t"
    df = spark.createDataFrame([(1, "old", 1, False), (1, "new", 2, False), (2, "x", 1, False)], ROW + ", n int, gone boolean")
    append_batch(df, base, "id", order=["n"], deleted="gone")
    assert rows(spark, base) == {1: "new", 2: "x"} and "extracted_at" in read_merged(spark, base, "id").columns
    append_batch(df.withColumn("gone", F.lit(True)).where("id = 2"), base, "id", order=["n"], deleted="gone")
    assert rows(spark, base) == {1: "new"}


def test_batches_without_rows_and_new_columns(spark, tmp):
    base = f"{tmp}/t"
    put(spark, base, {1: "a"})
    append_batch(spark.createDataFrame([], ROW), base, "id", stamp=None)
    append_batch(spark.createDataFrame([(2, "b", 7)], ROW + ", extra int"), base, "id", stamp=None)
    got = {r.id: (r.v, r.extra) for r in read_merged(spark, base, "id").collect()}
    assert got == {1: ("a", None), 2: ("b", 7)} and last_seq(spark, base) == 2
    empty = f"{tmp}/e"
    append_batch(spark.createDataFrame([], ROW), empty, "id", stamp=None)
    assert rows(spark, empty) == {} and not compact(spark, empty, "id", all_of_it=True)


def size(folder):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(folder) for f in fs)


def test_the_cost_of_a_batch_follows_the_batch(spark, tmp):
    base = f"{tmp}/t"
    big = spark.range(200_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"))
    append_batch(big, base, "id", stamp=None)
    before, files = size(base), {os.path.join(d, f) for d, _, fs in os.walk(base) for f in fs}
    put(spark, base, {i * 997: "new" for i in range(200)})                  # keys from all over the table
    assert size(base) - before < before / 100
    assert all(os.path.exists(f) for f in files)
    df = read_merged(spark, base, "id")
    assert df.count() == 200_000 and df.where("v = 'new'").count() == 200
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan      # the large segment is not shuffled


@pytest.mark.parametrize("seed", [1, 2])
def test_compaction_changes_no_read(spark, tmp, seed):
    base, rnd, want, most = f"{tmp}/t", random.Random(seed), {}, 0
    for step in range(14):
        if step % 5 == 4:
            ids = rnd.sample(range(60), 10)
            delete_keys(spark.createDataFrame([(i,) for i in ids], "id long"), base, "id")
            want = {k: v for k, v in want.items() if k not in ids}
        else:
            batch = {rnd.randrange(60): f"{step}-{rnd.random()}" for _ in range(rnd.randint(1, 15))}
            put(spark, base, batch)
            want |= batch
        done = compact(spark, base, "id", fanout=3)
        assert rows(spark, base) == want, step
        most = max(most, len(segments(spark, base)))
        if done:                                                            # a second reading of the same state
            assert rows(spark, base) == want
    assert most <= 6 and last_seq(spark, base) == 13
    while compact(spark, base, "id", all_of_it=True):
        pass
    assert rows(spark, base) == want and len(segments(spark, base)) == 1
    assert spark.read.parquet(segments(spark, base)[0].path).where("_deleted").count() == 0


def test_failed_batches_and_compactions_are_not_read(spark, tmp):
    base = f"{tmp}/t"
    for i in range(4):
        put(spark, base, {1: f"v{i}", i + 10: "x"})
    want = rows(spark, base)
    assert compact(spark, base, "id")
    merged = segments(spark, base)[0]
    assert (merged.first, merged.last) == (0, 3) and rows(spark, base) == want
    os.remove(f"{merged.path}/_SUCCESS")                                    # as if the job had died
    assert len(segments(spark, base)) == 4 and rows(spark, base) == want
    os.makedirs(f"{base}/seg=4-4")
    assert put(spark, base, {1: "v5"}) == 5 and rows(spark, base) == want | {1: "v5"}
    assert compact(spark, base, "id", all_of_it=True) and rows(spark, base) == want | {1: "v5"}
    assert put(spark, base, {2: "y"}) == 6
    assert compact(spark, base, "id", all_of_it=True) and rows(spark, base) == want | {1: "v5", 2: "y"}
    assert not any(s.first == s.last < 4 for s in all_segments(spark, base))  # merged parts go one compaction later


def test_small_batches_wait_for_each_other():
    s = lambda first, last, n: Segment(first, last, "", n, True)
    big = s(0, 9, 1_000_000)
    assert to_merge([big, s(10, 10, 10)], 4, 2) == []
    small = [s(i, i, 10) for i in range(10, 14)]
    assert to_merge([big, *small], 4, 2) == small
    assert to_merge([s(0, 0, 20), s(1, 1, 10), s(2, 2, 10)], 3, 2) == [s(0, 0, 20), s(1, 1, 10), s(2, 2, 10)]
