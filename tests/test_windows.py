"""The skew-safe lead equals the plain window, also with one hot group."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tidewater.operators import with_next
from tidewater.operators.aggregates import main_value, nest


def test_bucketed_lead_equals_window(spark):
    rnd = random.Random(7)
    base = dt.datetime(2026, 1, 1)
    data = []
    for i in range(3000):
        g = 0 if i % 3 else rnd.randint(1, 40)            # group 0 holds two thirds of the rows
        t = base + dt.timedelta(seconds=rnd.randint(0, 3 * 86400))
        data.append((g, t, i, rnd.choice(["A", "B", "C"])))
    df = spark.createDataFrame(data, "g int, t timestamp_ntz, id int, a string")
    got = with_next(df, ["g"], ["t", "id"], ["t", "a"], width=600)
    want = with_next(df, ["g"], ["t", "id"], ["t", "a"], strategy="group")
    key = ["id", "next_t", "next_a"]
    assert sorted(map(tuple, got.select(key).collect()), key=str) == sorted(map(tuple, want.select(key).collect()), key=str)


def test_mode_ties_and_nulls(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, "a"), (1, None), (1, None), (1, None), (2, None)],
                               "k int, v string")
    r = {x.k: x for x in main_value(df, "k", "v", "m", "n").collect()}
    assert r[1].m == "a" and r[1].n == 7 and r[2].m is None and r[2].n == 1


def test_nest_keeps_order_and_all_rows(spark):
    df = spark.range(0, 500).select((F.col("id") % 2).alias("g"), F.col("id").alias("o"))
    docs = nest(df.repartition(7), ["g"], ["o"], ["o"])
    got = {r.g: [x.o for x in r["items"]] for r in docs.collect()}
    assert got == {0: list(range(0, 500, 2)), 1: list(range(1, 500, 2))}


def test_text_order_falls_back_to_window(spark):
    df = spark.createDataFrame([(1, "b", "x"), (1, "a", "y"), (2, "c", "z")], "g int, o string, v string")
    got = {r.o: r.next_v for r in with_next(df, ["g"], ["o"], ["v"]).collect()}
    assert got == {"a": "x", "b": None, "c": None}
