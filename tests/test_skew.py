"""Operators on data where one key holds a third of all rows (and some keys
are NULL), checked against brute force in pandas."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewater.operators import left_lookup, main_value, one_per_key, with_exists, with_next, without
from tidewater.operators.aggregates import nest
from tidewater.sinks import dedupe_last

N = 6000


@pytest.fixture(scope="module")
def hot(spark):
    rows = []
    for i in range(N):
        k = 0 if i % 3 == 0 else (None if i % 97 == 0 else i % 500 + 1)
        rows.append((k, i, f"v{i % 7}", dt.datetime(2026, 1, 1) + dt.timedelta(minutes=i * 7 % 5000)))
    return spark.createDataFrame(rows, "k long, seq long, v string, t timestamp_ntz").repartition(6)


def test_dedupe_and_top1_on_hot_key(spark, hot):
    pdf = hot.toPandas()
    want = pdf.sort_values("seq").groupby("k", dropna=False).tail(1).set_index("seq")
    got = dedupe_last(hot, "k", "seq").toPandas().set_index("seq")
    assert sorted(got.index) == sorted(want.index)
    first = {r.k: r.seq for r in one_per_key(hot, "k", ["seq"], ["seq"]).collect()}
    assert first[0] == 0


def test_mode_on_hot_key(spark, hot):
    pdf = hot.toPandas()
    m = {r.k: r.main for r in main_value(hot, "k", "v", "main").collect()}
    grp = pdf[pdf.k == 0].groupby("v").size()
    assert m[0] == sorted(grp[grp == grp.max()].index)[0]


def test_lookups_with_hot_and_null_keys(spark, hot):
    right = spark.createDataFrame([(0, "zero"), (5, "five")], "rk long, name string")
    out = left_lookup(hot, right, "k", "rk", ["name"])
    assert out.count() == N
    assert out.filter(F.col("name") == "zero").count() == N // 3
    assert out.filter(F.col("k").isNull() & F.col("name").isNotNull()).count() == 0
    ex = with_exists(hot, right, "k", "rk", "hit")
    assert ex.filter("hit").count() == out.filter(F.col("name").isNotNull()).count()
    assert without(hot, right, "k", "rk").count() == N - ex.filter("hit").count()


def test_nest_and_lead_on_hot_group(spark, hot):
    (doc,) = nest(hot.filter(F.col("k").isNotNull()), ["k"], ["seq"], ["seq"]).filter("k = 0").collect()
    flat = [x.seq for x in doc["items"]]
    assert flat == sorted(flat) and len(flat) == N // 3
    got = with_next(hot, ["k"], ["t", "seq"], ["seq"], width=600)
    pdf = hot.toPandas().sort_values(["t", "seq"])
    pdf["want"] = pdf.groupby("k", dropna=False)["seq"].shift(-1)
    merged = got.toPandas().merge(pdf[["seq", "want"]], on="seq")
    assert (merged["next_seq"].fillna(-1) == merged["want"].fillna(-1)).all()
