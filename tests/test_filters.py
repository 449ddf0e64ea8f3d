"""Filters (P1-P15), ordering (O1-O3, D10) and the small operators that are
otherwise only used inside larger queries (K9, J13, T6, Q6, Q11)."""

import datetime as dt
import json

from pyspark.sql import functions as F

from tidewater.functions.json_paths import doc_path
from tidewater.operators import (
    by_key, changed_between, filter_sales, in_period, last_days, missing_any, not_future, since, since_any,
    sort, starting_from, top, where_if, where_in, where_nonzero, where_path, where_present, work_list,
)
from tidewater.operators.joins import reconcile
from tidewater.plans import audits
from tidewater.sinks import verify_count


def frame(spark):
    d = lambda s: dt.datetime.fromisoformat(s)
    return spark.createDataFrame([
        (1, "A", "Autorizada", d("2026-01-01 10:00:00"), None, "0", True, True),
        (2, "A", "Cancelada", d("2026-01-05 23:59:59"), d("2026-01-06 00:00:00"), "2.5", True, False),
        (3, "B", "Autorizada", d("2026-02-01 00:00:00"), None, None, False, True),
        (4, None, "Pendente SEFAZ", None, d("2026-03-01 00:00:00"), "x", None, None),
    ], "id int, hotel string, status string, t timestamp_ntz, t2 timestamp_ntz, v string, a boolean, b boolean")


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_predicates(spark):
    df = frame(spark)
    assert ids(where_path(df, "hotel", "A")) == [1, 2]
    assert ids(where_in(df, "id", [1, 3, 9])) == [1, 3]
    assert ids(where_present(df, "t")) == [1, 2, 3] and ids(where_present(df, "t", False)) == [4]
    assert ids(since(df, "t", "2026-01-05")) == [2, 3]
    assert ids(in_period(df, "t", "2026-01-01", "2026-01-05")) == [1, 2]          # inclusive end day
    assert ids(since_any(df, ["t", "t2"], "2026-01-06")) == [2, 3, 4]
    assert ids(last_days(df, "t", "2026-01-06", 5)) == [1, 2]
    assert ids(missing_any(df.filter("a IS NOT NULL"), ["a", "b"])) == [2, 3]
    assert ids(where_nonzero(df, "v")) == [2]                                      # '0', NULL and 'x' are out
    assert ids(where_if(df, "hotel", None)) == [1, 2, 3, 4] and ids(where_if(df, "hotel", "B")) == [3]
    s = df.withColumn("data", F.to_date("t"))
    assert ids(filter_sales(s, hotel="A", status="Autorizada", start="2026-01-01", end="2026-01-31")) == [1]
    assert ids(by_key(df, "id", 3)) == [3]
    assert ids(changed_between(df, "t", "2026-01-02", "2026-02-01")) == [2]
    assert ids(starting_from(df, "t", "2026-02-01")) == [3]
    assert ids(not_future(df, "t", "2026-01-05")) == [1, 2]


def test_json_path_filter(spark):
    docs = spark.createDataFrame([(1, json.dumps({"attributes": {"state": "PAUSED"}})),
                                  (2, json.dumps({"attributes": {"state": "OPEN"}}))], "id int, data string")
    assert ids(where_path(docs, doc_path(docs, "data", "attributes.state"), "PAUSED")) == [1]
    v = docs.withColumn("data", F.parse_json("data"))
    assert ids(where_path(v, doc_path(v, "data", "attributes.state"), "OPEN")) == [2]


def test_ordering_postgres_nulls(spark):
    df = frame(spark)
    assert [r.id for r in sort(df, ["-t", "id"]).collect()] == [4, 3, 2, 1]         # DESC: NULL first (D10)
    assert [r.id for r in sort(df, ["t"]).collect()] == [1, 2, 3, 4]                 # ASC: NULL last
    assert [r.id for r in top(df, 2, ["-id"]).collect()] == [4, 3]


def test_small_operators(spark):
    df = frame(spark)
    assert verify_count(df) == 4                                                    # K9
    other = spark.createDataFrame([(1, "x"), (3, "y")], "id int, o string")
    assert ids(reconcile(df, other, "id")) == [1, 3]                               # J13
    assert sorted(r.hotel for r in work_list(df, "hotel").collect() if r.hotel) == ["A", "B"]   # T6
    occ = spark.createDataFrame([("s1", "COMPLETED", "H1"), ("s2", "COMPLETED", "H1"), ("s3", "OPEN", "H1")],
                                "scheduled_work_id string, status string, hotel string")
    assert [(r.hotel, r["count"]) for r in audits.completed_per_hotel(occ).collect()] == [("H1", 2)]   # Q6
    raw = spark.createDataFrame([("k1", json.dumps({"xml_content": "<a/>"}))], "nota_id string, data string")
    assert audits.note_xml(raw, "k1").first().xml_content == "<a/>"                # Q11
