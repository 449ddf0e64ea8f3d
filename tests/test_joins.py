"""Join operators: top-1 lookups, two-stage resolution, existence, anti,
detail-else-bulk -- including NULL keys and non-hashable columns."""

from pyspark.sql import functions as F

from tidewater.operators import lookup_first, prefer, resolve, with_exists, without
from tidewater.operators.aggregates import coverage


def test_lookup_first_smallest_and_null_keys(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "zz")], "id int, k string") \
        .withColumn("m", F.create_map(F.lit("x"), F.col("id")))          # a map column must not break the salt
    right = spark.createDataFrame([("a", 5, "late"), ("a", 3, "early"), ("b", 1, "other")], "rk string, o int, v string")
    out = {r.id: r for r in lookup_first(left, right, "k", "rk", ["o"], ["v", "rk"]).collect()}
    assert (out[1].v, out[1].rk) == ("early", "a")
    assert out[2].v is None and out[3].v is None and len(out) == 3


def test_resolve_direct_then_composite(spark):
    left = spark.createDataFrame([
        (1, "n2", 10, "s"),     # direct hit (composite would give n1)
        (2, None, 10, "s"),     # no direct key -> composite, smallest of n1/n3
        (3, "nX", 10, "s"),     # direct key unknown -> composite
        (4, None, 99, "s"),     # nothing
    ], "id int, dk string, num int, site string")
    right = spark.createDataFrame([("n1", 10, "s"), ("n2", 20, "t"), ("n3", 10, "s")], "nid string, num2 int, site2 string")
    out = {r.id: r for r in resolve(left, right, ("dk", "nid"), (["num", "site"], ["num2", "site2"]),
                                    ["nid"], ["nid"], matched_by="via").collect()}
    assert [(out[i].nid, out[i].via) for i in (1, 2, 3, 4)] == [("n2", "direct"), ("n1", "composite"),
                                                                 ("n1", "composite"), (None, None)]


def test_exists_without_prefer_coverage(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "id int")
    right = spark.createDataFrame([(1,), (1,), (7,)], "rid int")
    ex = {r.id: r.hit for r in with_exists(left, right, "id", "rid", "hit").collect()}
    assert ex == {1: True, 2: False, None: False}
    assert sorted((r.id for r in without(left, right, "id", "rid").collect()), key=str) == [2, None]
    det = spark.createDataFrame([(1, "detail")], "id int, src string")
    bulk = spark.createDataFrame([(1, "bulk"), (2, "bulk")], "id int, src string")
    assert sorted(map(tuple, prefer(det, bulk, "id").collect())) == [(1, "detail"), (2, "bulk")]
    cov = coverage(left.withColumn("g", F.lit("x")), right, "id", ["g"], right_key="rid").first()
    assert (cov.total, cov.com, cov.sem) == (3, 1, 2)


def test_left_lookup_many_one_join(spark):
    from tidewater.operators import left_lookup_many
    left = spark.createDataFrame([(1,), (2,), (3,), (None,)], "id int")
    a = spark.createDataFrame([(1, "a1"), (2, None)], "k int, va string")        # a NULL value stays NULL
    b = spark.createDataFrame([(2, 20.0), (3, 30.0)], "k int, vb double")
    out = {r.id: (r.va, r.vb) for r in left_lookup_many(left, "id", [(a, "k", ["va"]), (b, "k", ["vb"])]).collect()}
    assert out == {1: ("a1", None), 2: (None, 20.0), 3: (None, 30.0), None: (None, None)}
    plan = left_lookup_many(left, "id", [(a, "k", ["va"]), (b, "k", ["vb"])])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 1                                     # one join, not one per lookup
