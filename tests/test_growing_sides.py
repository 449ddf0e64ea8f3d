"""Joins whose right side grows with the left: nothing broadcast, no columns carried for a salt, one shuffle for joins on one key."""

from pyspark.sql import functions as F

from tidewater.operators import left_joins, left_lookup, resolve, without
from tidewater.plans import audits, fiscal


def plan(df, kind="optimizedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


def rows(spark):
    left = spark.createDataFrame([(1, "a", "x", "w1"), (2, None, "y", "w2"), (3, "", "x", "w3"), (4, None, None, "w4"), (4, None, None, "w4"), (5, "zz", "y", "w5")],
                                 "id long, dk string, num string, wide string")
    right = spark.createDataFrame([("a", "x", 1), ("b", "x", 2), ("c", "y", 3), (None, None, 4)], "nid string, num2 string, v int")
    return left, right


def resolved(spark):
    left, right = rows(spark)
    return resolve(left, right, ("dk", "nid"), (["num"], ["num2"]), ["nid"], ["nid", "v"], "via")


def test_resolve_carries_no_columns_for_its_salt(spark):
    got = sorted((r.id, r.nid, r.v, r.via) for r in resolved(spark).collect())
    assert got == sorted([(1, "a", 1, "direct"), (2, "c", 3, "composite"), (3, "a", 1, "composite"), (4, None, None, None), (4, None, None, None),
                          (5, "c", 3, "composite")])
    lines = plan(resolved(spark).select("id", "v")).splitlines()
    deepest = max(i for i, x in enumerate(lines) if "Join LeftOuter" in x)
    assert not any("wide#" in x for x in lines[:deepest + 1])


def test_growing_sides_are_not_broadcast(spark):
    left, right = rows(spark)
    notes = spark.createDataFrame([("k1", "1997-01-02T00:00:00"), ("k2", "1997-01-03T00:00:00"), ("k2", "1997-01-03T00:00:00"), ("k3", "1996-01-01T00:00:00"), (None, "1997-01-02T00:00:00")],
                                  "nota_id string, dhEmi string").selectExpr("*", "'H' hotel", "'7' nNF", "1.0 vNF")
    q8 = audits.notes_without_pos(notes, spark.createDataFrame([("k1",)], "chave_nfe string"), "1997-01-01")
    assert sorted((r.nota_id or "") for r in q8.collect()) == ["", "k2", "k2"]
    for df in (resolved(spark), q8, without(left, right, "dk", "nid", grows=True)):
        assert "BroadcastHashJoin" not in plan(df, "executedPlan")


def test_salt_never_matches_a_real_key(spark):
    left = spark.range(2000).select("id", F.lit(None).cast("string").alias("k"))
    right = spark.range(1 << 16).select(F.col("id").cast("string").alias("rk"), F.lit(1).alias("v"))
    salted = left_lookup(left, right, "k", "rk", ["v"], salt=F.col("id"), grows=True)
    assert (salted.count(), salted.where("v is not null").count()) == (2000, 0)
    many = left_joins(left, "k", [(right, "rk", ["v"])])
    assert (many.count(), many.where("v is not null").count()) == (2000, 0)


def test_left_joins_fan_out_and_shuffle_the_left_once(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4), ("c", 5)], "k string, id int")
    two = spark.createDataFrame([("a", "p"), ("a", "q"), ("b", "r"), (None, "s")], "c string, x string")
    one = spark.createDataFrame([("b", True), ("c", True)], "p string, y boolean")
    df = left_joins(left, "k", [(two, "c", ["x"]), (one, "p", ["y"])])
    assert sorted((r.id, r.x, r.y) for r in df.collect()) == [(1, "p", None), (1, "q", None), (2, "r", True), (3, "r", True), (4, None, None), (5, None, True)]
    shown = plan(df, "executedPlan").split("== Initial Plan ==")[-1]
    assert shown.count("SortMergeJoin") == 2 and shown.count("Exchange hashpartitioning") == 3


def test_fan_out_of_notes_is_merged(spark):
    notes = spark.createDataFrame([("n1",), ("n2",), (None,)], "nota_id string").selectExpr(
        "*", *[f"cast(null as string) {c}" for c in ("hotel", "dhEmi", "nNF", "serie", "mod", "tpAmb", "cnpj_emit", "nome_emit", "nProt", "cStat", "dhRecbto")], "cast(1 as decimal(12,2)) vNF")
    cancels = spark.createDataFrame([("n1", "c1"), ("n1", "c2"), ("n9", "c3")], "chNFe string, cancelamento_id string").selectExpr(
        "*", "'1999-01-01T00:00:00' dhEvento", "'1' nProt", "'m' xJust")
    pos = spark.createDataFrame([("n2",)], "chave_nfe string").selectExpr("*", "date'1999-01-01' data_venda", "cast(2 as decimal(12,2)) subtotal_1", "'P' ponto_venda")
    got = fiscal.fact_notes(notes, cancels, pos, fan_out=True)
    assert sorted((r.nota_id or "", r.cancelada, r.tem_pdv) for r in got.collect()) == [("", False, False), ("n1", True, False), ("n1", True, False), ("n2", False, True)]
    assert "BroadcastHashJoin" not in plan(got, "executedPlan")
