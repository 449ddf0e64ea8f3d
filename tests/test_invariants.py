"""SURVEY §5 invariants on the registered queries over whole sf0.01 tables."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from tidewater.sinks import upsert

SF = "/root/testdata/sf0.01"


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def test_ledger_fact_keeps_row_count(spark):
    q = E.queries()["ledger_fact"](spark, SF)
    assert q.count() == table(spark, "lineitem").count()
    assert q.select("lancamento_id").distinct().count() == q.count()


def test_sales_one_row_per_note(spark):
    s = E.queries()["sales_status"](spark, SF)
    assert s.count() == table(spark, "orders").count() == s.select("nota_id").distinct().count()
    nf = E.queries()["note_facts"](spark, SF)
    assert nf.count() == nf.select("nota_id").distinct().count() == table(spark, "orders").count()


def test_overlap_with_plus_without_is_total(spark):
    o = E.queries()["overlap"](spark, SF)
    assert o.filter(F.col("com_pdv") + F.col("sem_pdv") != F.col("total")).count() == 0
    assert o.agg(F.sum("total")).first()[0] == table(spark, "orders").count()


def test_upsert_twice_is_once_on_whole_table(spark):
    o = table(spark, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    batch = o.filter(F.col("o_orderstatus") == "P").withColumn("o_orderstatus", F.lit("O"))
    once = upsert(o, batch, "o_orderkey", "o_totalprice")
    twice = upsert(once, batch, "o_orderkey", "o_totalprice")
    assert once.count() == o.count() == twice.count()
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


def test_dedupe_one_row_per_key(spark):
    d = E.queries()["dedupe_last"](spark, SF)
    keys = table(spark, "lineitem").select("l_orderkey", "l_linenumber").distinct().count()
    assert d.count() == keys


def test_ticket_documents_collect_no_group(spark):
    from tidewater.plans.stand_ins import work_hours_docs
    plan = work_hours_docs(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan
