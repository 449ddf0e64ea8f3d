"""Upsert, de-duplication, soft delete, versioned tables, exports."""

import json

from pyspark.sql import functions as F

from tidewater.sinks import commit_version, dedupe_last, read_current, soft_delete, upsert, upsert_table, versions
from tidewater.sinks.export import (
    document_text, export_documents, export_receipts_xml, sale_record, with_config, write_documents,
)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_dedupe_last_wins_and_is_order_independent(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), ("b", 1, "q")], "k string, seq int, v string")
    assert rows(dedupe_last(df, "k", "seq"), "k", "v") == [("a", "z"), ("b", "q")]
    assert rows(dedupe_last(df.orderBy(F.desc("seq")).repartition(3), "k", "seq"), "k", "v") == [("a", "z"), ("b", "q")]


def test_upsert_replaces_and_is_idempotent(spark):
    target = spark.createDataFrame([("1", "old"), ("2", "keep")], "id string, data string")
    batch = spark.createDataFrame([("1", "new"), ("3", "ins"), ("3", "ins2")], "id string, data string")
    once = upsert(target, batch, "id", order="data")
    twice = upsert(once, batch, "id", order="data")
    assert rows(once, "id", "data") == [("1", "new"), ("2", "keep"), ("3", "ins2")]
    assert rows(twice, "id", "data") == rows(once, "id", "data")


def test_versioned_table(spark, tmp):
    base = f"{tmp}/bronze/notes"
    b1 = spark.createDataFrame([("1", "a")], "id string, data string")
    upsert_table(b1, base, "id", ())
    upsert_table(spark.createDataFrame([("1", "b"), ("2", "c")], "id string, data string"), base, "id", ())
    assert versions(spark, base) == [0, 1]
    cur = read_current(spark, base)
    assert rows(cur, "id", "data") == [("1", "b"), ("2", "c")]
    assert "extracted_at" in cur.columns
    commit_version(cur.limit(0), base)
    assert versions(spark, base) == [0, 1, 2]


def test_soft_delete_keeps_other_fields(spark):
    docs = spark.createDataFrame([
        ("1", json.dumps({"attributes": {"state": "PAUSED", "n": 1.5}, "x": [1, 2]})),
        ("2", json.dumps({"attributes": {"state": "PAUSED"}})),
        ("3", json.dumps({"data": {"id": "3"}})),
    ], "id string, data string")
    ids = spark.createDataFrame([("1",), ("9",)], "id string")
    out = {r.id: json.loads(r.data) for r in soft_delete(docs, ids, "id", ["attributes", "state"]).collect()}
    assert out["1"] == {"attributes": {"state": "EXCLUIDO", "n": 1.5}, "x": [1, 2]}
    assert out["2"]["attributes"]["state"] == "PAUSED"
    det = soft_delete(docs, spark.createDataFrame([("3",)], "id string"), "id", ["data", "attributes", "status"])
    assert json.loads(det.filter("id = '3'").first().data) == {"data": {"id": "3", "attributes": {"status": "EXCLUIDO"}}}


def test_export_json_documents(spark, tmp):
    items = spark.createDataFrame([
        ("Site Alpha", 1, 2, 10, "10.05", 2), ("Site Alpha", 1, 1, 11, "2.675", 1),
        ("Site Beta", 2, 1, 12, "5", None), ("Site Beta", 2, 2, None, "5", 0)],
        "loc string, chk int, line int, item int, total string, cnt int")
    config = spark.createDataFrame([("SITE_ALPHA", "6", "C1", "K1", "SER-1")],
                                   "config_key string, EmpresaId string, CodigoDaEmpresa string, ChaveDeAcesso string, EmissordoCupom string")
    items = with_config(items, config, "loc")
    docs = export_documents(items, ["loc"], ["chk", "line"], sale_record(F.lit(7), "item", "total", "cnt"),
                            F.lit("2026-03-26"))
    out = {r.loc: json.loads(r.document) for r in document_text(docs, ["loc"]).collect()}
    a = out["Site Alpha"]
    assert a["EmpresaId"] == 6 and a["CodigoDaEmpresa"] == "C1" and a["DataDoMovimento"] == "2026-03-26"
    assert a["ExecucaoImediata"] is False
    assert [v["CodigoExterno"] for v in a["Vendas"]["Venda"]] == ["11", "10"]            # line order
    assert a["Vendas"]["Venda"][0] == {"CodigoPDV": "7", "EmissordoCupom": "SER-1", "CodigoExterno": "11",
                                       "UnidadeMedida": "UN", "Quantidade": 1.0, "ValorUnitario": 2.68}   # D9
    assert a["Vendas"]["Venda"][1]["ValorUnitario"] == 5.03                                # 10.05 / 2 half up
    b = out["Site Beta"]
    assert b["EmpresaId"] == 0 and [v["Quantidade"] for v in b["Vendas"]["Venda"]] == [1.0, 1.0]  # null/0 -> 1
    assert b["Vendas"]["Venda"][1]["CodigoExterno"] == ""                                 # missing code -> 
    write_documents(docs, f"{tmp}/export", ["loc"])
    assert files_as_text(f"{tmp}/export/loc=Site Alpha") and json.loads(files_as_text(f"{tmp}/export/loc=Site Alpha")) == a


def files_as_text(folder):
    """A group's document: its part files in name order."""
    import glob
    return "".join(open(f, encoding="utf-8").read() for f in sorted(glob.glob(f"{folder}/part-*")))


def test_one_document_of_any_size(spark, tmp):
    """A check of 60,000 lines is one receipt, and a site of 60,000 items one document, over many part files."""
    import xml.etree.ElementTree as ET
    n = 60_000
    items = spark.range(n).selectExpr("'S' as site", "1 as chk", "id as line", "'Tea ' || id as name", "'3.00' as total", "1 as cnt")
    docs = export_receipts_xml(items, ["site"], "chk", {"NumeroCOO": F.col("chk"), "ValorTotal": F.lit("180000.00")},
                               {"DescricaoProduto": F.col("name")}, ["line"])
    write_documents(docs, f"{tmp}/xml", ["site"])
    receipts = ET.fromstring(files_as_text(f"{tmp}/xml/site=S")).findall("PDVVenda")
    assert len(receipts) == 1 and receipts[0].findtext("ValorTotal") == "180000.00"
    assert [i.findtext("DescricaoProduto") for i in receipts[0].iter("Item")] == [f"Tea {i}" for i in range(n)]
    docs = export_documents(with_config(items, None, "site"), ["site"], ["line"], sale_record(F.lit(5), "line", "total", "cnt"),
                            F.lit("2026-03-26"))
    write_documents(docs, f"{tmp}/json", ["site"])
    venda = json.loads(files_as_text(f"{tmp}/json/site=S"))["Vendas"]["Venda"]
    assert [v["CodigoExterno"] for v in venda] == [str(i) for i in range(n)]


def test_rejects_of_a_job_that_runs_again(spark, tmp):
    from tidewater.sinks import write_rejects
    bad = spark.createDataFrame([("f.xml", "invalid XML")], "file_name string, error string")
    for df in (bad, bad):
        write_rejects(df, f"{tmp}/rej", "2026-02-20", "notes")
    write_rejects(bad, f"{tmp}/rej", "2026-02-20", "ledger")
    assert spark.read.parquet(f"{tmp}/rej").count() == 2
    write_rejects(bad.limit(0), f"{tmp}/rej", "2026-02-20", "notes")
    assert [r.job for r in spark.read.parquet(f"{tmp}/rej").collect()] == ["ledger"]


def test_few_files_per_partition(spark, tmp):
    import glob
    from tidewater.sinks import key_bucket, upsert_partitioned
    df = spark.range(20_000).selectExpr("cast(id as string) as id", "'x' as data").repartition(16)
    upsert_partitioned(df, f"{tmp}/t", "id", key_bucket("id", 20), ())
    assert len(glob.glob(f"{tmp}/t/part=*/*.parquet")) <= 40


def test_old_versions_go(spark, tmp):
    df = spark.createDataFrame([("1",)], "id string")
    for _ in range(5):
        commit_version(df, f"{tmp}/v")
    assert versions(spark, f"{tmp}/v") == [2, 3, 4]


def test_export_receipts_xml(spark):
    items = spark.createDataFrame([("S", 1, 1, "Tea", "3.00"), ("S", 1, 2, "Cake", "4.50"), ("S", 2, 1, "Tea", "3.00")],
                                  "site string, chk int, line int, name string, total string")
    docs = export_receipts_xml(items, ["site"], "chk", {"NumeroCOO": F.col("chk")},
                               {"DescricaoProduto": F.col("name"), "ValorTotalLiquido": F.col("total")}, ["line"])
    (doc,) = [r.document for r in document_text(docs, ["site"]).collect()]
    assert doc.count("<PDVVenda>") == 2 and doc.count("<Item>") == 3
    assert doc.index("<DescricaoProduto>Tea") < doc.index("<DescricaoProduto>Cake")
    import xml.etree.ElementTree as ET
    root = ET.fromstring(doc)                                   # well-formed, one document
    assert root.tag == "Vendas"
    receipts = root.findall("PDVVenda")
    assert [r.findtext("NumeroCOO") for r in receipts] == ["1", "2"]
    assert [i.findtext("ValorTotalLiquido") for i in receipts[0].find("Itens").findall("Item")] == ["3.00", "4.50"]


def test_upsert_partitioned_rewrites_only_touched_partitions(spark, tmp):
    import os
    from tidewater.sinks import note_month, upsert_partitioned
    path = f"{tmp}/bronze/notes_p"
    k = lambda ym, n: "23" + ym + str(n).zfill(38)
    first = spark.createDataFrame([(k("2601", 1), "a"), (k("2601", 2), "b"), (k("2602", 3), "c")], "id string, data string")
    upsert_partitioned(first, path, "id", note_month("id"), ())
    stamp_2601 = sorted(os.listdir(f"{path}/part=2601"))
    batch = spark.createDataFrame([(k("2602", 3), "c2"), (k("2602", 4), "d"), (k("2602", 4), "e")], "id string, data string")
    out = rows(upsert_partitioned(batch, path, "id", note_month("id"), order="data"), "id", "data")
    assert out == [(k("2601", 1), "a"), (k("2601", 2), "b"), (k("2602", 3), "c2"), (k("2602", 4), "e")]
    assert sorted(os.listdir(f"{path}/part=2601")) == stamp_2601          # untouched partition not rewritten
    again = upsert_partitioned(batch, path, "id", note_month("id"), order="data")
    assert rows(again, "id", "data") == out                                # idempotent


def test_observed_counts_a_write(spark, tmp):
    from tidewater.sinks import observed
    df = spark.createDataFrame([("1", None), ("2", "bad"), ("3", None)], "id string, error string")
    df, obs = observed(df, "load", errors=F.count_if(F.col("error").isNotNull()))
    df.write.parquet(f"{tmp}/obs")
    assert obs.get == {"rows": 3, "errors": 1}


def test_commit_after_a_crashed_write(spark, tmp):
    import os
    base = f"{tmp}/bronze/crash"
    df = spark.createDataFrame([("1", "a")], "id string, data string")
    commit_version(df, base)
    os.makedirs(f"{base}/v=1")                                        # a write that died before _SUCCESS
    open(f"{base}/v=1/part-0.parquet", "w").close()
    assert versions(spark, base) == [0]                              # readers ignore it
    commit_version(df.withColumn("data", F.lit("b")), base)         # the retry does not collide with it
    assert versions(spark, base) == [0, 2]
    assert read_current(spark, base).first().data == "b"


def test_documents_are_checked_by_line(spark):
    from tidewater.plans.stand_ins import export_groups
    from tidewater.sinks.export import checked_documents
    head, foot = '{"EmpresaId":1,"Vendas":{"Venda":[', "]}}"
    item = lambda i: f'{{"CodigoExterno":"{i}"}}'
    docs = {"good": [item(1), "," + item(2), "," + item(10)], "one": [item(5)], "none": [], "no comma": [item(1), item(2)],
            "comma first": ["," + item(1), item(2)], "broken": [item(1), ',{"CodigoExterno":"2"'], "two in one": [item(1) + "," + item(2)]}
    rows = [(g, (0, None), head) for g in docs] + [(g, (2, None), foot) for g in docs if g != "one"]
    rows += [(g, (1, i), x) for g, xs in docs.items() for i, x in enumerate(xs)] + [("one", (2, None), "]}")]
    lines = spark.createDataFrame(rows, "g string, place struct<section: int, o0: int>, line string")
    got = {r["g"]: tuple(r)[1:] for r in checked_documents(lines, ["g"]).collect()}
    assert got["good"] == (True, 3, "1", "10") and got["none"] == (True, 0, None, None)
    assert not any(got[g][0] for g in docs if g not in ("good", "none"))
    plan = export_groups(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "from_json" not in plan
