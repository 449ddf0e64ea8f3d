"""Named queries (Q1-Q31) on small synthetic bronze tables."""

import json
from decimal import Decimal

from pyspark.sql import functions as F

from tidewater.plans import audits as A
from tidewater.plans.fiscal import fact_pos, sales_daily, silver_cancels, silver_ledger, silver_notes
from tidewater.plans.line_items import internal_consumption_export
from tidewater.plans.measures import measures_by_calendar
from tidewater.operators import bounds

K = lambda c: c * 44


def bronze(spark, key, rows):
    return spark.createDataFrame([(k, json.dumps(d)) for k, d in rows], f"{key} string, data string")


def test_maintenance_audits(spark):
    bulk = bronze(spark, "scheduled_work_id", [
        ("1", {"attributes": {"state": "completed", "start_date": "2025-12-01T00:00:00", "completed_date": "2026-01-03T00:00:00"}}),
        ("2", {"attributes": {"state": "COMPLETED", "start_date": "2026-02-01T00:00:00"}}),
        ("3", {"attributes": {"state": "COMPLETED", "start_date": "2025-01-01T00:00:00"}}),
        ("4", {"attributes": {"state": "OPEN", "start_date": "2026-02-01T00:00:00"}}),
    ])
    det = bronze(spark, "scheduled_work_id", [("2", {"data": {}})])
    assert [r[0] for r in A.occurrences_without_detail(bulk, det, "2026-01-01").collect()] == ["1"]
    tickets = bronze(spark, "failure_id", [("7", {"attributes": {"state": "PAUSED", "created_at": "2026-01-02T00:00:00"}})])
    tdet = bronze(spark, "failure_id", [])
    assert A.tickets_without_detail(tickets, tdet, "2026-01-01").count() == 0          # D24: cited path absent
    assert A.tickets_without_detail(tickets, tdet, "2026-01-01", date_path="attributes.created_at").count() == 1
    assert [r.failure_id for r in A.ids_by_state(tickets, "PAUSED").collect()] == ["7"]
    plans = bronze(spark, "work_id", [("9", {"attributes": {"updated_at": "2026-03-01T00:00:00"}})])
    assert A.plans_without_detail(plans, bronze(spark, "work_id", []), "2026-01-01").count() == 1


def test_fiscal_and_sales_audits(spark):
    notes = silver_notes(bronze(spark, "nota_id", [
        (K("1"), {"hotel": "SA", "dhEmi": "2026-02-02T10:00:00-03:00", "nNF": "1", "vNF": "10.00", "cStat": "100"}),
        (K("2"), {"hotel": "SA", "dhEmi": "2026-01-02T10:00:00-03:00", "nNF": "2", "vNF": "5.00", "cStat": "100"}),
        (K("3"), {"hotel": "SB", "dhEmi": "2026-02-03T10:00:00-03:00", "nNF": "3", "vNF": "7.00"}),
    ]))
    pos = fact_pos(bronze(spark, "nota_id", [
        (K("1"), {"hotel": "SA", "Business Date": "2026-02-02", "Sub Total 1": 9.5, "Invoice Data Info 5": "310",
                  "Local Revenue Center Name": "Bar"})]))
    assert [r.nota_id for r in A.notes_without_pos(notes, pos, "2026-02-01").collect()] == [K("3")]
    ov = {r.hotel: (r.total_nfe, r.com_pdv, r.sem_pdv) for r in A.pos_overlap(notes, pos, "2026-02-01").collect()}
    assert ov == {"SA": (1, 1, 0), "SB": (1, 0, 1)}
    cancels = silver_cancels(bronze(spark, "cancelamento_id", [("c", {"chNFe": K("9"), "hotel": "SA"})]))
    assert A.cancels_without_note(cancels, notes).count() == 1
    assert A.notes_of_room(pos, "310").count() == 1 and A.pos_note(pos, K("1")).count() == 1
    assert A.sales_per_outlet(pos, "2026-02-02").first().total == Decimal("9.50")
    assert A.notes_per_hotel(pos).first().total == 1 and A.pos_per_day(pos).count() == 1

    sales = spark.createDataFrame([
        (K("1"), "SA", "2026-02-02 10:00:00", "10.00", "9.50", True, True, "Autorizada"),
        (K("2"), "SA", "2026-02-03 10:00:00", "5.00", None, False, True, "Autorizada"),
        (K("3"), "SB", "2026-02-03 10:00:00", "7.00", None, False, False, "Pendente SEFAZ"),
    ], "nota_id string, hotel string, data_emissao string, valor_total string, valor_pdv string, tem_pdv boolean, "
       "tem_fiscal boolean, status string").select(
        "nota_id", "hotel", F.col("data_emissao").cast("timestamp").alias("data_emissao"),
        F.col("valor_total").cast("decimal(12,2)").alias("valor_total"),
        F.col("valor_pdv").cast("decimal(12,2)").alias("valor_pdv"), "tem_pdv", "tem_fiscal", "status")
    assert [r.nota_id for r in A.value_gaps(sales).collect()] == [K("1")]
    assert A.pending_per_hotel(sales).first().pendentes == 1
    assert [r.nota_id for r in A.missing_side(sales).collect()] == [K("2")]
    daily = sales_daily(sales)
    assert A.sales_recent(daily, "2026-02-10", 30).count() == 3
    assert A.monthly_revenue(daily).count() == 2
    assert A.sales_notes_recent(sales, "2026-02-02", 0).count() == 1
    cal = measures_by_calendar(sales, bounds(sales, "data_emissao"))
    row = {str(r.data): r for r in cal.collect()}
    assert row["2026-02-03"].pendentes_sefaz == 1 and row["2026-02-02"].faturamento_total == Decimal("10.00")


def test_ledger_audits(spark):
    ledger = silver_ledger(bronze(spark, "lancamento_id", [
        ("1", {"EMPRESA": "E1", "FKEMPRESA": "1", "DTDATAEMISSAO": "2026-03-02T00:00:00", "ANCODIGO": "P", "ANDESCRICAO": "Tea",
               "VLVALORTOTAL": 3, "VLVALORTTDOCUMENTO": 10, "ANNUMERODOCUMENTO": "1", "ANSERIE": "1"}),
        ("2", {"EMPRESA": "E1", "FKEMPRESA": "1", "DTDATAEMISSAO": "2026-03-09T00:00:00", "ANCODIGO": "P", "ANDESCRICAO": "Tea",
               "VLVALORTOTAL": 4, "VLVALORTTDOCUMENTO": 10, "ANNUMERODOCUMENTO": "1", "ANSERIE": None}),
    ]), {"1": "SA"})
    assert A.ledger_per_company(ledger).first().total == 2
    assert A.ledger_per_day(ledger).count() == 2
    assert A.ledger_period(ledger, "2026-03-01", "2026-03-07").count() == 1
    assert A.best_products(ledger).first().valor_total == Decimal("7.00")
    d = A.distinct_documents(ledger).first()
    assert (d.total_rows, d.distinct_docs) == (2, 2)   # a NULL series still counts (G5)


def test_line_item_audits_and_export(spark):
    def item(i, chk, line, tipo, total, void="0", loc="Site Alpha", hotel="ALPHA"):
        return (str(i), {"hotel": hotel, "businessDate": "2026-03-26", "orderTypeName": tipo, "guestCheckID": chk,
                         "lineNum": line, "menuItemName1": f"P{i}", "majorGroupName": "G", "numerator": 1,
                         "lineCount": 2, "lineTotal": total, "isVoidFlag": void, "locationName": loc,
                         "revenueCenterNum": 5, "menuItemNum": 100 + i})
    raw = bronze(spark, "line_item_id", [item(1, 10, 2, "Consumo Interno", 4), item(2, 10, 1, "Consumo Interno", 6),
                                         item(3, 11, 1, "Consumo Interno", 0), item(4, 12, 1, "Venda", 9, void="1")])
    it = A.items(raw)
    assert A.items_per_day(it).first().total_items == 4
    ipd = A.internal_per_day(it).first()
    assert (ipd.comandas, ipd.itens, ipd.valor_total) == (2, 3, Decimal("10"))
    assert [r.produto for r in A.items_of_check(it, 10).collect()] == ["P2", "P1"]
    assert A.volume_per_order_type(it, "2026-03-26").count() == 2
    assert [r.produto for r in A.top_items(it, "2026-03-26", "ALPHA").collect()] == ["P2", "P1", "P3"]
    assert [r.line_item_id for r in A.internal_items(it, "2026-03-26").collect()] == ["2", "1"]
    from tidewater.sinks.export import document_text
    (doc,) = document_text(internal_consumption_export(raw, "2026-03-26"), ["location_name"]).collect()
    v = json.loads(doc.document)["Vendas"]["Venda"]
    assert [x["CodigoExterno"] for x in v] == ["102", "101"] and v[0]["ValorUnitario"] == 3.0 and v[0]["Quantidade"] == 2.0
    counts = {r.tabela: r.registros for r in A.raw_counts({"items": raw, "ledger": raw.limit(1)}).collect()}
    assert counts == {"items": 4, "ledger": 1}
