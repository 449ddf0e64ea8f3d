"""Domain views on synthetic bronze rows, including the D-rows of SURVEY §2.14."""

import json
from decimal import Decimal

from pyspark.sql import functions as F

from tidewater.plans.fiscal import (
    fact_ledger, fact_notes, fact_pos, sales_daily, sales_notes, silver_cancels, silver_ledger, silver_notes,
)
from tidewater.plans.line_items import fact_line_items
from tidewater.plans.maintenance import dim_operators, dim_plans, fact_occurrences, work_hours

COMPANY = {"1": "SA", "2": "SB"}
K = lambda c: c * 44


def bronze(spark, key, rows):
    return spark.createDataFrame([(k, json.dumps(d)) for k, d in rows], f"{key} string, data string") \
        .withColumn("extracted_at", F.current_timestamp())


def test_work_hours(spark):
    inc = [
        {"id": "1", "type": "event", "attributes": {"operator_id": 50}},
        {"id": "2", "type": "event", "attributes": {"operator_id": None}},
        {"id": "10", "type": "event_registry", "attributes": {"event_id": 1, "action": "STARTED", "date": "2026-01-01 08:00:00"}},
        {"id": "12", "type": "event_registry", "attributes": {"event_id": 1, "action": "PAUSED", "date": "2026-01-01 09:30:00"}},
        {"id": "11", "type": "event_registry", "attributes": {"event_id": 1, "action": "RESUMED", "date": "2026-01-01 09:30:00"}},
        {"id": "13", "type": "event_registry", "attributes": {"event_id": 1, "action": "COMPLETED", "date": "2026-01-01 10:00:00"}},
        {"id": "14", "type": "event_registry", "attributes": {"event_id": 1, "action": "STARTED", "date": "2026-01-01 11:00:00"}},
        {"id": "20", "type": "event_registry", "attributes": {"event_id": 2, "action": "STARTED", "date": "2026-01-01 08:00:00"}},
        {"id": "21", "type": "event_registry", "attributes": {"event_id": 2, "action": "COMPLETED", "date": "2026-01-01 09:00:00"}},
        {"id": "9", "type": "location", "attributes": {"name": "Room"}},
    ]
    det = bronze(spark, "failure_id", [("F1", {"id": "F1", "data": {"id": "F1"}, "included": inc}), ("F2", {"data": {"id": "F2"}})])
    rows = sorted(work_hours(det, "failure_id").collect(), key=lambda r: r.data_inicio)
    # STARTED 08:00 -> RESUMED 09:30 (id 11 before 12 at the same second): not an end, so no interval;
    # RESUMED 09:30 -> PAUSED 09:30 (0 h); PAUSED -> COMPLETED is no interval; trailing STARTED has no end;
    # event 2 has no owner.
    assert [(r.status_inicio, r.status_fim, r.operator_id, r.horas_decimais) for r in rows] == [("RESUMED", "PAUSED", 50, 0.0)]


def test_plans_and_occurrences(spark):
    rules = [("SITE ALPHA", "ALPHA")]
    det = bronze(spark, "work_id", [("1", {"data": {"id": "1", "attributes": {"name": "Plan one", "auto_close": "true"}},
                                           "included": [{"id": "a", "type": "work_type", "attributes": {"name": "Prev"}},
                                                        {"id": "b", "type": "location", "attributes": {"name": "Pool", "full_name": "Site Alpha - Pool"}},
                                                        {"id": "c", "type": "location", "attributes": {"name": "Bar", "full_name": "Other"}}]})])
    bulk = bronze(spark, "work_id", [("1", {"attributes": {"name": "stale"}}), ("2", {"attributes": {"name": "Plan two"}})])
    plans = {r.work_id: r for r in dim_plans(det, bulk, rules).collect()}
    assert plans["1"].nome_plano == "Plan one" and plans["1"].hotel == "ALPHA" and plans["1"].work_type_name == "Prev"
    assert plans["1"].auto_close is True and plans["2"].local_name is None and plans["2"].hotel is None

    occ_det = bronze(spark, "scheduled_work_id", [("s1", {"data": {"attributes": {"work_id": 2, "state": "COMPLETED"}},
                                                         "included": [{"type": "location", "attributes": {"name": "Lobby", "full_name": "Beta Place - Lobby"}}]})])
    occ_bulk = bronze(spark, "scheduled_work_id", [("s2", {"attributes": {"work_id": 1, "state": "OPEN", "start_date": "2026-01-01T08:00:00"}})])
    occ = {r.scheduled_work_id: r for r in fact_occurrences(occ_det, occ_bulk, dim_plans(det, bulk, rules), rules).collect()}
    assert occ["s1"].hotel == "Beta Place" and occ["s1"].nome_plano == "Plan two"
    assert occ["s2"].local_full_name == "Site Alpha - Pool" and occ["s2"].hotel == "ALPHA"  # from the plan (D18)
    assert str(occ["s2"].data_agendada) == "2026-01-01 08:00:00"


def test_operators_dimension(spark):
    raw = bronze(spark, "operator_id", [("7", {"attributes": {"full_name": "Ana", "cost_per_hour": "12.5", "warehouse_id": "x",
                                                              "is_from_network": "t", "created_at": "2025-05-01T10:00:00"}})])
    (r,) = dim_operators(raw).collect()
    assert r.nome_operador == "Ana" and r.custo_por_hora == Decimal("12.5") and r.warehouse_id is None and r.is_from_network


def ledger_fixture(spark):
    ledger = bronze(spark, "lancamento_id", [
        ("L1", {"FKEMPRESA": "1", "ANNUMERODOCUMENTO": "10", "ANSERIE": "1", "ANCHAVE": K("3"), "ANCFOP": "5102",
                "DTDATAEMISSAO": "2026-01-02T00:00:00", "VLVALORTOTAL": 2.675}),       # direct match
        ("L2", {"FKEMPRESA": "1", "ANNUMERODOCUMENTO": "10", "ANSERIE": "1", "ANCHAVE": "", "ANCFOP": "5102"}),  # composite
        ("L3", {"FKEMPRESA": "2", "ANNUMERODOCUMENTO": "11", "ANSERIE": "1", "ANCFOP": "5405"}),                # composite, 2 notes
        ("L4", {"FKEMPRESA": "8", "ANNUMERODOCUMENTO": "10", "ANSERIE": "1", "ANCFOP": "5102"}),                # unmapped company
        ("L5", {"FKEMPRESA": "1", "ANNUMERODOCUMENTO": "99", "ANSERIE": "1", "ANCHAVE": K("9")}),               # no match
    ])
    notes = bronze(spark, "nota_id", [
        (K("3"), {"nNF": "77", "serie": "1", "hotel": "SA", "cStat": "100", "nProt": "p3", "dhEmi": "2026-01-02T10:00:00-03:00", "vNF": "5.00"}),
        (K("4"), {"nNF": "10", "serie": "1", "hotel": "SA", "cStat": "100", "dhEmi": "2026-01-02T23:30:00-03:00", "vNF": "1.00"}),
        (K("6"), {"nNF": "11", "serie": "1", "hotel": "SB", "cStat": "101", "dhEmi": "2026-01-03T10:00:00-03:00", "vNF": "2.00"}),
        (K("5"), {"nNF": "11", "serie": "1", "hotel": "SB", "cStat": "100", "dhEmi": "2026-01-03T10:00:00-03:00", "vNF": "3.00"}),
    ])
    cancels = bronze(spark, "cancelamento_id", [("C1", {"chNFe": K("5"), "dhEvento": "2026-01-04T10:00:00-03:00", "xJust": "a"}),
                                                 ("C2", {"chNFe": K("5"), "dhEvento": "2026-01-05T10:00:00-03:00", "xJust": "b"})])
    return silver_ledger(ledger, COMPANY), silver_notes(notes), silver_cancels(cancels)


def test_fact_ledger_two_stage(spark):
    ledger, notes, cancels = ledger_fixture(spark)
    out = {r.lancamento_id: r for r in fact_ledger(ledger, notes, cancels).collect()}
    assert len(out) == 5                                           # keeps the ledger row count
    assert out["L1"].chave_nfe == K("3") and out["L1"].status_sefaz == "100"
    assert out["L2"].chave_nfe == K("4")                           # blank key -> composite
    assert out["L3"].chave_nfe == K("5") and out["L3"].cancelada   # smallest note id of two (D4); EXISTS, no fan-out
    assert out["L4"].hotel is None and out["L4"].chave_nfe is None  # D15
    assert out["L5"].chave_nfe is None and out["L5"].cancelada is False
    assert out["L1"].valor_total_item == Decimal("2.68")           # half up
    older = {r.lancamento_id: r for r in fact_ledger(ledger, notes, cancels, direct=False).collect()}
    # V6b matches by (number, series, site) only: L1 is 10/1/SA, so it resolves to note 4
    assert older["L1"].chave_nfe == K("4") and older["L5"].chave_nfe is None


def test_notes_sales_daily(spark):
    ledger, notes, cancels = ledger_fixture(spark)
    pos_raw = bronze(spark, "nota_id", [(K("4"), {"hotel": "SA", "Business Date": "2026-01-02", "Sub Total 1": 1.0,
                                                  "Check Number": 3, "Invoice Status": 1})])
    pos = fact_pos(pos_raw)
    assert pos.first().numero_comanda == 3 and pos.first().subtotal_1 == Decimal("1.00")
    nf = fact_notes(notes, cancels, pos)
    assert nf.count() == 4                                         # one row per note (D3)
    assert fact_notes(notes, cancels, pos, fan_out=True).count() == 5
    n5 = nf.filter(F.col("nota_id") == K("5")).first()
    assert n5.cancelada and n5.justificativa_cancelamento == "b"    # latest cancellation
    sales = sales_notes(nf, pos, fact_ledger(ledger, notes, cancels))
    st = {r.nota_id: r for r in sales.collect()}
    assert st[K("5")].status == "Cancelada" and st[K("6")].status == "Pendente SEFAZ" and st[K("4")].status == "Autorizada"
    assert st[K("4")].tem_pdv and st[K("4")].tem_fiscal and st[K("4")].qtd_itens == 1 and st[K("4")].cfop_principal == "5102"
    assert st[K("6")].tem_fiscal is False and st[K("6")].qtd_itens == 0
    daily = {(r.hotel, str(r.data)): r for r in sales_daily(sales).collect()}
    # 23:30 at -03:00 is the next day in UTC; the zone parameter moves it back
    assert ("SA", "2026-01-03") in daily
    local = {(r.hotel, str(r.data)): r for r in sales_daily(sales, zone="America/Recife").collect()}
    assert local[("SA", "2026-01-02")].total_notas == 2 and local[("SA", "2026-01-02")].valor_total_dia == Decimal("6.00")
    sb = local[("SB", "2026-01-03")]
    assert (sb.total_notas, sb.notas_canceladas, sb.notas_pendentes, sb.valor_total_dia) == (2, 1, 1, Decimal("2.00"))


def test_line_items(spark):
    raw = bronze(spark, "line_item_id", [
        ("1", {"lineCount": 3, "lineTotal": 10, "transactionEmployeeFirstName": "A", "transactionEmployeeLastName": "B",
               "isVoidFlag": 1, "locationName": "Loc", "transactionDateTime": "2026-01-01T10:00:00"}),
        ("2", {"lineCount": 0, "lineTotal": 5, "transactionEmployeeFirstName": "A", "isVoidFlag": 0}),
    ])
    r = {x.line_item_id: x for x in fact_line_items(raw).collect()}
    assert round(float(r["1"].valor_unitario), 6) == 3.333333 and r["1"].colaborador == "A B" and r["1"].cancelado
    assert r["2"].valor_unitario == 0 and r["2"].colaborador is None and r["2"].cancelado is False


def test_local_day_independent_of_session_zone(spark):
    from tidewater.functions.scalar import instant, local_day
    df = spark.createDataFrame([("2026-01-02T23:30:00-03:00",)], "t string").select(instant("t").alias("i"))
    try:
        for tz in ("UTC", "Asia/Tokyo", "America/Recife"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            assert str(df.select(local_day("i", "America/Recife").alias("d")).first().d) == "2026-01-02"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_text_to_utc_drops_offset_in_any_session_zone(spark):
    from tidewater.functions.scalar import iso_date, text_to_utc
    df = spark.createDataFrame([("2026-01-02T10:00:00-03:00",)], "t string")
    try:
        for tz in ("UTC", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            r = df.select(F.unix_timestamp(text_to_utc("t")).alias("u"), iso_date("t").alias("d")).first()
            assert r.u == 1767348000 and str(r.d) == "2026-01-02"        # 2026-01-02 10:00:00 read as UTC (X2, X1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
