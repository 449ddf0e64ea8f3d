"""End to end: landed files -> bronze -> gold -> views -> audit queries."""

import json
import os


def as_json(v):
    """VARIANT (bronze) or JSON text -> Python value."""
    return json.loads(v.toJson() if hasattr(v, "toJson") else v)

from pyspark.sql import functions as F

from tidewater.plans import audits, jobs

COMPANY = {"1": "SA"}
k = lambda n: "23" + "2602" + str(n).zfill(38)


def note_xml(key, nnf, cstat="100"):
    prot = f"<protNFe><infProt><nProt>p{nnf}</nProt><cStat>{cstat}</cStat><dhRecbto>2026-02-19T12:00:00-03:00</dhRecbto></infProt></protNFe>"
    return (f'<nfeProc xmlns="urn:x"><NFe><infNFe Id="NFe{key}"><ide><mod>65</mod><serie>1</serie><nNF>{nnf}</nNF>'
            f'<dhEmi>2026-02-19T12:00:00-03:00</dhEmi><tpAmb>1</tpAmb></ide><emit><CNPJ>1</CNPJ><xNome>E</xNome></emit>'
            f'<total><ICMSTot><vNF>{nnf}.00</vNF></ICMSTot></total></infNFe></NFe>{prot}</nfeProc>')


def write(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w", encoding="utf-8") as f:
        f.write(text if isinstance(text, str) else json.dumps(text))


def test_jobs_end_to_end(spark, tmp):
    land, bronze, gold, rej = (f"{tmp}/{x}" for x in ("land", "bronze", "gold", "rejects"))
    # POS files
    write(f"{land}/pos", "SiteA_2026-02-19.json", [[{"Store Number": "ST"}], [{}], [
        {"Invoice Data Info 8": k(1), "Business Date": "2026-02-19", "Sub Total 1": 1.0},
        {"Invoice Data Info 8": k(2), "Business Date": "2026-02-19", "Sub Total 1": 2.5}], [{}]])
    write(f"{land}/pos", "x_GCM_2026-02-19.json", [[{"guestCheckLineItemID": 5, "locationRef": "L"}]])
    assert jobs.load_pos(spark, f"{land}/pos", bronze, {"ST": "SA"})["rows"] == 2
    assert jobs.load_line_items(spark, f"{land}/pos", bronze, {"L": "SA"})["rows"] == 1
    # tax notes and cancellations from a share folder
    share = f"{land}/shares/SHARE_A"
    write(share, f"NFe{k(1)}-nfe.xml", note_xml(k(1), 1))
    write(share, f"NFe{k(2)}-nfe.xml", note_xml(k(2), 2))
    write(share, f"NFe{k(3)}-nfe.xml", note_xml(k(3), 3, cstat="105"))
    write(share, "broken.xml", "<nfeProc>")
    write(share, "CFe_ignored.xml", "<x/>")
    write(share, f"ID110111{k(2)}01-can.xml", f'<envEvento><evento><infEvento Id="ID110111{k(2)}01"><chNFe>{k(2)}</chNFe>'
                                               f'<dhEvento>2026-02-20T10:00:00-03:00</dhEvento></infEvento></evento></envEvento>')
    got = jobs.load_notes(spark, f"{land}/shares", bronze, {"SHARE_A": "SA"}, rej, "2026-02-20")
    assert got["notes"]["rows"] == 3 and got["cancels"]["rows"] == 1
    assert spark.read.parquet(rej).count() == 1
    again = jobs.load_notes(spark, f"{land}/shares", bronze, {"SHARE_A": "SA"}, rej, "2026-02-21")
    assert again["notes"]["rows"] == 0 and again["cancels"]["rows"] == 0          # S9: already loaded
    # ledger (E2): last occurrence wins, direct and composite matches
    write(f"{land}/ledger", "l1.json", [
        {"IDLANCAMENTOICMSBASE": 1, "FKEMPRESA": "1", "ANCHAVE": k(1), "ANCFOP": "5102", "DTDATAEMISSAO": "2026-02-19T00:00:00"},
        {"IDLANCAMENTOICMSBASE": 2, "FKEMPRESA": "1", "ANNUMERODOCUMENTO": "3", "ANSERIE": "1", "ANCFOP": "5405",
         "DTDATAEMISSAO": "2026-02-19T00:00:00"},
        {"IDLANCAMENTOICMSBASE": 2, "FKEMPRESA": "1", "ANNUMERODOCUMENTO": "3", "ANSERIE": "1", "ANCFOP": "5102",
         "DTDATAEMISSAO": "2026-02-19T00:00:00"}])
    assert jobs.load_ledger(spark, f"{land}/ledger", bronze, gold, COMPANY)["rows"] == 3
    # maintenance
    inc = [{"id": "1", "type": "event", "attributes": {"operator_id": 9}},
           {"id": "10", "type": "event_registry", "attributes": {"event_id": 1, "action": "STARTED", "date": "2026-02-19 08:00:00"}},
           {"id": "11", "type": "event_registry", "attributes": {"event_id": 1, "action": "COMPLETED", "date": "2026-02-19 10:30:00"}}]
    write(f"{land}/mnt/failures/list", "p1.json", {"data": [{"id": "F1", "attributes": {"state": "PAUSED"}},
                                                            {"id": "F2", "attributes": {"state": "PAUSED"}}],
                                                   "meta": {"pagination": {"total_pages": 1}}})
    write(f"{land}/mnt/failures/detail", "F1.json", {"data": {"id": "F1", "attributes": {"status": "PAUSED"}}, "included": inc})
    write(f"{land}/mnt/failures/detail", "F2.json", {"data": {"id": "F2", "attributes": {"status": "PAUSED"}}})
    assert jobs.load_maintenance(spark, f"{land}/mnt", bronze, "failures", "failure_id")["rows"] == 2
    snapshot = spark.createDataFrame([("F1",)], "failure_id string")               # the source no longer has F2
    jobs.reconcile_paused(spark, bronze, snapshot)

    v = jobs.views(spark, bronze, gold, COMPANY)
    ledger = {r.lancamento_id: r for r in spark.table("v_fiscal_lancamentos").collect()}
    assert ledger["1"].chave_nfe == k(1) and ledger["2"].chave_nfe == k(3) and ledger["2"].cfop == "5102"
    sales = {r.nota_id: r for r in v["v_vendas_notas"].collect()}
    assert sales[k(1)].status == "Autorizada" and sales[k(1)].tem_pdv and sales[k(1)].tem_fiscal
    assert sales[k(2)].status == "Cancelada" and sales[k(3)].status == "Pendente SEFAZ" and not sales[k(3)].tem_pdv
    assert spark.sql("SELECT sum(total_notas) FROM v_vendas_diario").first()[0] == 3
    hours = v["v_trabalho_analitico_operador_chamados"].collect()
    assert [(r.failure_id, r.operator_id, r.horas_decimais) for r in hours] == [("F1", 9, 2.5)]
    states = {r.failure_id: r.state for r in audits.ids_by_state(
        jobs.bronze_table(spark, bronze, "raw_failures", "failure_id"), "EXCLUIDO").select("failure_id", "state").collect()}
    assert states == {"F2": "EXCLUIDO"}
    det = jobs.bronze_table(spark, bronze, "raw_failures_details", "failure_id").filter(F.col("failure_id") == "F2").first()
    assert as_json(det.data)["data"]["attributes"]["status"] == "EXCLUIDO"
    assert audits.ledger_period(spark.table("v_fiscal_lancamentos"), "2026-02-19", "2026-02-19").count() == 2

    # the guides' view-level SQL runs as written (schema prefix dropped)
    pend = spark.sql("""SELECT hotel, COUNT(*) AS pendentes, SUM(valor_total) AS valor_total
                        FROM v_vendas_notas WHERE status = 'Pendente SEFAZ' GROUP BY hotel ORDER BY pendentes DESC""").collect()
    assert [(r.hotel, r.pendentes) for r in pend] == [("SA", 1)]
    miss = spark.sql("""SELECT nota_id, hotel, data_emissao, valor_total, status, tem_pdv, tem_fiscal
                        FROM v_vendas_notas WHERE status = 'Autorizada' AND (NOT tem_pdv OR NOT tem_fiscal)
                        ORDER BY data_emissao DESC""").count()
    assert miss == 0
    monthly = spark.sql("""SELECT hotel, DATE_TRUNC('month', data) AS mes, SUM(valor_total_dia) AS receita
                           FROM v_vendas_diario GROUP BY hotel, DATE_TRUNC('month', data) ORDER BY hotel, mes DESC""").collect()
    assert len(monthly) == 1
    hours = spark.sql("""SELECT operator_id, SUM(horas_decimais) AS total_horas
                         FROM v_trabalho_analitico_operador_chamados GROUP BY operator_id ORDER BY total_horas DESC""").first()
    assert (hours.operator_id, hours.total_horas) == (9, 2.5)

    marts = jobs.refresh_marts(spark, bronze, gold, COMPANY)
    assert marts["v_vendas_notas"].count() == 3
    assert sorted(r.data.isoformat() for r in marts["v_vendas_diario"].select("data").distinct().collect()) == \
        sorted(r.data.isoformat() for r in spark.table("v_vendas_diario").select("data").distinct().collect())
    assert any(n.startswith("dia=") for n in os.listdir(f"{gold}/vendas_notas/v=0"))

    silver = f"{tmp}/silver"
    sv = jobs.refresh_silver(spark, bronze, silver, COMPANY)
    assert sv["notes"].count() == 3 and sv["ledger"].count() == 2 and sv["pos"].count() == 2
    assert any(n.startswith("dia=") for n in os.listdir(f"{silver}/notes/v=0"))
    vs = jobs.views(spark, bronze, gold, COMPANY, silver=silver)
    key = lambda df: sorted(map(tuple, df.select("nota_id", "status", "tem_pdv", "tem_fiscal").collect()))
    assert key(vs["v_vendas_notas"]) == key(v["v_vendas_notas"])          # same marts from silver as from bronze


def test_later_arrivals_win_and_bad_files_are_reported(spark, tmp):
    land, bronze, rej = f"{tmp}/land", f"{tmp}/bronze", f"{tmp}/rejects"
    page = lambda state, n, total: {"data": [{"id": "F1", "attributes": {"state": state}}] if state else [],
                                    "meta": {"pagination": {"current_page": n, "total_pages": total}}}
    write(f"{land}/m/failures/list", "p1_2026-03-01.json", page("PAUSED", 1, 2))
    write(f"{land}/m/failures/list", "p2_2026-03-01.json", page(None, 2, 2))           # an empty page counts as seen
    write(f"{land}/m/failures/list", "p1_2026-03-02.json", page("COMPLETED", 1, 1))
    write(f"{land}/m/failures/list", "bad_2026-03-02.json", '{"data": [')
    write(f"{land}/m/failures/detail", "d1.json", {"data": {"id": "F1", "attributes": {}}})
    write(f"{land}/m/failures/detail", "d2.json", {"errors": []})
    for _ in range(2):                                                                  # again: the same rows
        got = jobs.load_maintenance(spark, f"{land}/m", bronze, "failures", "failure_id", rej, "2026-03-02")
        assert got == {"rows": 2, "errors": 1, "detail_errors": 1}
    assert sorted(r.error for r in spark.read.parquet(rej).collect()) == ["envelope without data", "not JSON"]
    (row,) = jobs.bronze_table(spark, bronze, "raw_failures", "failure_id").collect()
    assert as_json(row.data)["attributes"]["state"] == "COMPLETED"
    for name, text in (("a_2026-03-01.json", [[{"Store Number": "S"}], [{}], [{"Invoice Data Info 8": k(1), "Sub Total 1": 90.0}]]),
                       ("a_2026-03-02.json", [[{"Store Number": "S"}], [{}], [{"Invoice Data Info 8": k(1), "Sub Total 1": 10.0}]]),
                       ("b_2026-03-02.json", '[[{"Store'), ("c_2026-03-02.json", [[{}]]), ("d_2026-03-02.json", {"x": 1})):
        write(f"{land}/pos", name, text)
    got = jobs.load_pos(spark, f"{land}/pos", bronze, {}, rejects_to=rej, job_date="2026-03-02")
    assert got == {"rows": 2, "errors": 2}
    (row,) = jobs.bronze_table(spark, bronze, "pdv_raw_notas", "nota_id").collect()
    assert as_json(row.data)["Sub Total 1"] == 10.0
    write(f"{land}/items", "x_GCM.json", "{")
    assert jobs.load_line_items(spark, f"{land}/items", bronze, {}) == {"rows": 0, "errors": 1}


def test_incomplete_lists_stop_the_load_and_the_reconciliation(spark, tmp):
    import pytest
    from tidewater.sources import landed, parse_paged_envelopes
    write(f"{tmp}/m/failures/list", "p1.json", {"data": [{"id": "F1", "attributes": {"state": "PAUSED"}}],
                                                "meta": {"pagination": {"current_page": 1, "total_pages": 3}}})
    with pytest.raises(jobs.IncompleteList):
        jobs.load_maintenance(spark, f"{tmp}/m", f"{tmp}/b", "failures", "failure_id")
    assert not os.path.exists(f"{tmp}/b")
    pages = parse_paged_envelopes(landed(spark, f"{tmp}/m/failures/list"), errors=True)
    with pytest.raises(jobs.IncompleteList):
        jobs.reconcile_paused(spark, f"{tmp}/b", pages)


def test_listed_files_that_were_not_read(spark, tmp):
    from tidewater.sources import listed_files, unread_files
    write(tmp, "a.json", "[]")
    write(tmp, "b.json", "[]")
    read = spark.createDataFrame([("a.json",)], "file_name string")
    assert [(r.file_name, r.error) for r in unread_files(listed_files(spark, tmp), read).collect()] == [("b.json", "file cannot be read")]


def test_skipped_note_and_detail_files_are_reported(spark, tmp, monkeypatch):
    for folder in ("SHARE_A", "SHARE_B"):
        write(f"{tmp}/shares/{folder}", "same-name.xml", "<broken")
        write(f"{tmp}/shares/{folder}", "same-name-can.xml", "<broken")
    read = jobs.new_files
    monkeypatch.setattr(jobs, "new_files", lambda *a, **k: read(*a, **k).where("file_path not like '%SHARE_B%'"))
    got = jobs.load_notes(spark, f"{tmp}/shares", f"{tmp}/b", {}, f"{tmp}/rej", "2026-02-20")
    assert (got["notes"]["errors"], got["cancels"]["errors"]) == (2, 2)
    bad = spark.read.parquet(f"{tmp}/rej").where("error = 'file cannot be read'")
    assert sorted(r.file_name for r in bad.collect()) == ["same-name-can.xml", "same-name.xml"]
    write(f"{tmp}/m/works/list", "p1.json", {"data": [{"id": "W1"}], "meta": {"pagination": {"current_page": 1, "total_pages": 1}}})
    write(f"{tmp}/m/works/detail", "W1.json.gz", "not compressed")
    got = jobs.load_maintenance(spark, f"{tmp}/m", f"{tmp}/b", "works", "work_id", f"{tmp}/rej2", "2026-02-20")
    assert got["detail_errors"] == 1
