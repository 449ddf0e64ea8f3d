"""Parsers on synthetic documents (shapes of FIXTURES.md, invented values)."""

import json


def as_json(v):
    """VARIANT (bronze) or JSON text -> Python value."""
    return json.loads(v.toJson() if hasattr(v, "toJson") else v)

from pyspark.sql import functions as F

from tidewater.sources import (
    ids_from_text, page_completeness, parse_cancel_xml, parse_dead_letters, parse_detail_envelopes,
    parse_json_array, parse_nested_array_json, parse_note_xml, parse_paged_envelopes, parse_sectioned_json,
    select_files, with_folder_code,
)
from tidewater.sources.files import key_from_name, landed, only_new

KEY = "1" * 44
KEY2 = "2" * 44


def files(spark, *docs):
    return spark.createDataFrame([(v, f"/land/SITEA/{n}", n) for n, v in docs], "value string, file_path string, file_name string")


def test_sectioned_pos_file(spark):
    content = json.dumps([
        [{"Record Type": "FIS", "Store Number": "ST1", "Store Name": "x"}], [{}],
        [{"Record Type": "FISID", "Invoice Data Info 8": f" {KEY} ", "Sub Total 1": 10.5, "Check Number": 7},
         {"Record Type": "FISID", "Invoice Data Info 8": "   "},
         {"Record Type": "FISID"},
         "not an object",
         {"Record Type": "FISID", "Invoice Data Info 8": KEY2, "hotel": "OWN"}],
        [{}]])
    short = json.dumps([[{"Store Number": "ZZ"}], [{}]])
    f = files(spark, ("a_2026-01-02.json", content), ("b.json", short))
    rows = parse_sectioned_json(f, {"ST1": "SITE1"}).collect()
    again = parse_sectioned_json(f, {"ST1": "SITE1"}).collect()
    assert sorted((r.key, r.data.toJson()) for r in rows) == sorted((r.key, r.data.toJson()) for r in again)  # repeatable
    by = {r.key: r for r in rows}
    assert set(by) == {KEY, KEY2}
    a = as_json(by[KEY].data)
    assert a["id"] == KEY and a["hotel"] == "SITE1" and a["source_file"] == "a_2026-01-02.json"
    assert a["Sub Total 1"] == 10.5 and a["Check Number"] == 7
    assert as_json(by[KEY2].data)["hotel"] == "OWN"  # the record's own field wins (A3)


def test_sectioned_unknown_store_keeps_code(spark):
    content = json.dumps([[{"Store Number": "QQ"}], [{}], [{"Invoice Data Info 8": KEY}], [{}]])
    (r,) = parse_sectioned_json(files(spark, ("f.json", content)), {"ST1": "SITE1"}).collect()
    assert r.hotel == "QQ"


def test_nested_array_line_items(spark):
    content = json.dumps([[{"guestCheckLineItemID": 11, "locationRef": "L1", "lineTotal": 3},
                           {"guestCheckLineItemID": 0, "locationRef": "L1"},
                           {"guestCheckLineItemID": None},
                           {"locationRef": "L2"},
                           {"guestCheckLineItemID": 12, "locationRef": "L9"}]])
    rows = {r.key: r for r in parse_nested_array_json(files(spark, ("GCM_1.json", content)), {"L1": "SITE1"}).collect()}
    assert set(rows) == {11, 12}
    assert rows[11].hotel == "SITE1" and rows[12].hotel == "L9"
    assert as_json(rows[11].data)["id"] == 11


NOTE = ('<?xml version="1.0" encoding="UTF-8"?><nfeProc xmlns="urn:x" versao="4.00"><NFe><infNFe Id="NFe{k}">'
        '<ide><mod>65</mod><serie>1</serie><nNF>17</nNF><dhEmi>2026-01-02T10:00:00-03:00</dhEmi><tpAmb>1</tpAmb></ide>'
        '<emit><CNPJ>00000000000100</CNPJ><xNome>Emit</xNome></emit><det nItem="1"><prod><cProd>1</cProd></prod></det>'
        '<total><ICMSTot><vNF>12.30</vNF></ICMSTot></total></infNFe></NFe>'
        '<protNFe><infProt><nProt>99</nProt><cStat>100</cStat><dhRecbto>2026-01-02T10:00:05-03:00</dhRecbto></infProt></protNFe></nfeProc>')
BARE = '<NFe><infNFe versao="4"><ide><nNF>5</nNF><serie>2</serie></ide></infNFe></NFe>'


def test_note_xml_variants(spark):
    df = files(spark,
               ("NFe{}-nfe.xml".format(KEY), NOTE.format(k=KEY)),
               ("NFe{}-nfe.xml".format(KEY2), BARE),             # no Id, no protNFe: key from file name
               ("short.xml", NOTE.format(k="123")),               # key not 44 long
               ("noinf.xml", "<nfeProc><other/></nfeProc>"),       # no infNFe
               ("bad.xml", "this is not xml"))
    ok, rej = parse_note_xml(df, F.lit("SITE1"))
    ok = {r.nota_id: r for r in ok.collect()}
    assert set(ok) == {KEY, KEY2}
    a = ok[KEY]
    assert (a.nNF, a.serie, a.mod, a.vNF, a.cStat, a.nProt, a.hotel) == ("17", "1", "65", "12.30", "100", "99", "SITE1")
    assert ok[KEY2].nNF == "5" and ok[KEY2].cStat is None
    assert as_json(a.data)["xml_content"].startswith("<?xml")
    errs = {r.file_name: r.error for r in rej.collect()}
    assert errs == {"short.xml": "invalid key", "noinf.xml": "infNFe not found", "bad.xml": "invalid XML"}


CANCEL = ('﻿<?xml version="1.0"?><envEvento xmlns="urn:x"><evento><infEvento Id="ID110111{k}01"><CNPJ>1</CNPJ>'
          '<chNFe>{k}</chNFe><dhEvento>2026-01-03T09:00:00-03:00</dhEvento><tpEvento>110111</tpEvento>'
          '<nSeqEvento>1</nSeqEvento><detEvento><nProt>77</nProt><xJust>erro de digitacao</xJust></detEvento>'
          '</infEvento></evento></envEvento>')


def test_cancel_xml(spark):
    df = files(spark, ("a-can.xml", CANCEL.format(k=KEY)), ("b-can.xml", "<envEvento><x/></envEvento>"),
               ("c-can.xml", "<envEvento><evento><y/></evento></envEvento>"))
    ok, rej = parse_cancel_xml(df)
    (r,) = ok.collect()
    assert r.chNFe == KEY and r.cancelamento_id == f"ID110111{KEY}01" and r.nProt == "77" and r.tpEvento == "110111"
    errs = {x.file_name: x.error for x in rej.collect()}
    assert errs["b-can.xml"] == "evento not found"
    assert errs["c-can.xml"] == "infEvento not found"


def test_ledger_array_and_envelopes(spark):
    ledger = json.dumps([{"IDLANCAMENTOICMSBASE": 5, "ANCHAVE": ""}, {"IDLANCAMENTOICMSBASE": "6"}])
    rows = parse_json_array(files(spark, ("l.json", ledger))).collect()
    assert sorted(r.key for r in rows) == ["5", "6"]
    assert as_json([r for r in rows if r.key == "5"][0].data)["id"] == "5"

    page = lambda n, ids: json.dumps({"data": [{"id": i, "type": "failure", "attributes": {}} for i in ids],
                                      "included": [{"id": "x"}], "meta": {"pagination": {"total_pages": 3, "current_page": n}}})
    recs = parse_paged_envelopes(files(spark, ("p1.json", page(1, ["1", "2"])), ("p2.json", page(2, ["3"]))))
    assert sorted(r.key for r in recs.collect()) == ["1", "2", "3"]
    c = page_completeness(recs).first()
    assert (c.pages_seen, c.total_pages) == (2, 3)

    det = json.dumps({"data": {"id": "9", "type": "failure", "attributes": {}}, "included": [{"id": "e", "type": "event"}]})
    ok, rej = parse_detail_envelopes(files(spark, ("d.json", det), ("e.json", json.dumps({"errors": ["404"]}))))
    (r,) = ok.collect()
    assert r.key == "9" and as_json(r.data)["id"] == "9" and as_json(r.data)["included"][0]["type"] == "event"
    assert [x.file_name for x in rej.collect()] == ["e.json"]


def test_id_list_dead_letters_and_files(spark, tmp):
    ids = spark.createDataFrame([('"failure_id"',), ("12a3",), ("123",), ("",), (" 77 ",)], "value string")
    assert sorted(r.id for r in ids_from_text(ids).collect()) == ["123", "77"]

    log = ("2026-03-19 16:05:42 | scheduled_work | ID: 101 | Erro: connection refused\n\tIs the server running?\n\n"
           "2026-03-19 16:06:00 | failure | ID: 102 | Erro: 404 Not Found\n")
    dl = parse_dead_letters(files(spark, ("ids.log", log))).collect()
    assert [(r.resource_type, r.id) for r in dl] == [("scheduled_work", "101"), ("failure", "102")]
    assert "Is the server running?" in dl[0].error

    f = files(spark, (f"NFe{KEY}-nfe.xml", ""), (f"ID{KEY}-can.xml", ""), ("CFe1.xml", ""), ("x_GCM.json", ""))
    notes = select_files(f, include=r"\.xml$", exclude=r"(-can\.xml$)|(^CFe)")
    assert [r.file_name for r in notes.collect()] == [f"NFe{KEY}-nfe.xml"]
    loaded = spark.createDataFrame([(KEY,)], "nota_id string")
    assert only_new(notes, loaded, key_from_name(), "nota_id").count() == 0
    assert with_folder_code(f, {"SITEA": "S-A"}).first().hotel == "S-A"

    import os
    os.makedirs(f"{tmp}/share/SITEB")
    with open(f"{tmp}/share/SITEB/a.json", "wb") as fh:
        fh.write(b'{"x": "caf\xe9"}')  # invalid UTF-8 byte -> U+FFFD (S11)
    (r,) = landed(spark, f"{tmp}/share").collect()
    assert "�" in r.value and r.file_name == "a.json"


def test_days_without_files(spark):
    import datetime as dt
    from tidewater.operators import missing_days
    from tidewater.sources import file_day
    f = files(spark, ("A_2026-02-01.json", ""), ("A_2026-02-03.json", ""), ("B_2026-02-03.json", ""), ("notes.txt", ""))
    span = spark.createDataFrame([(dt.date(2026, 2, 1), dt.date(2026, 2, 4))], "start date, end date")
    days = missing_days(f.withColumn("day", file_day()).filter("day IS NOT NULL"), "day", span)
    assert sorted(r.dia.isoformat() for r in days.collect()) == ["2026-02-02", "2026-02-04"]


def test_repeated_key_keeps_last_value(spark):
    from tidewater.sources.documents import parse_json_array
    (r,) = parse_json_array(files(spark, ("l.json", '[{"IDLANCAMENTOICMSBASE": 1, "ANCFOP": "1", "ANCFOP": "2"}]'))).collect()
    assert as_json(r.data)["ANCFOP"] == "2"


def test_page_without_meta_is_page_one_of_one(spark):
    recs = parse_paged_envelopes(files(spark, ("p.json", json.dumps({"data": [{"id": "7"}]})),
                                       ("bad.json", "not json")))
    (r,) = recs.collect()
    assert (r.key, r.page, r.total_pages) == ("7", 1, 1)
    c = page_completeness(recs).first()
    assert (c.pages_seen, c.total_pages) == (1, 1)


def test_new_files_opens_only_unloaded_files(spark, tmp):
    import os
    from tidewater.sources import new_files
    share = f"{tmp}/share/SITE"
    os.makedirs(share)
    for name, text in ((f"NFe{KEY}-nfe.xml", "old"), (f"NFe{KEY2}-nfe.xml", "new"), ("x-can.xml", "c")):
        with open(os.path.join(share, name), "w") as fh:
            fh.write(text)
    loaded = spark.createDataFrame([(KEY,)], "nota_id string")
    got = new_files(spark, f"{tmp}/share", loaded, "nota_id", key_from_name(),
                    include=r"\.xml$", exclude=r"-can\.xml$")
    rows = got.collect()
    assert [(r.file_name, r.value) for r in rows] == [(f"NFe{KEY2}-nfe.xml", "new")]
    plan = got._jdf.queryExecution().executedPlan()
    files_read = []

    def walk(p):
        m = p.metrics()
        if m.contains("numFiles"):
            files_read.append(m.apply("numFiles").value())
        it = p.children().iterator()
        while it.hasNext():
            walk(it.next())
    walk(plan)
    assert files_read == [1]                                   # the loaded file was never opened


def test_files_of_several_lines_are_one_row(spark, tmp):
    with open(f"{tmp}/a.json", "w") as f:
        f.write('[\n {"IDLANCAMENTOICMSBASE": 1},\n {"IDLANCAMENTOICMSBASE": 2}\n]\n')
    from tidewater.sources import landed, parse_json_array
    assert landed(spark, tmp).count() == 1
    assert sorted(r.key for r in parse_json_array(landed(spark, tmp)).collect()) == ["1", "2"]
