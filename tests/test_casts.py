"""One policy for all casts: NULL, counted, listed; never an error."""

import json

import pytest
from pyspark.sql import functions as F

from tidewater.functions import cast_counts, cast_rejects, casting, instant, iso_date, project, text_to_utc
from tidewater.plans import audit_queries, fiscal, jobs
from tests.test_jobs import COMPANY, k, write

SPEC = [("name", "a.name", "text"), ("n", "a.n", "integer"), ("v", "v", "numeric(12,2)"), ("day", "at", "iso_date"),
        ("at", "at", "text", "instant"), ("flag", "flag", "boolean")]
DOCS = [("ok", {"a": {"name": "x", "n": "7"}, "v": 1.5, "at": "2026-02-19T12:00:00-03:00", "flag": True}),
        ("bad", {"a": {"name": "", "n": "7.x"}, "v": "1,50", "at": "2026-02-30", "flag": "sim"}),
        ("none", {"a": {"name": None}, "v": None}),
        ("blank", {"a": {"n": ""}, "v": "99999999999"})]


def frame(spark, form):
    df = spark.createDataFrame([(i, json.dumps(x)) for i, x in DOCS], "id string, data string")
    return df.withColumn("data", F.parse_json("data")) if form == "variant" else df


@pytest.mark.parametrize("form", ["text", "variant"])
def test_malformed_values_are_null_and_listed(spark, form):
    df = frame(spark, form)
    rows = project(df, "data", SPEC, keep=["id"], malformed="bad")
    got = {r.id: r for r in rows.collect()}
    assert {i: {x.column: x.text for x in r.bad or []} for i, r in got.items()} == {
        "ok": {}, "bad": {"n": "7.x", "v": "1,50", "day": "2026-02-30", "at": "2026-02-30", "flag": "sim"},
        "none": {}, "blank": {"n": "", "v": "99999999999"}}
    assert got["ok"].bad is None and got["bad"].at == "2026-02-30" and got["bad"].day is None
    plain = project(df, "data", SPEC, keep=["id"])
    assert sorted(map(str, plain.collect())) == sorted(map(str, rows.drop("bad").collect()))
    counts = {r["column"]: (r.rows, r.malformed) for r in cast_counts(rows, SPEC, "bad").collect()}
    assert counts == {"n": (4, 2), "v": (4, 2), "day": (4, 1), "at": (4, 1), "flag": (4, 1)} and list(casting(SPEC)) == list(counts)
    errors = cast_rejects(rows, "id", SPEC, "bad").where("file_name = 'blank'").collect()
    assert sorted(r.error for r in errors) == ["n: '' is no integer", "v: '99999999999' is no numeric(12,2)"]
    assert project(df, "data", [("name", "a.name", "text")], malformed="bad").where("bad is not null").count() == 0


def test_moments_that_are_none_stop_no_query(spark):
    df = spark.createDataFrame([("x",), ("2026-13-01T00:00:00",), (None,), ("2026-02-19T10:00:00Z",)], "a string")
    got = df.select(iso_date(F.col("a")).alias("d"), instant("a").alias("i"), text_to_utc("a").alias("u")).collect()
    assert [tuple(x is not None for x in r) for r in got] == [(False,) * 3] * 3 + [(True,) * 3]


def parses(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.count("from_json(")


def test_a_document_is_parsed_once(spark):
    d = "/root/testdata/sf0.001"
    for fn in (audit_queries.v12, audit_queries.q23, audit_queries.q24, audit_queries.q26, audit_queries.q27, audit_queries.q30,
               audit_queries.pos):
        assert parses(fn(spark, d)) == 1, fn.__name__


def test_silver_refresh_reports_malformed_values(spark, tmp):
    land, bronze, silver, rej = (f"{tmp}/{x}" for x in ("land", "bronze", "silver", "rej"))
    write(f"{land}/pos", "a_2026-02-19.json", [[{"Store Number": "S"}], [{}], [
        {"Invoice Data Info 8": k(1), "Business Date": "2026-02-19", "Sub Total 1": "1.0"},
        {"Invoice Data Info 8": k(2), "Business Date": "19/02/2026", "Sub Total 1": "um"}]])
    jobs.load_pos(spark, f"{land}/pos", bronze, {})
    write(f"{land}/ledger", "l.json", [{"IDLANCAMENTOICMSBASE": 1, "FKEMPRESA": "1", "DTDATAEMISSAO": "ontem", "VLVALORTOTAL": "x"}])
    jobs.load_ledger(spark, f"{land}/ledger", bronze, f"{tmp}/gold", COMPANY)
    for _ in range(2):
        got = jobs.refresh_silver(spark, bronze, silver, COMPANY, rej, "2026-02-20")
        assert {(t, c): n for t, by in got.malformed.items() for c, n in by.items() if n} == {
            ("pos", "data_venda"): 1, ("pos", "subtotal_1"): 1, ("ledger", "data_emissao"): 1, ("ledger", "valor_total_item"): 1}
        bad = spark.read.parquet(rej)
        assert sorted((r.job, r.error) for r in bad.where("job like 'silver%'").collect()) == [
            ("silver_ledger", "data_emissao: 'ontem' is no iso_date"), ("silver_ledger", "valor_total_item: 'x' is no numeric(12,2)"),
            ("silver_pos", "data_venda: '19/02/2026' is no date"), ("silver_pos", "subtotal_1: 'um' is no numeric(12,2)")]
    assert set(got.malformed["notes"]) == {"dhEmi", "vNF", "dhRecbto"}
    assert "malformed" not in jobs.views(spark, bronze, f"{tmp}/gold", COMPANY, silver=silver)["v_pdv_notas"].columns
    assert len(fiscal.fact_pos(jobs.bronze_table(spark, bronze, "pdv_raw_notas", "nota_id")).columns) == 18
