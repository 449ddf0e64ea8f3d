"""After any batch the incrementally refreshed tables equal a full rebuild; other days keep their files."""

import datetime as dt
import json
import random

from pyspark.sql import functions as F

from tidewater.plans import fiscal, incremental, jobs
from tidewater.sinks import append_batch, delete_keys
from tidewater.sinks.days import current_days, generations, read_days, vacuum, write_days

SITES = {"1": "SA", "2": "SB"}
TABLES = {"nfe_raw_xmls": "nota_id", "nfe_raw_cancelamentos": "cancelamento_id", "fiscal_raw_lancamentos": "lancamento_id", "pdv_raw_notas": "nota_id"}


def day(n):
    return (dt.date(2026, 3, 1) + dt.timedelta(n)).isoformat()


def put(spark, bronze, table, docs):
    key = TABLES[table]
    df = spark.createDataFrame([(k, json.dumps(d)) for k, d in docs.items()], f"{key} string, data string").withColumn("data", F.parse_json("data"))
    append_batch(df, f"{bronze}/{table}", key)


def note(i, d, serie="1", hour=12, **more):
    return {"hotel": "SA" if i % 2 else "SB", "dhEmi": f"{day(d)}T{hour:02d}:00:00-03:00", "nNF": str(i), "serie": serie, "mod": "65",
            "vNF": f"{i}.50", "cStat": "100" if i % 5 else "105", "nProt": f"p{i}", "dhRecbto": f"{day(d)}T{hour:02d}:00:00-03:00", **more}


def item(i, d, key=None, number=None, cfop="5102"):
    return {"FKEMPRESA": "1" if (number or i) % 2 else "2", "EMPRESA": "E", "DTDATAEMISSAO": f"{day(d)}T00:00:00", "ANNUMERODOCUMENTO": str(number),
            "ANSERIE": "1", "ANCFOP": cfop, "VLVALORTOTAL": "1.00", "ANCHAVE": key}


def tables(spark, gold):
    out = {}
    for name in (incremental.LEDGER_FACT, incremental.SALES, incremental.DAILY):
        rows = read_days(spark, f"{gold}/{name}")
        cols = sorted(c for c in rows.columns if c != "extracted_at")
        out[name] = sorted((str(tuple(r)) for r in rows.select(*cols).collect()))
    return out


def files(spark, gold):
    return {name: {d: sorted(f for f in read_days(spark, f"{gold}/{name}").inputFiles() if f"/g={g}/" in f and f.split("/")[-2].endswith("=" + d))
                   for d, g in current_days(spark, f"{gold}/{name}").items()}
            for name in (incremental.LEDGER_FACT, incremental.SALES, incremental.DAILY)}


def rebuilt(spark, bronze):
    """The same tables from all bronze documents, in one go and without any table between."""
    t = lambda name: jobs.bronze_table(spark, bronze, name, TABLES[name])
    notes, cancels = fiscal.silver_notes(t("nfe_raw_xmls")), fiscal.silver_cancels(t("nfe_raw_cancelamentos"))
    pos = fiscal.fact_pos(t("pdv_raw_notas"))
    fact = fiscal.fact_ledger(fiscal.silver_ledger(t("fiscal_raw_lancamentos"), SITES), notes, cancels).cache()
    sales = fiscal.sales_notes(fiscal.fact_notes(notes, cancels, pos), pos, fact).cache()
    out = {}
    for name, df in ((incremental.LEDGER_FACT, fact), (incremental.SALES, sales.withColumn("dia", F.to_date("data_emissao"))),
                     (incremental.DAILY, fiscal.sales_daily(sales))):
        out[name] = sorted(str(tuple(r)) for r in df.select(*sorted(c for c in df.columns if c != "extracted_at")).collect())
    fact.unpersist()
    sales.unpersist()
    return out


def test_batches_refresh_the_days_they_touch(spark, tmp):
    bronze, silver, gold = f"{tmp}/b", f"{tmp}/s", f"{tmp}/g"
    run = lambda: incremental.refresh_changed(spark, bronze, silver, gold, SITES)
    rnd = random.Random(1)
    put(spark, bronze, "nfe_raw_xmls", {f"n{i}": note(i, i % 6, hour=rnd.choice([2, 12, 23])) for i in range(40)})
    put(spark, bronze, "pdv_raw_notas", {f"n{i}": {"hotel": "SA", "Business Date": day(i % 6), "Sub Total 1": i + 0.5} for i in range(0, 40, 3)})
    put(spark, bronze, "fiscal_raw_lancamentos", {f"l{i}": item(i, i % 6, key=f"n{i}" if i % 3 else "", number=i) for i in range(60)})
    put(spark, bronze, "nfe_raw_cancelamentos", {"c1": {"chNFe": "n4", "dhEvento": f"{day(8)}T10:00:00-03:00"}})
    assert run()["days"] == {k: None for k in ("mv_fiscal_lancamentos", "vendas_notas", "vendas_diario")}
    assert tables(spark, gold) == rebuilt(spark, bronze)
    assert run()["days"] == {k: [] for k in ("mv_fiscal_lancamentos", "vendas_notas", "vendas_diario")}     # nothing came

    steps = [
        lambda: put(spark, bronze, "nfe_raw_cancelamentos", {"c2": {"chNFe": "n6", "dhEvento": f"{day(9)}T10:00:00-03:00"}}),
        # POS records; a ledger row moves to another day, a new one comes, one loses its key
        lambda: (put(spark, bronze, "pdv_raw_notas", {"n7": {"hotel": "SA", "Business Date": day(1), "Sub Total 1": 7.0}, "n0": {"hotel": "SA"}}),
                 put(spark, bronze, "fiscal_raw_lancamentos", {"l2": item(2, 5, key="n2", number=2), "l99": item(99, 3, key="n9", number=1, cfop="9"),
                                                               "l1": item(1, 1, key=None, number=400)})),
        # a note changes its number (the rows that matched by it lose it), another moves to another day, one has no moment
        lambda: put(spark, bronze, "nfe_raw_xmls", {"n12": note(12, 0, serie="9"), "n13": note(13, 4), "n14": note(14, 2, dhEmi="?"),
                                                    "n50": note(3, 3), "n3": note(77, 3)}),
        lambda: (delete_keys(spark.createDataFrame([("n5",)], "nota_id string"), f"{bronze}/nfe_raw_xmls", "nota_id"),
                 delete_keys(spark.createDataFrame([("l8",)], "lancamento_id string"), f"{bronze}/fiscal_raw_lancamentos", "lancamento_id")),
    ]
    partial = 0
    for n, step in enumerate(steps):
        before = files(spark, gold)
        step()
        days = run()["days"]
        assert tables(spark, gold) == rebuilt(spark, bronze), n
        for name, kept in files(spark, gold).items():
            named = {str(d) if d is not None else "__HIVE_DEFAULT_PARTITION__" for d in days[name]}
            untouched = set(kept) - named
            assert all(kept[d] == before[name].get(d) for d in untouched), (n, name)
            partial += bool(untouched) and bool(named)
    assert partial >= 6
    assert incremental.processed(spark, gold)["notes"] >= 2


def test_malformed_values_of_a_batch_are_reported(spark, tmp):
    put(spark, f"{tmp}/b", "nfe_raw_xmls", {"n1": note(1, 0), "n2": note(2, 0, vNF="dois")})
    got = incremental.refresh_changed(spark, f"{tmp}/b", f"{tmp}/s", f"{tmp}/g", SITES)
    assert got["malformed"]["notes"] == {"dhEmi": 0, "vNF": 1, "dhRecbto": 0}
    assert fiscal.NOTE_SPEC and read_days(spark, f"{tmp}/s/notes").where("malformed is not null").count() == 1


def test_day_tables_swap_and_empty_days(spark, tmp):
    base = f"{tmp}/t"
    rows = lambda *x: spark.createDataFrame([(v, None if d is None else dt.date.fromisoformat(d)) for v, d in x], "v int, d date")
    read = lambda: sorted(((r.v, r.d and r.d.isoformat()) for r in read_days(spark, base).collect()), key=str)
    assert read_days(spark, base) is None
    write_days(rows((1, day(0)), (2, day(1)), (3, None)), base, "d")
    assert read() == sorted([(1, day(0)), (2, day(1)), (3, None)], key=str)
    write_days(rows((5, day(1))), base, "d", [dt.date.fromisoformat(day(1)), None])           # the rows without a day go
    assert read() == [(1, day(0)), (5, day(1))]
    write_days(rows(), base, "d", [dt.date.fromisoformat(day(0))])
    assert read() == [(5, day(1))]
    import os
    os.makedirs(f"{base}/g=3/d={day(1)}")                                                      # a generation that failed
    assert read() == [(5, day(1))] and write_days(rows((6, day(2))), base, "d", [dt.date.fromisoformat(day(2))]) == 4
    assert read() == [(5, day(1)), (6, day(2))] and generations(spark, base) == [0, 1, 2, 4]
    assert vacuum(spark, base) == 3 and read() == [(5, day(1)), (6, day(2))]
    write_days(rows(), base, "d")
    assert read() == [] and read_days(spark, base).columns == ["v", "d"]
