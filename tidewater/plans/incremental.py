"""Incremental refresh of silver and gold.

``refresh_changed`` takes what the bronze batches since its last run touch and
recomputes only the days that this can change:

- a silver table's days that hold, or held, a changed record;
- the ledger fact's days with a changed ledger row, or with one that matches a
  touched note now or before: by its key, or by its (number, series, site). A
  note is touched if it or one of its cancellations changed;
- the sales marts' days with a touched note, a note whose POS record changed, or
  one whose ledger rows were matched anew.

The tables are those of ``sinks.days``: recomputed days are swapped in together,
the others keep their files. What was processed is written last, so that a run
that failed is done again from the start; doing it twice gives the same tables.

Finding the days reads key columns of the silver tables, whole; days are
recomputed from whole rows of those days alone. The batches' own rows come from
their segments (``changed_rows``), not from a scan of the bronze tables.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.json_paths import cast_metrics, casting
from tidewater.functions.scalar import instant
from tidewater.operators.joins import without
from tidewater.plans import fiscal
from tidewater.plans.jobs import SILVER_KEYS, SILVER_SOURCES, SILVER_SPECS, silver_rows
from tidewater.session import scratch_dir
from tidewater.sinks.batches import DELETED, changed_rows, last_seq
from tidewater.sinks.days import _names, _read_text, _write_text, days_of, in_days, read_days, vacuum, write_days
from tidewater.sinks.tables import observed

DAYS = {"notes": "dia", "cancels": "dia", "ledger": "data_emissao", "pos": "data_venda"}
LEDGER_FACT, SALES, DAILY = "mv_fiscal_lancamentos", "vendas_notas", "vendas_diario"


def processed(spark: SparkSession, gold: str) -> dict[str, int]:
    """The last batch of each bronze table that gold has."""
    return json.loads(_read_text(spark, f"{gold}/_processed")) if "_processed" in _names(spark, gold) else {}


def _any(*frames: DataFrame | None) -> DataFrame | None:
    out = None
    for f in frames:
        if f is not None:
            out = f if out is None else out.unionByName(f)
    return out


class Changes:
    """What a run finds in one silver table: the changed keys, and the rows of those keys before and now."""

    def __init__(self, keys: DataFrame, before: DataFrame | None, now: DataFrame):
        self.keys, self.before, self.now = keys, before, now

    @property
    def rows(self) -> DataFrame:
        return _any(self.before, self.now)


def refresh_silver_table(spark: SparkSession, name: str, bronze: str, silver: str, company_sites: Mapping[str, str],
                         since: int) -> tuple[Changes | None, dict]:
    """Bring one silver table up to its bronze table: (changes, malformed values by column); (None, {}) if nothing came."""
    table, key = SILVER_SOURCES[name]
    rows = changed_rows(spark, f"{bronze}/{table}", key, since)
    if rows is None:
        return None, {}
    for c, kind in (("data", "variant"), ("extracted_at", "timestamp")):  # batches of deletions alone have keys only
        rows = rows if c in rows.columns else rows.withColumn(c, F.lit(None).cast(kind))
    rows = rows.checkpoint(eager=True)
    live = rows.where(~F.col(DELETED)).select(key, "data", "extracted_at")
    day, silver_key, spec = DAYS[name], SILVER_KEYS[name], SILVER_SPECS[name]
    now = silver_rows(name, live, company_sites)
    if name == "cancels":
        now = now.withColumn("dia", F.to_date(instant("dhEvento")))
    now, seen = observed(now, f"changed_{name}", **cast_metrics(spec))
    now = now.checkpoint(eager=True)
    keys = rows.select(F.col(key).alias(silver_key)).distinct()
    old = read_days(spark, f"{silver}/{name}")
    before = old.join(keys, silver_key, "left_semi").select(*now.columns).checkpoint(eager=True) if old is not None else None
    days = sorted(set(days_of(now, day)) | set(days_of(before, day) if before is not None else []), key=str)
    kept = without(old.where(in_days(day, days)), keys, silver_key).select(*now.columns) if old is not None else None
    write_days(_any(kept, now), f"{silver}/{name}", day, days if old is not None else None)
    vacuum(spark, f"{silver}/{name}")
    return Changes(keys, before, now), {c: seen.get[c] or 0 for c in casting(spec)}


def _table(spark: SparkSession, silver: str, name: str, empty: DataFrame) -> DataFrame:
    rows = read_days(spark, f"{silver}/{name}")
    return (rows if rows is not None else empty).drop("malformed")


def silver_tables(spark: SparkSession, silver: str, company_sites: Mapping[str, str]) -> dict[str, DataFrame]:
    """The typed tables (notes, cancels, ledger, pos) as they are, empty ones before their first refresh."""
    out = {}
    for name, (_, key) in SILVER_SOURCES.items():
        none = spark.createDataFrame([], f"{key} string, data variant, extracted_at timestamp")
        empty = silver_rows(name, none, company_sites)
        out[name] = _table(spark, silver, name, empty.withColumn("dia", F.to_date(instant("dhEvento"))) if name == "cancels" else empty)
    return out


def _semi(rows: DataFrame, keys: DataFrame, on: list[str], key_columns: list[str]) -> DataFrame:
    names = [f"_k{i}" for i in range(len(on))]
    right = keys.select(*[F.col(k).alias(n) for k, n in zip(key_columns, names)]).distinct()
    condition = F.lit(True)
    for c, n in zip(on, names):
        condition = condition & (rows[c] == right[n])
    return rows.join(right, condition, "left_semi")


def refresh_changed(spark: SparkSession, bronze: str, silver: str, gold: str, company_sites: Mapping[str, str]) -> dict:
    """Bring silver, the ledger fact and the sales marts up to bronze. Returns
    the recomputed days of each gold table (None: built whole) and the malformed
    values found (by table and column)."""
    scratch_dir(spark)
    since = processed(spark, gold)
    seqs = {name: last_seq(spark, f"{bronze}/{table}") for name, (table, _) in SILVER_SOURCES.items()}
    changes, malformed = {}, {}
    for name in SILVER_SOURCES:
        got, bad = refresh_silver_table(spark, name, bronze, silver, company_sites, since.get(name, -1))
        if got is not None:
            changes[name], malformed[name] = got, bad
    if not changes:
        return {"days": {LEDGER_FACT: [], SALES: [], DAILY: []}, "malformed": {}}
    now = silver_tables(spark, silver, company_sites)
    notes, cancels, ledger, pos = (now[n] for n in ("notes", "cancels", "ledger", "pos"))
    first = read_days(spark, f"{gold}/{SALES}") is None

    # touched notes, with what they looked like before and look like now
    touched = _any(*[changes[n].rows.select(F.col(c).alias("nota_id")) for n, c in (("notes", "nota_id"), ("cancels", "chNFe")) if n in changes])
    if touched is None:
        touched = spark.createDataFrame([], "nota_id string")
    touched = _any(touched, changes["notes"].keys.select("nota_id") if "notes" in changes else None) \
        .where("nota_id is not null").distinct().checkpoint(eager=True)
    looks = _any(_semi(notes, touched, ["nota_id"], ["nota_id"]).select("nNF", "serie", "hotel"),
                 changes["notes"].rows.select("nNF", "serie", "hotel") if "notes" in changes else None).distinct().checkpoint(eager=True)

    # ledger rows that changed, or that match a touched note
    row = ["lancamento_id", F.col("data_emissao").alias("day")]
    affected = _any(changes["ledger"].rows.select(*row) if "ledger" in changes else None,
                    _semi(ledger, touched, ["chave_sefaz_raw"], ["nota_id"]).select(*row),
                    _semi(ledger, looks, ["numero_documento", "serie", "hotel"], ["nNF", "serie", "hotel"]).select(*row)).distinct().checkpoint(eager=True)
    fact_days = None if first else days_of(affected, "day")
    fact_before = read_days(spark, f"{gold}/{LEDGER_FACT}")
    matched_before = None if fact_before is None else _semi(fact_before, affected, ["lancamento_id"], ["lancamento_id"]).select(
        F.col("chave_nfe").alias("nota_id")).checkpoint(eager=True)
    if fact_days is None or fact_days:
        rows = ledger if fact_days is None else ledger.where(in_days("data_emissao", fact_days))
        write_days(fiscal.fact_ledger(rows, notes, cancels), f"{gold}/{LEDGER_FACT}", "data_emissao", fact_days)
    fact = read_days(spark, f"{gold}/{LEDGER_FACT}")

    # notes whose line in the sales mart may differ, and their days
    matched_now = _semi(fact, affected, ["lancamento_id"], ["lancamento_id"]).select(F.col("chave_nfe").alias("nota_id"))
    stirred = _any(touched, changes["pos"].keys.select(F.col("chave_nfe").alias("nota_id")) if "pos" in changes else None,
                   matched_before, matched_now).where("nota_id is not null").distinct().checkpoint(eager=True)
    sales_before = read_days(spark, f"{gold}/{SALES}")
    if first:
        days, chosen = None, notes
    else:
        days = sorted(set(days_of(_semi(notes, stirred, ["nota_id"], ["nota_id"]).select(F.to_date(instant("dhEmi")).alias("d")), "d"))
                      | set(days_of(_semi(sales_before, stirred, ["nota_id"], ["nota_id"]), "dia")), key=str)
        # the mart's day is that of the moment, a silver day that of the text: one more on each side
        near = sorted({x + dt.timedelta(n) for x in days if x is not None for n in (-1, 0, 1)})
        wanted = in_days("dia", near) if near else F.lit(False)
        chosen = notes.where(wanted | instant("dhEmi").isNull() if None in days else wanted)
    if days is None or days:
        chosen = chosen.drop("dia")
        some = fact if days is None else _semi(fact, chosen, ["chave_nfe"], ["nota_id"])
        sales = fiscal.sales_notes(fiscal.fact_notes(chosen, cancels, pos), pos, some).withColumn("dia", F.to_date("data_emissao"))
        sales = sales if days is None else sales.where(in_days("dia", days))
        write_days(sales, f"{gold}/{SALES}", "dia", days)
        sales = read_days(spark, f"{gold}/{SALES}")
        known = None if days is None else [x for x in days if x is not None]
        if known is None or known:
            daily = fiscal.sales_daily((sales if known is None else sales.where(in_days("dia", known))).drop("dia"))
            write_days(daily, f"{gold}/{DAILY}", "data", known)
    for name in (LEDGER_FACT, SALES, DAILY):
        vacuum(spark, f"{gold}/{name}")
    _write_text(spark, f"{gold}/_processed", json.dumps(seqs))
    return {"days": {LEDGER_FACT: fact_days, SALES: days, DAILY: None if days is None else [x for x in days if x is not None]},
            "malformed": malformed}
