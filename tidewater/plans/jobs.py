"""End-to-end jobs wired from the pieces.

Each job reads landed files, parses them on the executors, upserts keyed
bronze tables and (for the ledger) refreshes the gold table; ``views`` then
registers every silver/gold view by name. Paths are folders on shared
storage; table folders are created on first use.

Bronze layout: ``<bronze>/<table>`` with columns ``(key column, data VARIANT,
extracted_at)``, as a table of ``sinks.batches``: a load writes its batch and
nothing else, ``bronze_table`` merges the batches when it reads.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.json_paths import cast_metrics, cast_rejects, casting, doc_path
from tidewater.functions.scalar import iso_date, map_code
from tidewater.operators.incremental import gone
from tidewater.plans import fiscal, maintenance
from tidewater.plans.line_items import fact_line_items
from tidewater.sinks.batches import append_batch, compact, read_merged
from tidewater.sinks.tables import dedupe_last, observed, refresh, register_all, soft_delete, write_rejects
from tidewater.sources.documents import (
    incomplete_lists, parse_cancel_xml, parse_detail_envelopes, parse_note_xml, parse_paged_envelopes, records, rejects,
    scan_json_array, scan_nested_array_json, scan_sectioned_json,
)
from tidewater.session import checkpoint_dir
from tidewater.sources.files import folder_of, fresh_files, key_from_name, landed, listed_files, new_files, select_files, unread_files

# File-name selections (S8), as regular expressions over the file name.
POS_FILES = dict(include=r"\d{4}-\d{2}-\d{2}.*\.json$", exclude="GCM")
LINE_ITEM_FILES = dict(include="GCM")
NOTE_FILES = dict(include=r"\.xml$", exclude=r"(-can\.xml$)|(^CFe)")
CANCEL_FILES = dict(include=r"-can\.xml$")


def bronze_table(spark: SparkSession, bronze: str, name: str, key: str) -> DataFrame:
    """Current rows ``(key, data, extracted_at)`` of a bronze table, none before the first load."""
    rows = read_merged(spark, f"{bronze}/{name}", key)
    if rows is None:
        return spark.createDataFrame([], f"{key} {KEY_TYPES.get(key, 'string')}, data variant, extracted_at timestamp")
    return rows.select(key, "data", "extracted_at")


KEY_TYPES = {"line_item_id": "bigint"}


def _upsert(rows: DataFrame, bronze: str, name: str, key: str) -> None:
    """The last arrival of a key in the batch wins (K2), and the batch over the table (K1)."""
    append_batch(dedupe_last(rows, key, "arrival").select(key, "data"), f"{bronze}/{name}", key)
    compact(rows.sparkSession, f"{bronze}/{name}", key)


def _load(parsed: DataFrame, files: DataFrame, bronze: str, name: str, key: str, dead_letters: str | None, job_date: str | None) -> dict:
    """Parse once (a checkpoint in the shared folder), upsert what is good,
    report what is not: K3's counts, and K6's rejects if ``dead_letters`` is given.
    ``files`` is the content-free listing of the files that should have been read."""
    spark = parsed.sparkSession
    checkpoint_dir(spark)
    staged = parsed.checkpoint(eager=True)
    good = records(staged).withColumnRenamed("key", key)
    _upsert(good, bronze, name, key)
    bad = rejects(staged).unionByName(unread_files(files, staged)).checkpoint(eager=True)
    if dead_letters:
        write_rejects(bad, dead_letters, job_date, name)
    return {"rows": good.count(), "errors": bad.count()}


# ------------------------------------------------------------------ E1


def load_pos(spark: SparkSession, landing: str, bronze: str, store_codes: Mapping[str, str],
             day: str | None = None, rejects_to: str | None = None, job_date: str | None = None) -> dict:
    """POS note files -> ``pdv_raw_notas`` (keyed by the note key)."""
    def chosen(df: DataFrame) -> DataFrame:
        df = select_files(df, **POS_FILES)
        return df.filter(F.col("file_name").contains(day)) if day else df
    parsed = scan_sectioned_json(spark, landing, store_codes, errors=True, chosen=chosen)
    return _load(parsed, chosen(listed_files(spark, landing)), bronze, "pdv_raw_notas", "nota_id", rejects_to, job_date or day)


def load_line_items(spark: SparkSession, landing: str, bronze: str, location_codes: Mapping[str, str],
                    rejects_to: str | None = None, job_date: str | None = None) -> dict:
    """E1 for line items -> ``gcm_raw_line_items`` (keyed by line item id)."""
    def chosen(df: DataFrame) -> DataFrame:
        return select_files(df, **LINE_ITEM_FILES)
    parsed = scan_nested_array_json(spark, landing, location_codes, errors=True, chosen=chosen)
    return _load(parsed, chosen(listed_files(spark, landing)), bronze, "gcm_raw_line_items",
                 "line_item_id", rejects_to, job_date)


# ------------------------------------------------------------------ E2


def load_notes(spark: SparkSession, shares: str, bronze: str, share_codes: Mapping[str, str],
               rejects_to: str, job_date: str) -> dict:
    """Tax notes and cancellations from per-site share folders (S5, S6, S9,
    S11, S12): skip what is loaded, parse, upsert, log rejects."""
    site = map_code(folder_of(), share_codes)
    notes_t = bronze_table(spark, bronze, "nfe_raw_xmls", "nota_id")
    cancels_t = bronze_table(spark, bronze, "nfe_raw_cancelamentos", "cancelamento_id")
    checkpoint_dir(spark)

    def load(loaded: DataFrame, loaded_key: str, file_key, chosen: dict, parse, table: str, key: str) -> dict:
        fresh = fresh_files(spark, shares, loaded, loaded_key, file_key, **chosen).checkpoint(eager=True)
        read = new_files(spark, shares, loaded, loaded_key, file_key, **chosen).checkpoint(eager=True)
        unread = unread_files(fresh, read, "file_path")
        ok, bad = parse(read, site)   # loaded files stay unopened, new ones are read once
        ok, obs = observed(ok.select(key, "data", "arrival"), table)
        _upsert(ok.checkpoint(eager=True), bronze, table, key)
        bad, obs_bad = observed(bad.unionByName(unread), f"{table}_bad")
        write_rejects(bad, rejects_to, job_date, table)
        return {**obs.get, "errors": obs_bad.get["rows"]}

    notes = load(notes_t, "nota_id", key_from_name(), NOTE_FILES, parse_note_xml, "nfe_raw_xmls", "nota_id")
    loaded_names = cancels_t.select(doc_path(cancels_t, "data", "source_file").alias("f"))
    cancels = load(loaded_names, "f", None, CANCEL_FILES, parse_cancel_xml, "nfe_raw_cancelamentos", "cancelamento_id")
    return {"notes": notes, "cancels": cancels}


def load_ledger(spark: SparkSession, landing: str, bronze: str, gold: str, company_sites: Mapping[str, str],
                rejects_to: str | None = None, job_date: str | None = None) -> dict:
    """Ledger arrays -> ``fiscal_raw_lancamentos`` (last occurrence wins),
    then refresh the gold ledger fact (K4)."""
    got = _load(scan_json_array(spark, landing, errors=True), listed_files(spark, landing), bronze,
                "fiscal_raw_lancamentos", "lancamento_id", rejects_to, job_date)
    refresh_ledger_fact(spark, bronze, gold, company_sites)
    return got


class SilverTables(dict):
    """The silver tables by name; ``malformed`` has, per table, the count of
    values that were no value of their type by column (all casting columns)."""

    malformed: dict[str, dict[str, int]]


SILVER_SPECS = {"notes": fiscal.NOTE_SPEC, "cancels": fiscal.CANCEL_SPEC, "ledger": fiscal.LEDGER_SPEC, "pos": fiscal.POS_SPEC}
SILVER_KEYS = {"notes": "nota_id", "cancels": "cancelamento_id", "ledger": "lancamento_id", "pos": "chave_nfe"}
SILVER_DAYS = {"notes": "dia", "cancels": None, "ledger": "data_emissao", "pos": "data_venda"}


def silver_rows(name: str, raw: DataFrame, company_sites: Mapping[str, str]) -> DataFrame:
    """The typed rows of one silver table from its bronze documents, with the column ``malformed``."""
    if name == "ledger":
        return fiscal.silver_ledger(raw, company_sites, malformed="malformed")
    if name == "notes":
        return fiscal.silver_notes(raw, malformed="malformed").withColumn("dia", iso_date("dhEmi"))
    return (fiscal.silver_cancels if name == "cancels" else fiscal.fact_pos)(raw, malformed="malformed")


def refresh_silver(spark: SparkSession, bronze: str, silver: str, company_sites: Mapping[str, str],
                   rejects_to: str | None = None, job_date: str | None = None) -> SilverTables:
    """Typed silver tables, partitioned by day: notes (issue day), ledger
    (issue day), POS notes (sale day) and cancellations. Parquet cannot prune
    fields inside a VARIANT column, so at scale the views read these typed
    columns instead of re-projecting the bronze documents on every read;
    day filters prune partitions and the scan reads only the columns used.

    A value that is no value of its type is NULL in its column and stands, with
    its text, in ``malformed``; the pass that writes a table counts them per
    column (``SilverTables.malformed``), and with ``rejects_to`` they are also
    written as rejects of the job ``silver_<table>`` (K6)."""
    out = SilverTables()
    out.malformed = {}
    for name, (table, key) in SILVER_SOURCES.items():
        spec = SILVER_SPECS[name]
        rows = silver_rows(name, bronze_table(spark, bronze, table, key), company_sites)
        rows, seen = observed(rows, f"silver_{name}", **cast_metrics(spec))
        out[name] = refresh(rows, f"{silver}/{name}", partition_by=[SILVER_DAYS[name]] if SILVER_DAYS[name] else [])
        out.malformed[name] = {c: seen.get[c] or 0 for c in casting(spec)}
        if rejects_to:
            write_rejects(cast_rejects(out[name], SILVER_KEYS[name], spec), rejects_to, job_date, f"silver_{name}")
    return out


SILVER_SOURCES = {"notes": ("nfe_raw_xmls", "nota_id"), "cancels": ("nfe_raw_cancelamentos", "cancelamento_id"),
                  "ledger": ("fiscal_raw_lancamentos", "lancamento_id"), "pos": ("pdv_raw_notas", "nota_id")}


def _silver_inputs(spark: SparkSession, bronze: str, company_sites: Mapping[str, str], silver: str | None) -> dict:
    """(notes, cancels, ledger, pos) typed frames: from the silver tables when
    given, else projected from bronze."""
    from tidewater.sinks.tables import read_current
    if silver:
        return {n: read_current(spark, f"{silver}/{n}").drop("malformed") for n in ("notes", "cancels", "ledger", "pos")}
    t = lambda n, k: bronze_table(spark, bronze, n, k)
    return {"notes": fiscal.silver_notes(t("nfe_raw_xmls", "nota_id")),
            "cancels": fiscal.silver_cancels(t("nfe_raw_cancelamentos", "cancelamento_id")),
            "ledger": fiscal.silver_ledger(t("fiscal_raw_lancamentos", "lancamento_id"), company_sites),
            "pos": fiscal.fact_pos(t("pdv_raw_notas", "nota_id"))}


def refresh_ledger_fact(spark: SparkSession, bronze: str, gold: str, company_sites: Mapping[str, str],
                        silver: str | None = None) -> DataFrame:
    """K4: recompute V6 and swap it in, partitioned by issue day so that
    period reads (Q13, Q29) prune."""
    s = _silver_inputs(spark, bronze, company_sites, silver)
    fact = fiscal.fact_ledger(s["ledger"], s["notes"], s["cancels"])
    return refresh(fact, f"{gold}/mv_fiscal_lancamentos", partition_by=["data_emissao"])


# ------------------------------------------------------------------ E3


class IncompleteList(Exception):
    """Pages of a list are missing: it may not be loaded, nor tell which records are gone."""


def load_maintenance(spark: SparkSession, landing: str, bronze: str, kind: str, key: str,
                     rejects_to: str | None = None, job_date: str | None = None) -> dict:
    """List pages (bulk) and detail envelopes of one resource kind
    (``failures``, ``works``, ``scheduled_works``, ``operators``) under
    ``landing/<kind>/list`` and ``landing/<kind>/detail``. A list that lacks
    pages raises ``IncompleteList`` before anything is written."""
    lists = f"{landing}/{kind}/list"
    checkpoint_dir(spark)
    parsed = parse_paged_envelopes(landed(spark, lists), errors=True).checkpoint(eager=True)
    short = incomplete_lists(parsed).first()
    if short:
        raise IncompleteList(f"{kind}: {short['pages_seen']} of {short['total_pages']} pages of the list of {short['day']}")
    got = _load(parsed, listed_files(spark, lists), bronze, f"raw_{kind}", key, rejects_to, job_date)
    detail_dir = f"{landing}/{kind}/detail"
    from tidewater.sinks.tables import _fs
    fs, p = _fs(spark, detail_dir)
    if fs.exists(p):
        listed = listed_files(spark, detail_dir).checkpoint(eager=True)
        read = landed(spark, detail_dir).checkpoint(eager=True)
        ok, bad = parse_detail_envelopes(read)
        _upsert(ok.withColumnRenamed("key", key), bronze, f"raw_{kind}_details", key)
        bad, obs = observed(bad.unionByName(unread_files(listed, read, "file_path")), f"{kind}_bad")
        if rejects_to:
            write_rejects(bad, rejects_to, job_date, f"raw_{kind}_details")
        got["detail_errors"] = obs.get["rows"] if rejects_to else bad.count()
    return got


def reconcile_paused(spark: SparkSession, bronze: str, snapshot: DataFrame, key: str = "failure_id") -> None:
    """T5 + K5: tickets PAUSED locally that the source no longer lists are
    marked deleted, in the bulk (``attributes.state``) and detail
    (``data.attributes.status``) tables. ``snapshot`` is a complete list: its
    ids, or the parsed list pages, which are then checked (``IncompleteList``)."""
    if "total_pages" in snapshot.columns:
        if incomplete_lists(snapshot).first():
            raise IncompleteList("the snapshot lacks pages")
        snapshot = snapshot.filter(F.col("key").isNotNull()).select(F.col("key").alias(key))
    bulk = bronze_table(spark, bronze, "raw_failures", key)
    paused = bulk.filter(doc_path(bulk, "data", "attributes.state") == "PAUSED").select(key)
    ids = gone(paused, snapshot, key).checkpoint(eager=True)   # fixed set, independent of the rewrites below
    for name, parts in (("raw_failures", ["attributes", "state"]),
                        ("raw_failures_details", ["data", "attributes", "status"])):
        marked = bronze_table(spark, bronze, name, key).join(ids, key, "left_semi")
        append_batch(soft_delete(marked, ids, key, parts, stamp="extracted_at"), f"{bronze}/{name}", key, stamp=None)


# ------------------------------------------------------------------ gold marts


def refresh_marts(spark: SparkSession, bronze: str, gold: str, company_sites: Mapping[str, str],
                  silver: str | None = None) -> dict[str, DataFrame]:
    """K4 for the sales marts: V10 (one row per note) and V11 (site x day)
    written as gold tables, partitioned by day, so that BI reads and the
    30-day queries prune instead of recomputing the joins per read."""
    v = views(spark, bronze, gold, company_sites, silver=silver)
    sales = v["v_vendas_notas"].withColumn("dia", F.to_date("data_emissao"))
    return {
        "v_vendas_notas": refresh(sales, f"{gold}/vendas_notas", partition_by=["dia"]),
        "v_vendas_diario": refresh(v["v_vendas_diario"], f"{gold}/vendas_diario", partition_by=["data"]),
    }


# ------------------------------------------------------------------ views


def views(spark: SparkSession, bronze: str, gold: str, company_sites: Mapping[str, str],
          site_rules=(), silver: str | None = None) -> dict[str, DataFrame]:
    """Every silver/gold view by name, registered as temp views (typed
    inputs from ``silver`` when given, else projected from bronze)."""
    from tidewater.sinks.tables import read_current
    t = lambda n, k: bronze_table(spark, bronze, n, k)
    s = _silver_inputs(spark, bronze, company_sites, silver)
    notes, cancels, pos = s["notes"].drop("dia"), s["cancels"], s["pos"]
    ledger_fact = read_current(spark, f"{gold}/mv_fiscal_lancamentos")
    if ledger_fact is None:
        ledger_fact = refresh_ledger_fact(spark, bronze, gold, company_sites, silver)
    note_fact = fiscal.fact_notes(notes, cancels, pos)
    sales = fiscal.sales_notes(note_fact, pos, ledger_fact)
    plans = maintenance.dim_plans(t("raw_works_details", "work_id"), t("raw_works", "work_id"), site_rules)
    out = {
        "v_fiscal_lancamentos": ledger_fact, "v_nfe_notas": note_fact, "v_pdv_notas": pos,
        "v_vendas_notas": sales, "v_vendas_diario": fiscal.sales_daily(sales),
        "v_gcm_line_items": fact_line_items(t("gcm_raw_line_items", "line_item_id")),
        "v_operadores": maintenance.dim_operators(t("raw_operators", "operator_id")),
        "v_detalhe_planos_manutencao": plans,
        "v_detalhe_ocorrencias": maintenance.fact_occurrences(
            t("raw_scheduled_works_details", "scheduled_work_id"), t("raw_scheduled_works", "scheduled_work_id"),
            plans, site_rules),
        "v_trabalho_analitico_operador_chamados": maintenance.work_hours(t("raw_failures_details", "failure_id"), "failure_id"),
        "v_trabalho_analitico_operador_ocorrencias": maintenance.work_hours(
            t("raw_scheduled_works_details", "scheduled_work_id"), "scheduled_work_id"),
    }
    register_all(spark, out)
    return out
