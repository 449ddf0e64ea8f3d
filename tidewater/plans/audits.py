"""Named audit and report queries over the views.

Each is a function of DataFrames and parameters (no ``now()``: an ``as_of``
day makes results repeat). Sorting is left to the consumer unless the query
is a top-k or a listing whose order is the point; sorts follow PostgreSQL's
null order (D10).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.json_paths import project
from tidewater.functions.scalar import abs_diff, differs, iso_date, month_of
from tidewater.operators.aggregates import count_distinct_tuple, coverage, table_counts
from tidewater.operators.filters import (
    by_key, in_period, last_days, missing_any, since, since_any, where_if, where_nonzero, where_path,
)
from tidewater.operators.joins import missing_detail, without
from tidewater.operators.ordering import sort, top
from tidewater.fixed_values import INTERNAL_CONSUMPTION, STATUS_AUTHORISED, STATUS_PENDING

# ------------------------------------------------------------ maintenance


def occurrences_without_detail(bulk: DataFrame, details: DataFrame, day, key: str = "scheduled_work_id") -> DataFrame:
    """Q1: completed occurrences with no detail, started or completed since ``day``."""
    s = project(bulk, "data", [("state", "attributes.state", "text"),
                               ("start_date", "attributes.start_date", "timestamp"),
                               ("completed_date", "attributes.completed_date", "timestamp")], keep=[key])
    s = since_any(s.filter(F.upper("state") == "COMPLETED"), ["start_date", "completed_date"], day)
    return missing_detail(s, details, key).select(key)


def tickets_without_detail(bulk: DataFrame, details: DataFrame, day, key: str = "failure_id",
                           date_path: str = "attributes.date") -> DataFrame:
    """Q2: tickets with no detail since ``day`` (the cited path is a field no
    sample has, D24: such rows never match; pass another path)."""
    s = project(bulk, "data", [("d", date_path, "timestamp")], keep=[key])
    return missing_detail(since(s, "d", day), details, key).select(key)


def plans_without_detail(bulk: DataFrame, details: DataFrame, day, key: str = "work_id") -> DataFrame:
    """Q3: plans updated since ``day`` with no detail."""
    s = project(bulk, "data", [("updated_at", "attributes.updated_at", "timestamp")], keep=[key])
    return missing_detail(since(s, "updated_at", day), details, key).select(key)


def ids_by_state(bulk: DataFrame, state: str, key: str = "failure_id", state_path: str = "attributes.state") -> DataFrame:
    """Q4: ids in a state (the deleted marker, PAUSED, ...)."""
    s = project(bulk, "data", [("state", state_path, "text")], keep=[key])
    return where_path(s, "state", state)


def hours_per_operator(intervals: DataFrame) -> DataFrame:
    """Q5: worked hours per operator, most first."""
    return sort(intervals.groupBy("operator_id").agg(F.sum("horas_decimais").alias("total_horas")), ["-total_horas"])


def completed_per_hotel(occurrences: DataFrame) -> DataFrame:
    """Q6."""
    return occurrences.filter(F.col("status") == "COMPLETED").groupBy("hotel").agg(F.count(F.lit(1)).alias("count"))


# ------------------------------------------------------------ tax notes


def notes_per_hotel(pos: DataFrame) -> DataFrame:
    """Q7 (POS notes per site)."""
    return sort(pos.groupBy("hotel").agg(F.count(F.lit(1)).alias("total")), ["hotel"])


def cancels_per_hotel(cancels_raw: DataFrame) -> DataFrame:
    """Q7 (cancellations per site)."""
    s = project(cancels_raw, "data", [("hotel", "hotel", "text")])
    return sort(s.groupBy("hotel").agg(F.count(F.lit(1)).alias("total")), ["hotel"])


def notes_without_pos(notes: DataFrame, pos: DataFrame, day) -> DataFrame:
    """Q8: notes issued since ``day`` with no POS record (``notes`` is
    ``silver_notes``; the date is the literal date of ``dhEmi``)."""
    n = notes.withColumn("_d", iso_date("dhEmi"))
    n = without(since(n, "_d", day), pos, "nota_id", "chave_nfe", grows=True)
    return sort(n.select("nota_id", "hotel", F.col("dhEmi").alias("data_emissao"), F.col("nNF").alias("numero_nota"),
                         F.col("vNF").alias("valor")), ["-data_emissao"])


def pos_overlap(notes: DataFrame, pos: DataFrame, day) -> DataFrame:
    """Q9: per site, notes since ``day``, with and without POS."""
    n = since(notes.withColumn("_d", iso_date("dhEmi")), "_d", day)
    return sort(coverage(n, pos, "nota_id", ["hotel"], right_key="chave_nfe", names=("total_nfe", "com_pdv", "sem_pdv")),
                ["hotel"])


def cancels_without_note(cancels: DataFrame, notes: DataFrame) -> DataFrame:
    """Q10: cancellations whose note is unknown (``cancels`` = ``silver_cancels``)."""
    return without(cancels, notes, "chNFe", "nota_id", grows=True).select("cancelamento_id", F.col("chNFe").alias("chave_nota"))


def note_xml(notes_raw: DataFrame, key: str) -> DataFrame:
    """Q11: the whole XML of one note."""
    return project(by_key(notes_raw, "nota_id", key), "data", [("xml_content", "xml_content", "text")])


# ------------------------------------------------------------ ledger


def ledger_per_company(ledger: DataFrame) -> DataFrame:
    """Q12a."""
    return sort(ledger.groupBy("empresa").agg(F.count(F.lit(1)).alias("total")), ["empresa"])


def ledger_per_day(ledger: DataFrame) -> DataFrame:
    """Per issue day and company, rows and document value."""
    return sort(ledger.groupBy("data_emissao", "empresa")
                      .agg(F.count(F.lit(1)).alias("total"), F.sum("valor_total_documento").alias("valor_total")),
                ["-data_emissao", "empresa"])


def ledger_period(ledger: DataFrame, lo, hi) -> DataFrame:
    """Q13: ledger rows issued between two days (inclusive)."""
    return sort(in_period(ledger, "data_emissao", lo, hi).select(
        "lancamento_id", "empresa", "data_emissao", F.col("numero_documento").alias("numero"), "serie",
        F.col("tipo_documento").alias("tipo"), "cfop", F.col("valor_total_documento").alias("valor_total")),
        ["-data_emissao"])


def best_products(ledger: DataFrame) -> DataFrame:
    """Q14: products by invoiced value."""
    g = ledger.groupBy(F.col("codigo_produto").alias("codigo"), F.col("descricao_produto").alias("descricao")).agg(
        F.count(F.lit(1)).alias("ocorrencias"), F.sum("valor_total_item").alias("valor_total"))
    return sort(g, ["-valor_total"])


# ------------------------------------------------------------ sales marts


def sales_recent(daily: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Q15: daily mart of the last ``days`` days up to ``as_of``."""
    return sort(last_days(daily, "data", as_of, days).select(
        "hotel", "data", "total_notas", "notas_autorizadas", "valor_total_dia"), ["hotel", "-data"])


def value_gaps(sales: DataFrame, tol: float = 0.01) -> DataFrame:
    """Q16: authorised notes whose note and POS values differ by more than ``tol``."""
    s = sales.filter((F.col("status") == STATUS_AUTHORISED) & F.col("tem_pdv") & differs("valor_total", "valor_pdv", tol))
    s = s.select("nota_id", "hotel", "data_emissao", "valor_total", "valor_pdv",
                 (F.col("valor_total") - F.col("valor_pdv")).alias("diferenca"),
                 abs_diff("valor_total", "valor_pdv").alias("_gap"))
    return sort(s, ["-_gap"]).drop("_gap")


def pending_per_hotel(sales: DataFrame) -> DataFrame:
    """Q17."""
    g = sales.filter(F.col("status") == STATUS_PENDING).groupBy("hotel").agg(
        F.count(F.lit(1)).alias("pendentes"), F.sum("valor_total").alias("valor_total"))
    return sort(g, ["-pendentes"])


def missing_side(sales: DataFrame) -> DataFrame:
    """Q18: authorised notes missing the POS or the ledger side."""
    s = missing_any(sales.filter(F.col("status") == STATUS_AUTHORISED), ["tem_pdv", "tem_fiscal"])
    return sort(s.select("nota_id", "hotel", "data_emissao", "valor_total", "status", "tem_pdv", "tem_fiscal"),
                ["-data_emissao"])


def monthly_revenue(daily: DataFrame) -> DataFrame:
    """Q19: month revenue per site. The cited "authorised only" value only
    excludes cancelled notes (D14), hence the column name."""
    g = daily.groupBy("hotel", month_of("data").alias("mes")).agg(F.sum("valor_total_dia").alias("revenue_not_cancelled"))
    return sort(g, ["hotel", "-mes"])


# ------------------------------------------------------------ POS


def pos_per_day(pos: DataFrame) -> DataFrame:
    """POS totals per site and day."""
    g = pos.groupBy("hotel", "data_venda").agg(F.count(F.lit(1)).alias("qtd_notas"), F.sum("subtotal_1").alias("total_bruto"))
    return sort(g, ["-data_venda", "hotel"])


def pos_coverage(pos: DataFrame) -> DataFrame:
    """Which days and sites have POS notes."""
    return sort(pos.groupBy("data_venda", "hotel").agg(F.count(F.lit(1)).alias("qtd_notas")), ["-data_venda"])


def sales_per_outlet(pos: DataFrame, day) -> DataFrame:
    """Q21."""
    d = pos.filter(F.col("data_venda") == F.lit(day).cast("date"))
    return sort(d.groupBy("hotel", "ponto_venda").agg(F.sum("subtotal_1").alias("total")), ["-total"])


def notes_of_room(pos: DataFrame, room: str) -> DataFrame:
    """Q22a."""
    return sort(where_path(pos, "quarto", room).select(
        "data_venda", "hotel", "quarto", "numero_nota", "subtotal_1", "garcom", "ponto_venda"), ["-data_venda"])


def pos_note(pos: DataFrame, key: str) -> DataFrame:
    """Q22b."""
    return by_key(pos, "chave_nfe", key)


# ------------------------------------------------------------ line items

ITEM_AUDIT_SPEC = [
    ("hotel", "hotel", "text"), ("data", "businessDate", "text"), ("tipo", "orderTypeName", "text"),
    ("comanda_id", "guestCheckID", "bigint"), ("numero_linha", "lineNum", "integer"),
    ("produto", "menuItemName1", "text"), ("grupo", "majorGroupName", "text"),
    ("quantidade", "numerator", "integer"), ("valor", "lineTotal", "numeric"), ("void", "isVoidFlag", "text"),
    ("location_name", "locationName", "text"), ("revenueCenterNum", "revenueCenterNum", "integer"),
    ("menuItemNum", "menuItemNum", "integer"), ("lineCount", "lineCount", "integer"),
]


def items(raw: DataFrame) -> DataFrame:
    """Typed line items for the guides' queries (site = the parser's code)."""
    return project(raw, "data", ITEM_AUDIT_SPEC, keep=["line_item_id"])


def items_per_day(it: DataFrame) -> DataFrame:
    """Q23."""
    return sort(it.groupBy("hotel", "data").agg(F.count(F.lit(1)).alias("total_items")), ["-data", "hotel"])


INTERNAL = INTERNAL_CONSUMPTION


def internal_per_day(it: DataFrame, order_type: str = INTERNAL) -> DataFrame:
    """Q24: internal consumption per site and day: checks, items, value."""
    g = it.filter(F.col("tipo") == order_type).groupBy("hotel", "data").agg(
        F.count_distinct("comanda_id").alias("comandas"), F.count(F.lit(1)).alias("itens"),
        F.sum("valor").alias("valor_total"))
    return sort(g, ["-data", "hotel"])


def items_of_check(it: DataFrame, check_id: int) -> DataFrame:
    """Q25: items of one check in line order."""
    return sort(by_key(it, "comanda_id", check_id), ["numero_linha"]).select("produto", "quantidade", "valor")


def volume_per_order_type(it: DataFrame, day: str) -> DataFrame:
    """Q26."""
    g = it.filter(F.col("data") == day).groupBy("tipo", "hotel").agg(
        F.count(F.lit(1)).alias("itens"), F.count_distinct("comanda_id").alias("comandas"),
        F.sum("valor").alias("valor_total"))
    return sort(g, ["tipo", "hotel"])


def top_items(it: DataFrame, day: str, hotel: str, k: int = 20) -> DataFrame:
    """Q27: top products of a day and site, void items excluded."""
    d = it.filter((F.col("data") == day) & (F.col("hotel") == hotel) & (F.col("void") == "0"))
    g = d.groupBy("produto", "grupo").agg(F.count(F.lit(1)).alias("ocorrencias"), F.sum("quantidade").alias("qtd_total"),
                                          F.sum("valor").alias("valor_total"))
    return top(g, k, ["-valor_total", "produto", "grupo"])


def internal_items(it: DataFrame, day: str, location: str | None = None, order_type: str = INTERNAL) -> DataFrame:
    """Q30: internal-consumption items of a day with a non-zero value,
    ordered by location, check, line; optional location filter (P12)."""
    d = it.filter((F.col("data") == day) & (F.col("tipo") == order_type))
    d = where_if(where_nonzero(d, "valor"), "location_name", location)
    return sort(d, ["location_name", "comanda_id", "numero_linha"])


# ------------------------------------------------------------ counts


def raw_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of each raw table."""
    return table_counts(tables)


def distinct_documents(ledger: DataFrame) -> DataFrame:
    """Rows vs distinct (number, series, company) tuples."""
    return ledger.agg(F.count(F.lit(1)).alias("total_rows"),
                      count_distinct_tuple("numero_documento", "serie", "fkempresa").alias("distinct_docs"))


def ledger_recent(ledger_fact: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Ledger fact rows of the last ``days`` days (timed out as a plain
    view in the reference; here a pruned scan of the written gold table)."""
    return last_days(ledger_fact, "data_emissao", as_of, days)


def sales_notes_recent(sales: DataFrame, as_of, days: int = 30, limit: int | None = 500) -> DataFrame:
    """Sales notes of the last ``days`` days; ``limit`` as cited."""
    s = last_days(sales, "data_emissao", as_of, days)
    return s.limit(limit) if limit else s
