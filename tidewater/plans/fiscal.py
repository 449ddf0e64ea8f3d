"""POS / tax-note / ledger views (V6-V11) and their bronze -> silver specs.

Bronze tables are ``(key, data VARIANT, extracted_at)``. The specs below are
the reference's projections as data: ``(column, JSON path, type)``; their names
are fixed values, since users' SQL and the landed documents have them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.json_paths import project
from tidewater.functions.scalar import blank_to_null, instant, local_day, map_code, status_of
from tidewater.operators.aggregates import count_where, main_value, mart, sum_where
from tidewater.operators.joins import left_joins, left_lookup_many, one_per_key, resolve, with_exists
from tidewater.fixed_values import STATUS_AUTHORISED, STATUS_CANCELLED, STATUS_PENDING

# Ledger company id -> site code is deployment data (D15: an
# unmapped company keeps a NULL site). Pass it as ``company_sites``.

LEDGER_SPEC = [
    ("fkempresa", "FKEMPRESA", "text"),
    ("empresa", "EMPRESA", "text"),
    ("data_emissao", "DTDATAEMISSAO", "iso_date"),
    ("tipo_documento", "TIPODEDOCUMENTO", "text"),
    ("numero_documento", "ANNUMERODOCUMENTO", "text"),
    ("serie", "ANSERIE", "text"),
    ("cfop", "ANCFOP", "text"),
    ("codigo_produto", "ANCODIGO", "text"),
    ("descricao_produto", "ANDESCRICAO", "text"),
    ("quantidade", "QTQUANTIDADECOMERCIAL", "numeric(12,4)"),
    ("valor_unitario", "VLVALORUNITARIOCOMERCIAL", "numeric(12,2)"),
    ("valor_total_item", "VLVALORTOTAL", "numeric(12,2)"),
    ("desconto", "VALORDESCONTO", "numeric(12,2)"),
    ("valor_total_documento", "VLVALORTTDOCUMENTO", "numeric(12,2)"),
    ("chave_sefaz_raw", "ANCHAVE", "text"),
]

NOTE_SPEC = [
    ("hotel", "hotel", "text"), ("dhEmi", "dhEmi", "text", "instant", "iso_date"), ("nNF", "nNF", "text"),
    ("serie", "serie", "text"), ("mod", "mod", "text"), ("tpAmb", "tpAmb", "text"),
    ("cnpj_emit", "cnpj_emit", "text"), ("nome_emit", "nome_emit", "text"),
    ("vNF", "vNF", "numeric(12,2)"), ("nProt", "nProt", "text"), ("cStat", "cStat", "text"),
    ("dhRecbto", "dhRecbto", "text", "instant"),
]

CANCEL_SPEC = [
    ("chNFe", "chNFe", "text"), ("dhEvento", "dhEvento", "text", "instant"),
    ("nProt", "nProt", "text"), ("xJust", "xJust", "text"),
]

POS_SPEC = [
    ("hotel", "hotel", "text"),
    ("data_venda", "['Business Date']", "date"),
    ("numero_nota", "['FCR Invoice Number']", "text"),
    ("numero_comanda", "['Check Number']", "bigint"),
    ("subtotal_1", "['Sub Total 1']", "numeric(12,2)"),
    ("subtotal_2", "['Sub Total 2']", "numeric(12,2)"),
    ("subtotal_3", "['Sub Total 3']", "numeric(12,2)"),
    ("subtotal_6", "['Sub Total 6']", "numeric(12,2)"),
    ("imposto_1", "['Tax Total 1']", "numeric(12,2)"),
    ("ponto_venda", "['Local Revenue Center Name']", "text"),
    ("ponto_venda_master", "['Revenue Center Master Name']", "text"),
    ("quarto", "['Invoice Data Info 5']", "text"),
    ("garcom", "['Invoice Data Info 6']", "text"),
    ("status_nota", "['Invoice Status']", "smallint"),
    ("terminal_pdv", "uwsName", "text"),
    ("arquivo_origem", "source_file", "text"),
]


def _opt(df: DataFrame, *cols: str) -> list[str]:
    """Pass-through columns that exist (``extracted_at`` is optional)."""
    return [c for c in cols if c in df.columns]


def silver_ledger(raw: DataFrame, company_sites: Mapping[str, str], malformed: str | None = None) -> DataFrame:
    """Typed ledger rows; one JSON parse per row. ``malformed`` as in ``project``."""
    s = project(raw, "data", LEDGER_SPEC, keep=["lancamento_id", "extracted_at"], malformed=malformed)
    return s.withColumn("hotel", map_code("fkempresa", company_sites, fallback=None))


def silver_notes(raw: DataFrame, malformed: str | None = None) -> DataFrame:
    return project(raw, "data", NOTE_SPEC, keep=["nota_id", "extracted_at"], malformed=malformed)


def silver_cancels(raw: DataFrame, malformed: str | None = None) -> DataFrame:
    return project(raw, "data", CANCEL_SPEC, keep=["cancelamento_id", "extracted_at"], malformed=malformed)


def fact_pos(raw: DataFrame, malformed: str | None = None) -> DataFrame:
    """V9: POS notes, 18 columns."""
    p = project(raw, "data", POS_SPEC, keep=["nota_id", "extracted_at"], malformed=malformed).withColumnRenamed("nota_id", "chave_nfe")
    return p.select("chave_nfe", *[n for n, *_ in POS_SPEC], *_opt(p, "extracted_at", *([malformed] if malformed else [])))


def fact_ledger(ledger: DataFrame, notes: DataFrame, cancels: DataFrame, direct: bool = True) -> DataFrame:
    """V6 (V6b with ``direct=False``): ledger rows + the tax note matched by the
    direct key, else by (number, series, site), + cancelled flag.

    ``ledger`` is ``silver_ledger``; ``notes`` is ``silver_notes``; ``cancels``
    is ``silver_cancels``. Keeps the ledger row count (one note at most).
    """
    left = ledger.withColumn("_direct", blank_to_null("chave_sefaz_raw") if direct else F.lit(None).cast("string"))
    # the cancellation EXISTS is a property of the note: flag the (small)
    # notes side once and carry the flag through the match, instead of a
    # third shuffle of the (large) ledger on the resolved key
    right = with_exists(notes.select("nota_id", "nNF", "serie", F.col("hotel").alias("_nhotel"),
                                     "cStat", "nProt", "dhRecbto"),
                        cancels, "nota_id", "chNFe", "_cancelled", grows=True)
    m = resolve(left, right, direct=("_direct", "nota_id"),
                composite=(["numero_documento", "serie", "hotel"], ["nNF", "serie", "_nhotel"]),
                order=["nota_id"], take=["nota_id", "cStat", "nProt", "dhRecbto", "_cancelled"])
    m = m.withColumn("cancelada", F.coalesce(F.col("_cancelled"), F.lit(False)))
    cols = ["lancamento_id", "hotel", "empresa", "data_emissao", "tipo_documento", "numero_documento",
            "serie", "cfop", "codigo_produto", "descricao_produto", "quantidade", "valor_unitario",
            "valor_total_item", "desconto", "valor_total_documento", "chave_sefaz_raw"]
    return m.select(*cols,
                    F.col("nota_id").alias("chave_nfe"), F.col("cStat").alias("status_sefaz"),
                    F.col("nProt").alias("protocolo_sefaz"), instant("dhRecbto").alias("recebimento_sefaz"),
                    "cancelada", *_opt(m, "extracted_at"))


def fact_notes(notes: DataFrame, cancels: DataFrame, pos: DataFrame, fan_out: bool = False) -> DataFrame:
    """V8: tax note + cancellation + POS match flags.

    Default keeps one row per note by taking the latest cancellation (D3);
    ``fan_out=True`` is the literal left join (one row per cancellation).
    ``pos`` is ``fact_pos`` (unique per key)."""
    c = cancels.select(F.col("chNFe"), F.col("cancelamento_id"), F.col("dhEvento"),
                       F.col("nProt").alias("protocolo_cancelamento"),
                       F.col("xJust").alias("justificativa_cancelamento"))
    ccols = ["cancelamento_id", "dhEvento", "protocolo_cancelamento", "justificativa_cancelamento"]
    p = pos.select(F.col("chave_nfe").alias("_pk"), F.lit(True).alias("_pos"),
                   F.col("data_venda").alias("data_venda_pdv"), F.col("subtotal_1").alias("valor_pdv"),
                   F.col("ponto_venda"))
    pcols = ["_pos", "data_venda_pdv", "valor_pdv", "ponto_venda"]
    if fan_out:
        n = left_joins(notes, "nota_id", [(c, "chNFe", ccols), (p, "_pk", pcols)])
    else:
        latest = one_per_key(c, "chNFe", ["dhEvento", "cancelamento_id"], take=ccols, largest=True)
        n = left_lookup_many(notes, "nota_id", [(latest, "chNFe", ccols), (p, "_pk", pcols)])
    return n.select(
        "nota_id", "hotel", instant("dhEmi").alias("data_emissao"), F.col("nNF").alias("numero_nota"),
        "serie", F.col("mod").alias("modelo"), F.col("tpAmb").alias("ambiente"), "cnpj_emit",
        F.col("nome_emit").alias("emitente"), F.col("vNF").alias("valor_total"),
        F.col("nProt").alias("protocolo_autorizacao"), F.col("cStat").alias("status_sefaz"),
        instant("dhRecbto").alias("data_recebimento_sefaz"),
        F.col("cancelamento_id").isNotNull().alias("cancelada"),
        instant("dhEvento").alias("data_cancelamento"), "protocolo_cancelamento", "justificativa_cancelamento",
        F.coalesce(F.col("_pos"), F.lit(False)).alias("tem_pdv"), "data_venda_pdv", "valor_pdv", "ponto_venda",
        *_opt(n, "extracted_at"))


def fiscal_summary(ledger_fact: DataFrame, key: str = "chave_nfe", code: str = "cfop") -> DataFrame:
    """V10's ``fiscal_agg``: per note, item count and most frequent code."""
    return main_value(ledger_fact.filter(F.col(key).isNotNull()), key, code,
                      name="cfop_principal", count_name="qtd_itens")


# V10's output columns, in order (when its input is V8).
SALES_COLUMNS = [
    "nota_id", "hotel", "data_emissao", "numero_nota", "serie", "modelo", "valor_total", "status_sefaz",
    "protocolo_autorizacao", "data_recebimento_sefaz", "cancelada", "data_cancelamento",
    "justificativa_cancelamento", "tem_pdv", "data_venda_pdv", "valor_pdv", "ponto_venda",
    "subtotal_1", "subtotal_2", "subtotal_3", "subtotal_6", "imposto_1", "quarto", "garcom",
    "tem_fiscal", "qtd_itens", "cfop_principal", "status",
]


def sales_notes(notes_fact: DataFrame, pos_fact: DataFrame | None, ledger_fact: DataFrame,
                pos_cols: Sequence[str] = ("subtotal_1", "subtotal_2", "subtotal_3", "subtotal_6",
                                           "imposto_1", "quarto", "garcom"),
                key: str = "nota_id", ledger_key: str = "chave_nfe", code: str = "cfop") -> DataFrame:
    """Note fact + POS columns + ledger summary + status, one row per note."""
    f = fiscal_summary(ledger_fact, ledger_key, code).withColumn("tem_fiscal", F.lit(True))
    rights = [(f, ledger_key, ["tem_fiscal", "qtd_itens", "cfop_principal"])]
    if pos_fact is not None and pos_cols:
        rights.insert(0, (pos_fact, "chave_nfe", list(pos_cols)))
    n = left_lookup_many(notes_fact, key, rights)   # one shuffle of the notes for both lookups
    out = (n.withColumn("tem_fiscal", F.coalesce("tem_fiscal", F.lit(False)))
            .withColumn("qtd_itens", F.coalesce("qtd_itens", F.lit(0).cast("bigint")))
            .withColumn("status", status_of("cancelada", "status_sefaz")))
    if all(c in out.columns for c in SALES_COLUMNS):   # V8 input: the reference's column list
        return out.select(*SALES_COLUMNS)
    return out


def sales_daily(sales: DataFrame, zone: str | None = None) -> DataFrame:
    """Daily mart per site. ``zone`` picks the calendar of the day (D11);
    default is the session zone."""
    st = F.col("status")
    return mart(
        sales.filter(F.col("data_emissao").isNotNull()),
        [F.col("hotel"), local_day("data_emissao", zone).alias("data")],
        {
            "total_notas": F.count(F.lit(1)),
            "notas_autorizadas": count_where(st == STATUS_AUTHORISED),
            "notas_canceladas": count_where(st == STATUS_CANCELLED),
            "notas_pendentes": count_where(st == STATUS_PENDING),
            "valor_total_dia": sum_where(F.col("valor_total"), st != STATUS_CANCELLED),
            "notas_com_pdv": count_where(F.col("tem_pdv")),
            "notas_com_fiscal": count_where(F.col("tem_fiscal")),
        })
