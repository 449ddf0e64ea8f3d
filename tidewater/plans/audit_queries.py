"""Registered queries that call the library's own audits and views.

``stand_ins`` runs the operators; here the named queries (Q1-Q30) and views
(V1, V5, V6b, V9, V10, V12) themselves run, on documents and typed tables that
are built from the driver's tables, each against DuckDB SQL. The stand-ins are
the same as there: order = tax note, line item = ledger item or POS line,
customer = operator or plan, event = registry.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions import decimal, map_code
from tidewater.operators import changed_between, last_days, reconcile, since_any, sort, starting_from, where_in, where_present
from tidewater.plans import audits, fiscal, line_items, maintenance
from tidewater.plans.stand_ins import (
    ACTION_OF_EVENT, COVERS, DAY_COLUMNS, SALES_SQL, TABLES, _days_as_timestamps, _key44, dbl, intervals, ledger_fact_full, query,
    sales, t,
)
from tidewater.sources.documents import (
    page_completeness, parse_cancel_xml, parse_detail_envelopes, parse_json_array, parse_note_xml, parse_paged_envelopes,
    parse_sectioned_json, rejects,
)

ISO = "yyyy-MM-dd'T'HH:mm:ss"
DAY = "1998-06-01"


def _s(c) -> F.Column:
    return F.col(c).cast("string")


# ------------------------------------------------------------------ maintenance

def bulk(spark, d, key: str) -> DataFrame:
    """Orders as bulk documents: F completed, P paused; started on the order day, completed two days on."""
    o = t(spark, d, "orders")
    done = F.when(F.col("o_orderstatus") == "F", F.date_format(F.col("o_orderdate") + F.expr("interval 2 days"), ISO))
    state = map_code("o_orderstatus", {"F": "Completed", "P": "PAUSED"})
    return o.select(_s("o_orderkey").alias(key), F.to_json(F.struct(F.struct(
        state.alias("state"), F.date_format("o_orderdate", ISO).alias("start_date"), done.alias("completed_date"),
        F.date_format("o_orderdate", ISO).alias("updated_at"), F.date_format("o_orderdate", ISO).alias("date"))
        .alias("attributes"))).alias("data"))


def detailed(spark, d, key: str) -> DataFrame:
    return t(spark, d, "lineitem").filter(F.col("l_returnflag") == "R").select(_s("l_orderkey").alias(key)).distinct()


NO_DETAIL = "NOT EXISTS (SELECT 1 FROM lineitem WHERE l_returnflag = 'R' AND l_orderkey = o_orderkey)"


@query("q1_occurrences_without_detail", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS scheduled_work_id FROM orders
WHERE o_orderstatus = 'F' AND (o_orderdate >= DATE '1995-03-01' OR o_orderdate + INTERVAL 2 DAY >= DATE '1995-03-01') AND {NO_DETAIL}""")
def q1(spark, d):
    k = "scheduled_work_id"
    return audits.occurrences_without_detail(bulk(spark, d, k), detailed(spark, d, k), "1995-03-01")


@query("q2_tickets_without_detail", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS failure_id FROM orders WHERE o_orderdate >= DATE '1997-06-01' AND {NO_DETAIL}""")
def q2(spark, d):
    return audits.tickets_without_detail(bulk(spark, d, "failure_id"), detailed(spark, d, "failure_id"), "1997-06-01")


@query("q3_plans_without_detail", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS work_id FROM orders WHERE o_orderdate >= DATE '1997-06-01' AND {NO_DETAIL}""")
def q3(spark, d):
    return audits.plans_without_detail(bulk(spark, d, "work_id"), detailed(spark, d, "work_id"), "1997-06-01")


@query("q4_ids_by_state", "SELECT CAST(o_orderkey AS VARCHAR) AS failure_id, 'PAUSED' AS state FROM orders WHERE o_orderstatus = 'P'")
def q4(spark, d):
    return audits.ids_by_state(bulk(spark, d, "failure_id"), "PAUSED").select("failure_id", "state")


@query("q5_hours_per_operator", """
WITH o AS (SELECT user_id, event_type, ts, lead(ts) OVER w AS nt, lead(event_type) OVER w AS ny
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id AS operator_id, round(sum((epoch_us(nt) - epoch_us(ts)) / CAST(3600000000 AS DOUBLE)), 6) AS total_horas FROM o
WHERE event_type IN ('view', 'signup') AND ny IN ('purchase', 'error') AND nt IS NOT NULL GROUP BY 1""")
def q5(spark, d):
    return audits.hours_per_operator(intervals(spark, d)).withColumn("total_horas", F.round("total_horas", 6))


@query("q6_completed_per_hotel", "SELECT o_orderpriority AS hotel, count(*) AS count FROM orders WHERE o_orderstatus = 'F' GROUP BY 1")
def q6(spark, d):
    o = t(spark, d, "orders").select(F.col("o_orderpriority").alias("hotel"), map_code("o_orderstatus", {"F": "COMPLETED"}).alias("status"))
    return audits.completed_per_hotel(o)


@query("v1_operators", """
SELECT CAST(c_custkey AS VARCHAR) AS operator_id, c_name AS nome_operador, c_mktsegment AS tipo_conta,
       CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS DOUBLE) AS custo_por_hora, CAST(c_nationkey AS DOUBLE) AS entity_id,
       c_nationkey > 12 AS is_from_network, TIMESTAMP '2024-01-02 03:04:05' AS data_criacao_origem FROM customer""")
def v1(spark, d):
    docs = t(spark, d, "customer").select(_s("c_custkey").alias("operator_id"), F.lit(None).cast("timestamp").alias("extracted_at"), F.to_json(
        F.struct(F.struct(F.col("c_name").alias("full_name"), F.col("c_mktsegment").alias("account"),
                          decimal("c_acctbal").cast("string").alias("cost_per_hour"), F.col("c_nationkey").alias("entity_id"),
                          (F.col("c_nationkey") > 12).alias("is_from_network"), F.lit("2024-01-02T03:04:05").alias("created_at"))
                 .alias("attributes"))).alias("data"))
    return maintenance.dim_operators(docs).select(
        "operator_id", "nome_operador", "tipo_conta", dbl("custo_por_hora").alias("custo_por_hora"), dbl("entity_id").alias("entity_id"),
        "is_from_network", F.col("data_criacao_origem").cast("timestamp_ntz").alias("data_criacao_origem"))


HOT_USER = "CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id END"


@query("v5_occurrence_hours", f"""
WITH r AS (SELECT {HOT_USER} AS u, event_id, ts,
                  CASE event_type WHEN 'view' THEN 'STARTED' WHEN 'purchase' THEN 'PAUSED' WHEN 'signup' THEN 'RESUMED'
                                  WHEN 'error' THEN 'COMPLETED' WHEN 'click' THEN 'CREATED' END AS action FROM events),
o AS (SELECT *, lead(ts) OVER w AS nt, lead(action) OVER w AS na FROM r WINDOW w AS (PARTITION BY u ORDER BY ts, event_id))
SELECT CAST(u AS VARCHAR) AS scheduled_work_id, action AS status_inicio, na AS status_fim, ts AS data_inicio, nt AS data_fim
FROM o WHERE action IN ('STARTED', 'RESUMED') AND na IN ('PAUSED', 'COMPLETED') AND nt IS NOT NULL""")
def v5(spark, d):
    """V5: registries in many documents of one occurrence, one of which holds a third of all events."""
    attrs = lambda op, ev, act, dt: F.struct(op.alias("operator_id"), ev.alias("event_id"), act.alias("action"), dt.alias("date"))
    none = F.lit(None).cast("string")
    inc = F.array(
        F.struct(F.lit("1").alias("id"), F.lit("event").alias("type"), attrs(F.lit("7"), none, none, none).alias("attributes")),
        F.struct(_s("event_id").alias("id"), F.lit("event_registry").alias("type"), attrs(
            none, F.lit("1"), map_code("event_type", ACTION_OF_EVENT, fallback=None), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")).alias("attributes")))
    docs = t(spark, d, "events").select(F.when(F.col("user_id") % 3 == 0, F.lit("0")).otherwise(_s("user_id")).alias("scheduled_work_id"),
                                        F.to_json(F.struct(inc.alias("included"))).alias("data"))
    return maintenance.work_hours(docs, "scheduled_work_id").select("scheduled_work_id", "status_inicio", "status_fim", "data_inicio", "data_fim")


@query("filters_on_changes", """
SELECT 'P2' AS regra, o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
UNION ALL SELECT 'P4', c_custkey FROM customer LEFT JOIN (SELECT DISTINCT o_custkey FROM orders) o ON o_custkey = c_custkey WHERE o_custkey IS NULL
UNION ALL SELECT 'P7', o_orderkey FROM orders WHERE o_orderdate >= DATE '1998-06-01' OR (o_orderstatus = 'P' AND o_orderdate + INTERVAL 30 DAY >= DATE '1998-06-01')
UNION ALL SELECT 'P15a', o_orderkey FROM orders WHERE o_orderdate >= DATE '1996-01-01' AND o_orderdate < DATE '1996-02-01'
UNION ALL SELECT 'P15b', o_orderkey FROM orders WHERE o_orderdate >= DATE '1998-07-01'""")
def filters_on_changes(spark, d):
    o = t(spark, d, "orders")
    seen = o.select("o_custkey").distinct()
    never = where_present(t(spark, d, "customer").join(seen, F.col("o_custkey") == F.col("c_custkey"), "left"), "o_custkey", False)
    later = o.withColumn("b", F.when(F.col("o_orderstatus") == "P", F.col("o_orderdate") + F.expr("interval 30 days")))
    rows = {"P2": where_in(o, "o_orderpriority", ["1-URGENT", "2-HIGH"]), "P4": never.select(F.col("c_custkey").alias("o_orderkey")),
            "P7": since_any(later, ["o_orderdate", "b"], DAY), "P15a": changed_between(o, "o_orderdate", "1996-01-01", "1996-02-01"),
            "P15b": starting_from(o, "o_orderdate", "1998-07-01")}
    out = None
    for name, df in rows.items():
        part = df.select(F.lit(name).alias("regra"), "o_orderkey")
        out = part if out is None else out.unionByName(part)
    return out


# ------------------------------------------------------------------ notes and POS

def notes(spark, d) -> DataFrame:
    """``silver_notes`` of the orders."""
    none = F.lit(None).cast("string")
    return t(spark, d, "orders").select(
        _key44().alias("nota_id"), F.col("o_orderpriority").alias("hotel"), F.date_format("o_orderdate", ISO).alias("dhEmi"),
        _s("o_orderkey").alias("nNF"), F.lit("1").alias("serie"), F.lit("65").alias("mod"), F.lit("1").alias("tpAmb"),
        _s("o_custkey").alias("cnpj_emit"), F.concat(F.lit("E"), _s("o_custkey")).alias("nome_emit"), decimal("o_totalprice").alias("vNF"),
        F.when(F.col("o_orderstatus") != "P", _s("o_orderkey")).alias("nProt"),
        F.when(F.col("o_orderstatus") != "P", F.lit("100")).alias("cStat"),
        F.when(F.col("o_orderstatus") != "P", F.date_format("o_orderdate", ISO)).otherwise(none).alias("dhRecbto"))


def cancels(spark, d) -> DataFrame:
    """``silver_cancels``: two events for each cancelled order that is even, and one for a note that nobody knows."""
    o = t(spark, d, "orders").filter(F.col("o_orderstatus") == "F")
    n = F.explode(F.when(F.col("o_orderkey") % 2 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("n")
    known = o.select("o_orderkey", n).select(
        F.concat(_s("o_orderkey"), F.lit("-"), _s("n")).alias("cancelamento_id"), _key44().alias("chNFe"),
        F.concat(F.lit("1999-01-0"), _s("n"), F.lit("T00:00:00")).alias("dhEvento"), _s("n").alias("nProt"),
        F.concat(F.lit("motivo "), _s("n")).alias("xJust"))
    odd = t(spark, d, "nation").select(F.concat(F.lit("x"), _s("n_nationkey")).alias("cancelamento_id"), F.concat(F.lit("x"), _s("n_nationkey")).alias("chNFe"),
                                       F.lit("1999-01-01T00:00:00").alias("dhEvento"), F.lit("1").alias("nProt"), F.lit("m").alias("xJust"))
    return known.unionByName(odd)


def pos_raw(spark, d) -> DataFrame:
    """POS documents, one per order with customer key not divisible by 3."""
    o = t(spark, d, "orders").filter(F.col("o_custkey") % 3 != 0)
    rec = F.struct(
        F.col("o_orderpriority").alias("hotel"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("Business Date"),
        _s("o_orderkey").alias("FCR Invoice Number"), F.col("o_custkey").alias("Check Number"),
        *[F.when(F.col("o_orderkey") % 5 == 0, decimal("o_totalprice") + 1).otherwise(decimal("o_totalprice")).cast("decimal(12,2)").alias(f"Sub Total {n}")
          for n in (1, 2)],
        F.lit("0.50").alias("Tax Total 1"), F.concat(F.lit("PDV "), (F.col("o_custkey") % 4).cast("string")).alias("Local Revenue Center Name"),
        _s("o_custkey").alias("Invoice Data Info 5"), F.col("o_orderstatus").alias("Invoice Data Info 6"), F.lit(4).alias("Invoice Status"))
    return o.select(_key44().alias("nota_id"), F.to_json(rec).alias("data"))


def pos(spark, d) -> DataFrame:
    return fiscal.fact_pos(pos_raw(spark, d))


POS_SQL = """
WITH pos AS (SELECT lpad(CAST(o_orderkey AS VARCHAR), 44, '0') AS chave_nfe, o_orderpriority AS hotel, CAST(o_orderdate AS DATE) AS data_venda,
                    CAST(o_orderkey AS VARCHAR) AS numero_nota, o_custkey AS numero_comanda,
                    CAST(o_totalprice AS DECIMAL(12,2)) + CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS subtotal_1,
                    'PDV ' || CAST(o_custkey % 4 AS VARCHAR) AS ponto_venda, CAST(o_custkey AS VARCHAR) AS quarto, o_orderstatus AS garcom
             FROM orders WHERE o_custkey % 3 <> 0)
"""
NOTES_SQL = """, notas AS (SELECT lpad(CAST(o_orderkey AS VARCHAR), 44, '0') AS nota_id, o_orderpriority AS hotel, o_orderdate AS dh, o_orderkey AS nnf,
                    CAST(o_totalprice AS DECIMAL(12,2)) AS v, o_orderstatus AS st, o_custkey FROM orders)
"""


@query("v9_pos", POS_SQL + """
SELECT chave_nfe, hotel, data_venda, numero_nota, numero_comanda, CAST(subtotal_1 AS DOUBLE) AS subtotal_1, CAST(subtotal_1 AS DOUBLE) AS subtotal_2,
       CAST(0.5 AS DOUBLE) AS imposto_1, ponto_venda, quarto, garcom, 4 AS status_nota FROM pos""")
def v9(spark, d):
    return pos(spark, d).select("chave_nfe", "hotel", "data_venda", "numero_nota", "numero_comanda", dbl("subtotal_1").alias("subtotal_1"),
                                dbl("subtotal_2").alias("subtotal_2"), dbl("imposto_1").alias("imposto_1"), "ponto_venda", "quarto", "garcom",
                                F.col("status_nota").cast("int").alias("status_nota"))


@query("q7_per_hotel", POS_SQL + """
SELECT 'pos' AS origem, hotel, count(*) AS total FROM pos GROUP BY 2
UNION ALL SELECT 'cancel', o_orderpriority, count(*) FROM orders WHERE o_orderstatus = 'F' GROUP BY 2""")
def q7(spark, d):
    raw = t(spark, d, "orders").filter(F.col("o_orderstatus") == "F").select(
        F.to_json(F.struct(F.col("o_orderpriority").alias("hotel"))).alias("data"))
    return (audits.notes_per_hotel(pos(spark, d)).select(F.lit("pos").alias("origem"), "hotel", "total")
            .unionByName(audits.cancels_per_hotel(raw).select(F.lit("cancel").alias("origem"), "hotel", "total")))


@query("q8_notes_without_pos", POS_SQL + NOTES_SQL + """
SELECT nota_id, hotel, strftime(dh, '%Y-%m-%dT%H:%M:%S') AS data_emissao, CAST(nnf AS VARCHAR) AS numero_nota, CAST(v AS DOUBLE) AS valor
FROM notas WHERE dh >= DATE '1997-01-01' AND nota_id NOT IN (SELECT chave_nfe FROM pos)""")
def q8(spark, d):
    return audits.notes_without_pos(notes(spark, d), pos(spark, d), "1997-01-01").withColumn("valor", dbl("valor"))


@query("q9_pos_overlap", POS_SQL + NOTES_SQL + """
SELECT n.hotel, count(*) AS total_nfe, count(chave_nfe) AS com_pdv, count(*) - count(chave_nfe) AS sem_pdv
FROM notas n LEFT JOIN pos ON chave_nfe = nota_id WHERE dh >= DATE '1996-01-01' GROUP BY 1""")
def q9(spark, d):
    return audits.pos_overlap(notes(spark, d), pos(spark, d), "1996-01-01")


@query("q10_cancels_without_note", "SELECT 'x' || CAST(n_nationkey AS VARCHAR) AS cancelamento_id, 'x' || CAST(n_nationkey AS VARCHAR) AS chave_nota FROM nation")
def q10(spark, d):
    return audits.cancels_without_note(cancels(spark, d), notes(spark, d))


@query("q11_note_xml", "SELECT '<nota>' || CAST(o_totalprice AS VARCHAR) || '</nota>' AS xml_content FROM orders WHERE o_orderkey = (SELECT min(o_orderkey) FROM orders)")
def q11(spark, d):
    o = t(spark, d, "orders")
    first = o.agg(F.min("o_orderkey")).first()[0]
    raw = o.select(_key44().alias("nota_id"), F.to_json(F.struct(F.concat(F.lit("<nota>"), _s("o_totalprice"), F.lit("</nota>")).alias("xml_content"))).alias("data"))
    return audits.note_xml(raw, str(first).zfill(44))


@query("q20_pos_per_day", POS_SQL + """
SELECT hotel, data_venda, count(*) AS qtd_notas, CAST(sum(subtotal_1) AS DOUBLE) AS total_bruto, count(*) AS notas_do_dia FROM pos GROUP BY 1, 2""")
def q20(spark, d):
    p = pos(spark, d)
    cover = audits.pos_coverage(p).withColumnRenamed("qtd_notas", "notas_do_dia")
    return audits.pos_per_day(p).withColumn("total_bruto", dbl("total_bruto")).join(cover, ["hotel", "data_venda"])


@query("q21_sales_per_outlet", POS_SQL + """
SELECT hotel, ponto_venda, CAST(sum(subtotal_1) AS DOUBLE) AS total FROM pos WHERE data_venda = DATE '1996-03-05' GROUP BY 1, 2""")
def q21(spark, d):
    return audits.sales_per_outlet(pos(spark, d), "1996-03-05").withColumn("total", dbl("total"))


@query("q22_notes_of_room", POS_SQL + """
SELECT 'quarto' AS busca, numero_nota, CAST(subtotal_1 AS DOUBLE) AS subtotal_1 FROM pos WHERE quarto = '10'
UNION ALL SELECT 'chave', numero_nota, CAST(subtotal_1 AS DOUBLE) FROM pos WHERE chave_nfe = (SELECT min(chave_nfe) FROM pos)""")
def q22(spark, d):
    p = pos(spark, d)
    first = p.agg(F.min("chave_nfe")).first()[0]
    cols = lambda name: [F.lit(name).alias("busca"), "numero_nota", dbl("subtotal_1").alias("subtotal_1")]
    return audits.notes_of_room(p, "10").select(*cols("quarto")).unionByName(audits.pos_note(p, first).select(*cols("chave")))


@query("j13_reconcile", POS_SQL + NOTES_SQL + """
SELECT nota_id, CAST(v AS DOUBLE) AS vNF, CAST(subtotal_1 AS DOUBLE) AS subtotal_1 FROM notas JOIN pos ON chave_nfe = nota_id""")
def j13(spark, d):
    p = pos(spark, d).select(F.col("chave_nfe").alias("nota_id"), dbl("subtotal_1").alias("subtotal_1"))
    return reconcile(notes(spark, d).select("nota_id", dbl("vNF").alias("vNF")), p, "nota_id")


V10_SQL = POS_SQL + NOTES_SQL + """, lc AS (SELECT lpad(CAST(o_orderkey AS VARCHAR), 44, '0') AS k, CASE WHEN o_orderkey % 2 = 0 THEN 2 ELSE 1 END AS n
             FROM orders WHERE o_orderstatus = 'F'),
f AS (SELECT lpad(CAST(l_orderkey AS VARCHAR), 44, '0') AS k, count(*) AS itens, mode(l_returnflag ORDER BY l_returnflag) AS m0 FROM lineitem GROUP BY 1),
cnt AS (SELECT l_orderkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2),
fa AS (SELECT lpad(CAST(l_orderkey AS VARCHAR), 44, '0') AS k, CAST(sum(n) AS BIGINT) AS itens, min(l_returnflag) FILTER (WHERE rk = 1) AS cfop
       FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY n DESC, l_returnflag) AS rk FROM cnt) GROUP BY 1)
"""


@query("v10_sales_with_pos", V10_SQL + """
SELECT n.nota_id, n.hotel, n.dh AS data_emissao, CAST(n.nnf AS VARCHAR) AS numero_nota, '1' AS serie, '65' AS modelo, CAST(n.v AS DOUBLE) AS valor_total,
       CASE WHEN n.st <> 'P' THEN '100' END AS status_sefaz, CASE WHEN n.st <> 'P' THEN CAST(n.nnf AS VARCHAR) END AS protocolo_autorizacao,
       CASE WHEN n.st <> 'P' THEN n.dh END AS data_recebimento_sefaz, lc.k IS NOT NULL AS cancelada,
       CAST('1999-01-0' || CAST(lc.n AS VARCHAR) AS TIMESTAMP) AS data_cancelamento, 'motivo ' || CAST(lc.n AS VARCHAR) AS justificativa_cancelamento,
       p.chave_nfe IS NOT NULL AS tem_pdv, CAST(p.data_venda AS TIMESTAMP) AS data_venda_pdv, CAST(p.subtotal_1 AS DOUBLE) AS valor_pdv, p.ponto_venda,
       CAST(p.subtotal_1 AS DOUBLE) AS subtotal_1, CAST(p.subtotal_1 AS DOUBLE) AS subtotal_2, CASE WHEN p.chave_nfe IS NOT NULL THEN CAST(0.5 AS DOUBLE) END AS imposto_1,
       p.quarto, p.garcom, fa.k IS NOT NULL AS tem_fiscal, coalesce(fa.itens, 0) AS qtd_itens, fa.cfop AS cfop_principal,
       CASE WHEN lc.k IS NOT NULL THEN 'Cancelada' WHEN n.st <> 'P' THEN 'Autorizada' ELSE 'Pendente SEFAZ' END AS status
FROM notas n LEFT JOIN lc ON lc.k = n.nota_id LEFT JOIN pos p ON p.chave_nfe = n.nota_id LEFT JOIN fa ON fa.k = n.nota_id""")
def v10(spark, d):
    n, p = notes(spark, d), pos(spark, d)
    ledger = t(spark, d, "lineitem").select(_key44("l_orderkey").alias("chave_nfe"), F.col("l_returnflag").alias("cfop"))
    s = fiscal.sales_notes(fiscal.fact_notes(n, cancels(spark, d), p), p, ledger).drop("subtotal_3", "subtotal_6")
    for c in ("data_emissao", "data_recebimento_sefaz", "data_cancelamento", "data_venda_pdv"):
        s = s.withColumn(c, F.col(c).cast("timestamp_ntz"))
    for c in ("valor_total", "valor_pdv", "subtotal_1", "subtotal_2", "imposto_1"):
        s = s.withColumn(c, dbl(c))
    return s


@query("v8_notes_fan_out", V10_SQL + """
SELECT n.nota_id, count(*) AS linhas, count(*) FILTER (WHERE c.n IS NOT NULL) AS cancelamentos FROM notas n
LEFT JOIN (SELECT k, unnest(range(1, n + 1)) AS n FROM lc) c ON c.k = n.nota_id GROUP BY 1""")
def v8_fan_out(spark, d):
    f = fiscal.fact_notes(notes(spark, d), cancels(spark, d), pos(spark, d), fan_out=True)
    return f.groupBy("nota_id").agg(F.count(F.lit(1)).alias("linhas"), F.count("data_cancelamento").alias("cancelamentos"))


# ------------------------------------------------------------------ sales marts

@query("q16_value_gaps", V10_SQL + """
SELECT nota_id, CAST(v AS DOUBLE) AS valor_total, CAST(subtotal_1 AS DOUBLE) AS valor_pdv, CAST(v - subtotal_1 AS DOUBLE) AS diferenca
FROM notas n JOIN pos p ON chave_nfe = nota_id WHERE st = 'O' AND abs(v - subtotal_1) > 0.01""")
def q16(spark, d):
    n, p = notes(spark, d), pos(spark, d)
    ledger = t(spark, d, "lineitem").select(_key44("l_orderkey").alias("chave_nfe"), F.col("l_returnflag").alias("cfop"))
    gaps = audits.value_gaps(fiscal.sales_notes(fiscal.fact_notes(n, cancels(spark, d), p), p, ledger))
    return gaps.select("nota_id", dbl("valor_total").alias("valor_total"), dbl("valor_pdv").alias("valor_pdv"), dbl("diferenca").alias("diferenca"))


@query("q17_pending_per_hotel", SALES_SQL + """
SELECT hotel, count(*) AS pendentes, CAST(sum(valor_total) AS DOUBLE) AS valor_total FROM sales WHERE status = 'Pendente SEFAZ' GROUP BY 1""")
def q17(spark, d):
    return audits.pending_per_hotel(sales(spark, d)).withColumn("valor_total", dbl("valor_total"))


@query("q18_missing_side", SALES_SQL + """
SELECT nota_id, hotel, data_emissao, CAST(valor_total AS DOUBLE) AS valor_total, status, tem_pdv, tem_fiscal FROM sales
WHERE status = 'Autorizada' AND (NOT tem_pdv OR NOT tem_fiscal)""")
def q18(spark, d):
    return audits.missing_side(sales(spark, d)).withColumn("valor_total", dbl("valor_total"))


@query("q19_monthly_revenue", """
SELECT o_orderpriority AS hotel, CAST(date_trunc('month', o_orderdate) AS DATE) AS mes,
       CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(12,2))) FILTER (WHERE o_orderstatus <> 'F'), 0) AS DOUBLE) AS revenue_not_cancelled
FROM orders GROUP BY 1, 2""")
def q19(spark, d):
    return audits.monthly_revenue(fiscal.sales_daily(sales(spark, d))).withColumn("revenue_not_cancelled", dbl("revenue_not_cancelled"))


@query("o2_sort_by_expression", """
SELECT o_orderkey, row_number() OVER (ORDER BY abs(CAST(o_totalprice AS DECIMAL(12,2)) - 100000) DESC, o_orderkey) AS lugar
FROM orders QUALIFY lugar <= 50""")
def o2(spark, d):
    """The order itself: the first 50 by an expression, with their places."""
    o = t(spark, d, "orders").withColumn("x", decimal("o_totalprice"))
    first = sort(o, [F.abs(F.col("x") - 100000).desc(), F.col("o_orderkey").asc()]).limit(50)
    rows = first.agg(F.sort_array(F.collect_list(F.struct((-F.abs(F.col("x") - 100000)).alias("a"), "o_orderkey"))).alias("l"))
    return rows.select(F.posexplode("l").alias("p", "e")).select("e.o_orderkey", (F.col("p") + 1).cast("bigint").alias("lugar"))


@query("q29_limit", SALES_SQL + """
SELECT least(count(*), 500) AS linhas FROM sales WHERE data_emissao >= DATE '1997-08-02' AND data_emissao < DATE '1998-08-03'""")
def q29_limit(spark, d):
    return audits.sales_notes_recent(sales(spark, d), "1998-08-02", 365).agg(F.count(F.lit(1)).alias("linhas"))


# ------------------------------------------------------------------ ledger

def ledger(spark, d) -> DataFrame:
    """V6, with the company id that the typed ledger has."""
    return ledger_fact_full(spark, d).withColumn("fkempresa", F.regexp_extract("empresa", "[0-9]+", 0))


@query("q12_ledger_per_company", """
SELECT 'Empresa ' || CAST(l_suppkey % 5 AS VARCHAR) AS empresa, CAST(l_shipdate AS DATE) AS data_emissao, count(*) AS total,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS valor_total FROM lineitem GROUP BY 1, 2
UNION ALL SELECT 'Empresa ' || CAST(l_suppkey % 5 AS VARCHAR), NULL, count(*), NULL FROM lineitem GROUP BY 1""")
def q12(spark, d):
    x = ledger(spark, d)
    per_day = audits.ledger_per_day(x).select("empresa", "data_emissao", "total", dbl("valor_total").alias("valor_total"))
    return per_day.unionByName(audits.ledger_per_company(x), allowMissingColumns=True)


@query("q13_ledger_period", """
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS lancamento_id,
       'Empresa ' || CAST(l_suppkey % 5 AS VARCHAR) AS empresa, CAST(l_shipdate AS DATE) AS data_emissao, CAST(l_orderkey AS VARCHAR) AS numero, '1' AS serie,
       'NFCE' AS tipo, l_returnflag AS cfop, CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DOUBLE) AS valor_total
FROM lineitem WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-01-31'""")
def q13(spark, d):
    return audits.ledger_period(ledger(spark, d), "1996-01-01", "1996-01-31").withColumn("valor_total", dbl("valor_total"))


@query("q14_best_products", """
SELECT CAST(l_partkey AS VARCHAR) AS codigo, 'P' || CAST(l_partkey AS VARCHAR) AS descricao, count(*) AS ocorrencias,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS valor_total FROM lineitem GROUP BY 1, 2""")
def q14(spark, d):
    return audits.best_products(ledger(spark, d)).withColumn("valor_total", dbl("valor_total"))


@query("q28_counts", "\nUNION ALL\n".join(f"SELECT '{n}' AS tabela, count(*) AS registros FROM {n}" for n in TABLES) + """
UNION ALL SELECT 'documentos', count(DISTINCT (l_orderkey, l_suppkey % 5)) FROM lineitem""")
def q28(spark, d):
    distinct = audits.distinct_documents(ledger(spark, d)).select(F.lit("documentos").alias("tabela"), F.col("distinct_docs").alias("registros"))
    return audits.raw_counts({n: t(spark, d, n) for n in TABLES}).unionByName(distinct)


@query("v6b_composite_only", """
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS lancamento_id,
       CASE WHEN o_orderkey IS NOT NULL THEN lpad(CAST(o_orderkey AS VARCHAR), 44, '0') END AS chave_nfe
FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey AND o_orderstatus = l_linestatus""")
def v6b(spark, d):
    li = t(spark, d, "lineitem")
    none = F.lit(None).cast("string")
    names = [n for n, _, _ in fiscal.LEDGER_SPEC]
    have = {"numero_documento": _s("l_orderkey"), "serie": F.lit("1"), "hotel": F.col("l_linestatus"), "chave_sefaz_raw": _key44("l_partkey")}
    raw = li.select(F.concat_ws("-", _s("l_orderkey"), _s("l_linenumber"), _s("l_partkey"), _s("l_suppkey")).alias("lancamento_id"),
                    have["hotel"].alias("hotel"), *[have.get(n, none).alias(n) for n in names])
    n = notes(spark, d).drop("hotel").join(t(spark, d, "orders").select(_key44().alias("nota_id"), F.col("o_orderstatus").alias("hotel")), "nota_id")
    return fiscal.fact_ledger(raw, n, cancels(spark, d), direct=False).select("lancamento_id", "chave_nfe")


# ------------------------------------------------------------------ line items

def item_docs(spark, d) -> DataFrame:
    """Line items as documents: order type = return flag (R internal consumption), location = segment of the ship day."""
    li = t(spark, d, "lineitem")
    rec = F.struct(
        F.concat(F.lit("H"), F.col("l_linestatus")).alias("hotel"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("businessDate"),
        map_code("l_returnflag", {"R": audits.INTERNAL}).alias("orderTypeName"), F.col("l_orderkey").alias("guestCheckID"),
        F.col("l_linenumber").alias("lineNum"), F.concat(F.lit("P"), _s("l_partkey")).alias("menuItemName1"),
        F.concat(F.lit("G"), (F.col("l_partkey") % 7).cast("string")).alias("majorGroupName"), F.col("l_quantity").cast("int").alias("numerator"),
        F.col("l_quantity").cast("int").alias("lineCount"), decimal("l_extendedprice").cast("string").alias("lineTotal"),
        (F.col("l_linenumber") == 7).cast("int").alias("isVoidFlag"), F.concat(F.lit("Loc "), "l_linestatus").alias("locationName"),
        F.lit(3).alias("revenueCenterNum"), F.col("l_partkey").cast("int").alias("menuItemNum"),
        F.lit("Ana").alias("transactionEmployeeFirstName"), F.when(F.col("l_linenumber") > 1, F.col("l_returnflag")).alias("transactionEmployeeLastName"))
    return li.select(F.concat_ws("-", _s("l_orderkey"), _s("l_linenumber"), _s("l_partkey"), _s("l_suppkey")).alias("line_item_id"), F.to_json(rec).alias("data"))


ITEMS_SQL = """
WITH it AS (SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS line_item_id,
    'H' || l_linestatus AS hotel, strftime(l_shipdate, '%Y-%m-%d') AS data, CASE l_returnflag WHEN 'R' THEN 'Consumo Interno' ELSE l_returnflag END AS tipo,
    l_orderkey AS comanda_id, l_linenumber AS numero_linha, 'P' || CAST(l_partkey AS VARCHAR) AS produto, 'G' || CAST(l_partkey % 7 AS VARCHAR) AS grupo,
    CAST(l_quantity AS INTEGER) AS quantidade, CAST(l_extendedprice AS DECIMAL(12,2)) AS valor, l_linenumber = 7 AS void,
    'Loc ' || l_linestatus AS location_name, l_returnflag FROM lineitem)
"""


@query("v12_line_items", ITEMS_SQL + """
SELECT line_item_id, data AS data_negocio, location_name AS hotel, hotel AS hotel_codigo, comanda_id, quantidade, CAST(valor AS DOUBLE) AS valor_total,
       CASE WHEN quantidade > 0 THEN (2 * CAST(valor * 100 AS BIGINT) + quantidade) // (2 * quantidade) ELSE 0 END AS centavos,
       CASE WHEN numero_linha > 1 THEN 'Ana ' || l_returnflag END AS colaborador, void AS cancelado FROM it""")
def v12(spark, d):
    return line_items.fact_line_items(item_docs(spark, d)).select(
        "line_item_id", "data_negocio", "hotel", "hotel_codigo", "comanda_id", "quantidade", dbl("valor_total").alias("valor_total"),
        (F.round("valor_unitario", 2) * 100).cast("bigint").alias("centavos"), "colaborador", "cancelado")


def audit_items(spark, d) -> DataFrame:
    return audits.items(item_docs(spark, d))


@query("q23_items_per_day", ITEMS_SQL + "SELECT hotel, data, count(*) AS total_items FROM it GROUP BY 1, 2")
def q23(spark, d):
    return audits.items_per_day(audit_items(spark, d))


@query("q24_internal_per_day", ITEMS_SQL + """
SELECT hotel, data, count(DISTINCT comanda_id) AS comandas, count(*) AS itens, CAST(sum(valor) AS DOUBLE) AS valor_total
FROM it WHERE tipo = 'Consumo Interno' GROUP BY 1, 2""")
def q24(spark, d):
    return audits.internal_per_day(audit_items(spark, d)).withColumn("valor_total", dbl("valor_total"))


@query("q25_items_of_check", ITEMS_SQL + """
SELECT produto, quantidade, CAST(valor AS DOUBLE) AS valor FROM it WHERE comanda_id = (SELECT min(l_orderkey) FROM lineitem)""")
def q25(spark, d):
    first = t(spark, d, "lineitem").agg(F.min("l_orderkey")).first()[0]
    return audits.items_of_check(audit_items(spark, d), first).withColumn("valor", dbl("valor"))


@query("q26_volume_per_order_type", ITEMS_SQL + """
SELECT tipo, hotel, count(*) AS itens, count(DISTINCT comanda_id) AS comandas, CAST(sum(valor) AS DOUBLE) AS valor_total
FROM it WHERE data = '1996-06-01' GROUP BY 1, 2""")
def q26(spark, d):
    return audits.volume_per_order_type(audit_items(spark, d), "1996-06-01").withColumn("valor_total", dbl("valor_total"))


@query("q27_top_items", ITEMS_SQL + """
SELECT produto, grupo, count(*) AS ocorrencias, CAST(sum(quantidade) AS DOUBLE) AS qtd_total, CAST(sum(valor) AS DOUBLE) AS valor_total
FROM it WHERE data = '1996-06-01' AND hotel = 'HO' AND NOT void GROUP BY 1, 2 ORDER BY sum(valor) DESC, produto, grupo LIMIT 20""")
def q27(spark, d):
    return audits.top_items(audit_items(spark, d), "1996-06-01", "HO").withColumns(
        {"qtd_total": dbl("qtd_total"), "valor_total": dbl("valor_total")})


@query("q30_internal_items", ITEMS_SQL + """
SELECT line_item_id, location_name, comanda_id, numero_linha, CAST(valor AS DOUBLE) AS valor FROM it
WHERE data = '1994-06-01' AND tipo = 'Consumo Interno' AND valor <> 0 AND location_name = 'Loc F'""")
def q30(spark, d):
    return audits.internal_items(audit_items(spark, d), "1994-06-01", "Loc F").select(
        "line_item_id", "location_name", "comanda_id", "numero_linha", dbl("valor").alias("valor"))


# ------------------------------------------------------------------ rejects, arrival, casts

def _files(df, value, name) -> DataFrame:
    return df.select(value.alias("value"), F.lit("x").alias("file_path"), name.alias("file_name"))


@query("rejects_by_reason", """
SELECT 'paginas' AS fonte, 'not JSON' AS erro, count(*) AS arquivos FROM orders WHERE o_orderstatus = 'P'
UNION ALL SELECT 'paginas', 'no array at $.data', count(*) FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT 'pos', 'not JSON', count(*) FROM orders WHERE o_orderstatus = 'P'
UNION ALL SELECT 'pos', 'no array at $[2]', count(*) FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT 'array', 'not JSON', count(*) FROM orders WHERE o_orderstatus = 'P'
UNION ALL SELECT 'array', 'no array at $', count(*) FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT 'detalhe', 'envelope without data', count(*) FROM orders
UNION ALL SELECT 'xml', 'invalid XML', count(*) FROM orders WHERE o_orderstatus = 'P'
UNION ALL SELECT 'xml', 'infNFe not found', count(*) FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT 'xml', 'invalid key', count(*) FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT 'cancel', 'invalid XML', count(*) FROM orders WHERE o_orderstatus = 'P'
UNION ALL SELECT 'cancel', 'evento not found', count(*) FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT 'cancel', 'infEvento not found', count(*) FROM orders WHERE o_orderstatus = 'F'""")
def rejects_by_reason(spark, d):
    """Every file is bad, but for those without records (status F of the JSON shapes)."""
    o, st = t(spark, d, "orders"), F.col("o_orderstatus")
    by = lambda p, other, f: F.when(st == "P", F.lit(p)).when(st == "O", F.lit(other)).otherwise(F.lit(f))
    name = F.concat(_s("o_orderkey"), F.lit(".x"))
    empty = '{"data": [], "meta": {"pagination": {"total_pages": 1}}}'
    found = {
        "paginas": rejects(parse_paged_envelopes(_files(o, by("{", '{"data": 1}', empty), name), errors=True)),
        "pos": rejects(parse_sectioned_json(_files(o, by('[[{"', '[[{}],[{}],{}]', "[[{}]]"), name), {}, errors=True)),
        "array": rejects(parse_json_array(_files(o, by("[1", "{}", "[]"), name), errors=True)),
        "detalhe": parse_detail_envelopes(_files(o, by("{", '{"data": {}}', '{"errors": []}'), name))[1],
        "xml": parse_note_xml(_files(o, by("<a", "<nfeProc><x/></nfeProc>", '<NFe><infNFe Id="NFe1"><ide><mod>65</mod></ide></infNFe></NFe>'), name))[1],
        "cancel": parse_cancel_xml(_files(o, by("<a", "<envEvento><x/></envEvento>", "<envEvento><evento><x/></evento></envEvento>"), name))[1],
    }
    out = None
    for source, df in found.items():
        part = df.groupBy(F.col("error").alias("erro")).agg(F.count(F.lit(1)).alias("arquivos")).select(F.lit(source).alias("fonte"), "erro", "arquivos")
        out = part if out is None else out.unionByName(part)
    return out


@query("last_arrival", """
SELECT lpad(CAST(o_orderkey AS VARCHAR), 44, '0') AS nota_id, CAST(10 + o_orderkey % 7 AS DOUBLE) AS subtotal_1 FROM orders""")
def last_arrival(spark, d):
    """K1/K2: two files of two days for each key; the later day wins, though its document sorts first."""
    from tidewater.sinks.tables import dedupe_last
    o = t(spark, d, "orders")
    def day(date, value):
        doc = F.concat(F.lit('[[{"Store Number":"S"}],[{}],[{"Invoice Data Info 8":"'), _key44(), F.lit('","Sub Total 1":'), value.cast("string"), F.lit("}]]"))
        return _files(o, doc, F.concat(F.lit(f"pos_{date}_"), _s("o_orderkey"), F.lit(".json")))
    files = day("2026-03-02", 10 + F.col("o_orderkey") % 7).unionByName(day("2026-03-01", F.lit(90)))
    rows = dedupe_last(parse_sectioned_json(files, {}).select(F.col("key").alias("nota_id"), "data", "arrival"), "nota_id", "arrival")
    return rows.select("nota_id", F.try_variant_get("data", "$['Sub Total 1']", "double").alias("subtotal_1"))


@query("page_completeness", """
SELECT CAST(o_orderdate AS DATE) AS dia, count(DISTINCT o_orderkey % 4) AS vistas, 4 AS anunciadas FROM orders GROUP BY 1""")
def page_completeness_q(spark, d):
    """Pages 0-3 of one list per day, some of which never landed."""
    o = t(spark, d, "orders")
    page = F.concat(F.lit('{"data":[{"id":"'), _s("o_orderkey"), F.lit('"}],"meta":{"pagination":{"total_pages":4,"current_page":'),
                    (F.col("o_orderkey") % 4).cast("string"), F.lit("}}}"))
    files = _files(o, page, F.concat(F.lit("list_"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("_"), _s("o_orderkey"), F.lit(".json")))
    return page_completeness(parse_paged_envelopes(files, errors=True)).select(
        F.col("day").alias("dia"), F.col("pages_seen").alias("vistas"), F.col("total_pages").alias("anunciadas"))


DAY_COLUMNS_HERE = {"v9_pos": ["data_venda"], "q20_pos_per_day": ["data_venda"], "q19_monthly_revenue": ["mes"],
                    "q12_ledger_per_company": ["data_emissao"], "q13_ledger_period": ["data_emissao"], "page_completeness": ["dia"]}
for _name, _cols in DAY_COLUMNS_HERE.items():
    _days_as_timestamps(_name, _cols)
DAY_COLUMNS.update(DAY_COLUMNS_HERE)

COVERS.update({
    "q1_occurrences_without_detail": "Q1 J9 P7", "q2_tickets_without_detail": "Q2", "q3_plans_without_detail": "Q3", "q4_ids_by_state": "Q4 P1",
    "q5_hours_per_operator": "Q5", "q6_completed_per_hotel": "Q6", "v1_operators": "V1", "v5_occurrence_hours": "V5 W1",
    "filters_on_changes": "P2 P4 P7 P15", "v9_pos": "V9", "q7_per_hotel": "Q7", "q8_notes_without_pos": "Q8", "q9_pos_overlap": "Q9",
    "q10_cancels_without_note": "Q10", "q11_note_xml": "Q11", "q20_pos_per_day": "Q20", "q21_sales_per_outlet": "Q21", "q22_notes_of_room": "Q22",
    "j13_reconcile": "J13", "v10_sales_with_pos": "V10 V8", "v8_notes_fan_out": "V8", "q16_value_gaps": "Q16 O2", "q17_pending_per_hotel": "Q17",
    "q18_missing_side": "Q18", "q19_monthly_revenue": "Q19", "o2_sort_by_expression": "O2", "q29_limit": "Q29 O4", "q12_ledger_per_company": "Q12",
    "q13_ledger_period": "Q13", "q14_best_products": "Q14", "q28_counts": "Q28", "v6b_composite_only": "V6b", "v12_line_items": "V12",
    "q23_items_per_day": "Q23", "q24_internal_per_day": "Q24", "q25_items_of_check": "Q25", "q26_volume_per_order_type": "Q26",
    "q27_top_items": "Q27", "q30_internal_items": "Q30 P12", "rejects_by_reason": "S1 S2 S3 S5 S6 S7", "last_arrival": "K1 K2 S3",
    "page_completeness": "S1",
})
