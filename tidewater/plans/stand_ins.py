"""The operators of SURVEY §2 run on the driver's tables.

Stand-ins: order = tax note; line item = ledger item; order status F/O/P =
cancelled / authorised / pending; events = state registries; customer
segment or order priority = site. Every query reads whole tables.

Output conventions, shared with the DuckDB oracles in ``ORACLE`` so that
both engines give the same Arrow types and pandas values: money is summed as
exact DECIMAL(12,2) and cast to DOUBLE once at the end; hours come from an
exact microsecond count; integers that can be NULL leave as DOUBLE; day
columns leave as midnight TIMESTAMPs (``DAY_COLUMNS``). ``COVERS`` names the
SURVEY §2 ids each query runs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions import (
    blank_to_null, decimal, differs, first_where, full_name, hotel_of, instant, is_one,
    iso_date, map_code, micros_between, month_of, present, project, slice_text, text_to_utc, unit_price,
)
from tidewater.functions.arrays import explode_type
from tidewater.operators import (
    bounds, by_key, calendar, count_distinct_tuple, coverage, date_chunks, filter_sales, gone, in_period,
    last_days, lookback, mart, match_inner, missing_any, missing_days, missing_detail, nest,
    not_future, one_per_key, prefer, resolve, since, sort, sum_decimal, table_counts, top, where_if,
    where_nonzero, where_path, with_exists, without,
)
from tidewater.operators.joins import left_lookup
from tidewater.plans.fiscal import fact_notes, sales_daily, sales_notes
from tidewater.plans.maintenance import with_plan
from tidewater.plans.measures import measures as measure_table
from tidewater.sinks.export import export_documents, sale_record, with_config
from tidewater.sinks.tables import dedupe_last, soft_delete, upsert
from tidewater.sources.documents import (
    ids_from_text, parse_cancel_xml, parse_nested_array_json, parse_note_xml, parse_sectioned_json,
)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


def dbl(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


# ------------------------------------------------------------------ shared

def sales(spark, d) -> DataFrame:
    """V10 over the stand-ins: notes = orders, POS = line items with status O,
    ledger = line items (CFOP = return flag)."""
    o, li = t(spark, d, "orders"), t(spark, d, "lineitem")
    notes = o.select(
        F.col("o_orderkey").alias("nota_id"), F.col("o_orderpriority").alias("hotel"),
        F.col("o_orderdate").alias("data_emissao"), decimal("o_totalprice").alias("valor_total"),
        (F.col("o_orderstatus") == "F").alias("cancelada"),
        F.when(F.col("o_orderstatus").isin("O", "F"), F.lit("100")).otherwise(F.lit("105")).alias("status_sefaz"))
    notes = with_exists(notes, li.filter(F.col("l_linestatus") == "O"), "nota_id", "l_orderkey", "tem_pdv", grows=True)
    ledger = li.select(F.col("l_orderkey").alias("chave_nfe"), F.col("l_returnflag").alias("cfop"))
    return sales_notes(notes, None, ledger)


SALES_SQL = """
WITH pos AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_linestatus = 'O'),
cnt AS (SELECT l_orderkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2),
fa AS (SELECT l_orderkey, CAST(sum(n) AS BIGINT) AS qtd_itens,
              min(l_returnflag) FILTER (WHERE rk = 1) AS cfop_principal
       FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY n DESC, l_returnflag) AS rk FROM cnt)
       GROUP BY 1),
sales AS (
  SELECT o.o_orderkey AS nota_id, o.o_orderpriority AS hotel, o.o_orderdate AS data_emissao,
         CAST(o.o_totalprice AS DECIMAL(12,2)) AS valor_total, o.o_orderstatus = 'F' AS cancelada,
         pos.l_orderkey IS NOT NULL AS tem_pdv, fa.l_orderkey IS NOT NULL AS tem_fiscal,
         COALESCE(fa.qtd_itens, 0) AS qtd_itens, fa.cfop_principal,
         CASE WHEN o.o_orderstatus = 'F' THEN 'Cancelada'
              WHEN o.o_orderstatus IN ('O', 'F') THEN 'Autorizada' ELSE 'Pendente SEFAZ' END AS status
  FROM orders o LEFT JOIN pos ON pos.l_orderkey = o.o_orderkey LEFT JOIN fa ON fa.l_orderkey = o.o_orderkey)
"""


# ------------------------------------------------------------------ marts

@query("daily_mart", SALES_SQL + """
SELECT hotel, CAST(data_emissao AS DATE) AS data, count(*) AS total_notas,
       count(*) FILTER (WHERE status = 'Autorizada') AS notas_autorizadas,
       count(*) FILTER (WHERE status = 'Cancelada') AS notas_canceladas,
       count(*) FILTER (WHERE status = 'Pendente SEFAZ') AS notas_pendentes,
       CAST(COALESCE(SUM(valor_total) FILTER (WHERE status <> 'Cancelada'), 0) AS DOUBLE) AS valor_total_dia,
       count(*) FILTER (WHERE tem_pdv) AS notas_com_pdv, count(*) FILTER (WHERE tem_fiscal) AS notas_com_fiscal
FROM sales WHERE data_emissao IS NOT NULL GROUP BY 1, 2""")
def daily_mart(spark, d):
    return sales_daily(sales(spark, d)).withColumn("valor_total_dia", dbl("valor_total_dia"))


@query("sales_status", SALES_SQL + """
SELECT nota_id, hotel, data_emissao, CAST(valor_total AS DOUBLE) AS valor_total, cancelada, tem_pdv,
       tem_fiscal, qtd_itens, cfop_principal, status FROM sales""")
def sales_status(spark, d):
    return sales(spark, d).select("nota_id", "hotel", "data_emissao", dbl("valor_total").alias("valor_total"),
                                  "cancelada", "tem_pdv", "tem_fiscal", "qtd_itens", "cfop_principal", "status")


@query("missing_side", SALES_SQL + """
SELECT nota_id, tem_pdv, tem_fiscal FROM sales
WHERE status = 'Autorizada' AND (NOT tem_pdv OR NOT tem_fiscal)""")
def missing_side(spark, d):
    s = sales(spark, d).filter(F.col("status") == "Autorizada")
    return missing_any(s, ["tem_pdv", "tem_fiscal"]).select("nota_id", "tem_pdv", "tem_fiscal")


@query("measures", SALES_SQL + """
SELECT hotel,
       CAST(SUM(valor_total) FILTER (WHERE status <> 'Cancelada') AS DOUBLE) AS faturamento_total,
       count(*) FILTER (WHERE status = 'Autorizada') AS notas_autorizadas,
       count(*) FILTER (WHERE status = 'Cancelada') AS notas_canceladas,
       count(*) FILTER (WHERE status = 'Pendente SEFAZ') AS pendentes_sefaz,
       count(*) FILTER (WHERE status = 'Autorizada' AND NOT tem_fiscal) AS nfe_sem_fiscal,
       count(*) FILTER (WHERE status = 'Autorizada' AND NOT tem_pdv) AS nfe_sem_pdv
FROM sales GROUP BY 1""")
def measures(spark, d):
    return measure_table(sales(spark, d), ["hotel"]).withColumn("faturamento_total", dbl("faturamento_total"))


@query("monthly_revenue", """
SELECT o_orderpriority AS hotel, CAST(date_trunc('month', o_orderdate) AS DATE) AS mes,
       CAST(COALESCE(SUM(CAST(o_totalprice AS DECIMAL(12,2))) FILTER (WHERE o_orderstatus <> 'F'), 0) AS DOUBLE)
         AS faturamento_nao_cancelado
FROM orders GROUP BY 1, 2""")
def monthly_revenue(spark, d):
    daily = sales_daily(sales(spark, d))
    return (daily.groupBy("hotel", month_of("data").alias("mes"))
                 .agg(dbl(F.sum("valor_total_dia")).alias("faturamento_nao_cancelado")))


@query("counts_by_group", """
SELECT o_orderpriority, o_orderstatus, CAST(o_orderdate AS DATE) AS dia, count(*) AS notas,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS valor
FROM orders GROUP BY 1, 2, 3""")
def counts_by_group(spark, d):
    return mart(t(spark, d, "orders"), ["o_orderpriority", "o_orderstatus", F.to_date("o_orderdate").alias("dia")],
                {"notas": F.count(F.lit(1)), "valor": dbl(sum_decimal("o_totalprice"))})


@query("ledger_by_day", """
SELECT CAST(l_shipdate AS DATE) AS dia, l_returnflag, count(*) AS itens,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS valor
FROM lineitem GROUP BY 1, 2""")
def ledger_by_day(spark, d):
    return mart(t(spark, d, "lineitem"), [F.to_date("l_shipdate").alias("dia"), "l_returnflag"],
                {"itens": F.count(F.lit(1)), "valor": dbl(sum_decimal("l_extendedprice"))})


@query("checks_items_value", """
SELECT l_returnflag, l_linestatus, count(DISTINCT l_orderkey) AS comandas, count(*) AS itens,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS valor
FROM lineitem GROUP BY 1, 2""")
def checks_items_value(spark, d):
    return mart(t(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"],
                {"comandas": F.count_distinct("l_orderkey"), "itens": F.count(F.lit(1)),
                 "valor": dbl(sum_decimal("l_extendedprice"))})


@query("overlap", """
SELECT o_orderpriority, count(*) AS total, count(p.l_orderkey) AS com_pdv,
       count(*) - count(p.l_orderkey) AS sem_pdv
FROM orders o LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_linestatus = 'O') p
  ON p.l_orderkey = o.o_orderkey
GROUP BY 1""")
def overlap(spark, d):
    li = t(spark, d, "lineitem").filter(F.col("l_linestatus") == "O")
    return coverage(t(spark, d, "orders"), li, "o_orderkey", ["o_orderpriority"], right_key="l_orderkey",
                    names=("total", "com_pdv", "sem_pdv"))


@query("distinct_tuple", """
SELECT count(*) AS linhas, count(DISTINCT (l_orderkey, l_linenumber, l_partkey)) AS documentos_distintos
FROM lineitem""")
def distinct_tuple(spark, d):
    return t(spark, d, "lineitem").agg(
        F.count(F.lit(1)).alias("linhas"),
        count_distinct_tuple("l_orderkey", "l_linenumber", "l_partkey").alias("documentos_distintos"))


@query("table_counts", "\nUNION ALL\n".join(
    f"SELECT '{n}' AS tabela, count(*) AS registros FROM {n}" for n in TABLES))
def table_counts_q(spark, d):
    return table_counts({n: t(spark, d, n) for n in TABLES})


@query("top_products", """
SELECT l_partkey AS p_partkey, p_name, CAST(v AS DOUBLE) AS valor, itens
FROM (SELECT l_partkey, SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS v, count(*) AS itens
      FROM lineitem GROUP BY 1) a JOIN part ON p_partkey = l_partkey
ORDER BY v DESC, l_partkey LIMIT 20""")
def top_products(spark, d):
    per_part = t(spark, d, "lineitem").groupBy("l_partkey").agg(
        sum_decimal("l_extendedprice").alias("v"), F.count(F.lit(1)).alias("itens"))
    best = top(per_part, 20, ["-v", "l_partkey"])
    return (best.join(t(spark, d, "part"), F.col("p_partkey") == F.col("l_partkey"))
                .select("p_partkey", "p_name", dbl("v").alias("valor"), "itens"))


# ------------------------------------------------------------------ JSON

@query("json_projection", """
SELECT event_id, user_id, event_type, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""")
def json_projection(spark, d):
    return project(t(spark, d, "events"), "props", [("k", "k", "integer")],
                   keep=["event_id", "user_id", "event_type"])


CUSTOMER_SPEC = [("c_name", "attributes.name", "text"), ("c_nationkey", "attributes.nation", "integer"),
                 ("c_acctbal", "attributes.balance", "double"), ("c_mktsegment", "attributes.segment", "text")]


@query("json_roundtrip", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def json_roundtrip(spark, d):
    c = t(spark, d, "customer")
    docs = c.select("c_custkey", F.to_json(F.struct(
        F.col("c_custkey").cast("string").alias("id"), F.lit("customer").alias("type"),
        F.struct(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"),
                 F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")).alias("attributes")))
                    .alias("data"))
    return project(docs, "data", CUSTOMER_SPEC, keep=["c_custkey"])


# ------------------------------------------------------------------ arrays

def order_documents(spark, d) -> DataFrame:
    """Line items nested per order."""
    return nest(t(spark, d, "lineitem"), by=["l_orderkey"],
                fields=["l_linenumber", "l_partkey", "l_suppkey", "l_returnflag"],
                order=["l_linenumber", "l_partkey", "l_suppkey"], name="items")


@query("first_in_array", """
WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
                  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS rn
           FROM lineitem WHERE l_returnflag = 'R')
SELECT o.o_orderkey, CAST(r.l_linenumber AS DOUBLE) AS first_line, CAST(r.l_partkey AS DOUBLE) AS first_part,
       CAST(r.l_suppkey AS DOUBLE) AS first_supp
FROM orders o LEFT JOIN r ON r.l_orderkey = o.o_orderkey AND r.rn = 1""")
def first_in_array(spark, d):
    docs = order_documents(spark, d)
    first = docs.select("l_orderkey", first_where("items", lambda x: x["l_returnflag"] == "R").alias("f"))
    o = t(spark, d, "orders").select("o_orderkey")
    # nullable integers leave as DOUBLE in both engines (pandas renders them alike)
    return left_lookup(o, first, "o_orderkey", "l_orderkey", ["f"], grows=True).select(
        "o_orderkey", dbl("f.l_linenumber").alias("first_line"), dbl("f.l_partkey").alias("first_part"),
        dbl("f.l_suppkey").alias("first_supp"))


@query("explode_filter", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R'""")
def explode_filter(spark, d):
    e = explode_type(order_documents(spark, d), "items", ["R"], keep=["l_orderkey"], type_field="l_returnflag")
    return e.select("l_orderkey", "val.l_linenumber", "val.l_partkey", "val.l_suppkey")


# ------------------------------------------------------------------ intervals

INTERVALS_SQL = """
WITH o AS (SELECT user_id, event_type, ts,
                  lead(ts) OVER w AS next_ts, lead(event_type) OVER w AS next_type
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
iv AS (SELECT user_id, user_id AS operator_id, event_type AS status_inicio, next_type AS status_fim,
              ts AS data_inicio, next_ts AS data_fim, epoch_us(next_ts) - epoch_us(ts) AS duracao_us
       FROM o WHERE event_type IN ('view', 'signup') AND next_type IN ('purchase', 'error')
         AND next_ts IS NOT NULL)
"""


def intervals(spark, d) -> DataFrame:
    from tidewater.operators.windows import work_intervals
    ev = t(spark, d, "events")
    reg = ev.select("user_id", F.lit(0).cast("bigint").alias("evt"), "ts", "event_id", "event_type",
                    F.col("user_id").alias("owner"))
    w = work_intervals(reg, parent="user_id", event="evt", time="ts", seq="event_id", action="event_type",
                       owner="owner", starts=("view", "signup"), ends=("purchase", "error"))
    return w.withColumn("duracao_us", micros_between("data_inicio", "data_fim"))


@query("work_intervals", INTERVALS_SQL + """
SELECT user_id, operator_id, status_inicio, status_fim, data_inicio, data_fim, duracao_us,
       duracao_us / CAST(3600000000 AS DOUBLE) AS horas_decimais FROM iv""")
def work_intervals_q(spark, d):
    return intervals(spark, d).select("user_id", "operator_id", "status_inicio", "status_fim", "data_inicio",
                                      "data_fim", "duracao_us", "horas_decimais")


@query("hours_per_operator", INTERVALS_SQL + """
SELECT operator_id, count(*) AS intervalos, CAST(SUM(duracao_us) AS DOUBLE) / 3600000000.0 AS total_horas
FROM iv GROUP BY 1""")
def hours_per_operator(spark, d):
    return (intervals(spark, d).groupBy("operator_id")
            .agg(F.count(F.lit(1)).alias("intervalos"),
                 (F.sum("duracao_us").cast("double") / F.lit(3.6e9)).alias("total_horas")))


# ------------------------------------------------------------------ joins

@query("prefer_detail", """
SELECT l_orderkey AS o_orderkey, 'detail' AS origem, CAST(count(*) AS DOUBLE) AS n_itens FROM lineitem GROUP BY 1
UNION ALL
SELECT o_orderkey, 'bulk' AS origem, CAST(NULL AS DOUBLE) AS n_itens FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""")
def prefer_detail(spark, d):
    details = (t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"))
               .agg(dbl(F.count(F.lit(1))).alias("n_itens")).select("o_orderkey", F.lit("detail").alias("origem"), "n_itens"))
    bulk = t(spark, d, "orders").select("o_orderkey", F.lit("bulk").alias("origem"),
                                        F.lit(None).cast("double").alias("n_itens"))
    return prefer(details, bulk, "o_orderkey")


SITE_RULES = [("supplier#00000001", "DEZ"), ("SUPPLIER#00000002", "VINTE")]


@query("location_to_hotel", """
SELECT s_suppkey, CASE WHEN s_name ILIKE 'supplier#00000001%' THEN 'DEZ'
                       WHEN s_name ILIKE 'SUPPLIER#00000002%' THEN 'VINTE'
                       ELSE trim(split_part(COALESCE(NULL, s_name), '#', 1)) END AS hotel
FROM supplier""")
def location_to_hotel(spark, d):
    s = t(spark, d, "supplier")
    return s.select("s_suppkey", hotel_of("s_name", [F.lit(None).cast("string"), "s_name"], SITE_RULES, sep="#")
                    .alias("hotel"))


# Fixed values of the stand-in: event type -> customer segment.
SEGMENT_OF_EVENT = {"view": "BUILDING", "click": "AUTOMOBILE", "purchase": "MACHINERY",
                    "signup": "HOUSEHOLD", "error": "FURNITURE"}


@query("resolve_two_stage", """
WITH e AS (SELECT event_id, user_id,
                  NULLIF(CASE WHEN event_type IN ('purchase', 'signup') THEN CAST(user_id AS VARCHAR) ELSE '' END, '') AS chave,
                  CAST(user_id // 6 AS INTEGER) AS nation,
                  CASE event_type WHEN 'view' THEN 'BUILDING' WHEN 'click' THEN 'AUTOMOBILE'
                       WHEN 'purchase' THEN 'MACHINERY' WHEN 'signup' THEN 'HOUSEHOLD'
                       WHEN 'error' THEN 'FURNITURE' END AS segment FROM events),
d AS (SELECT CAST(c_custkey AS VARCHAR) AS ckey, c_custkey, c_name FROM customer),
c AS (SELECT c_nationkey, c_mktsegment, c_custkey, c_name,
             row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY c_custkey) AS rn FROM customer)
SELECT e.event_id, e.user_id, CAST(COALESCE(d.c_custkey, c.c_custkey) AS DOUBLE) AS c_custkey,
       COALESCE(d.c_name, c.c_name) AS c_name,
       CASE WHEN d.c_custkey IS NOT NULL THEN 'direct' WHEN c.c_custkey IS NOT NULL THEN 'composite' END AS via
FROM e LEFT JOIN d ON d.ckey = e.chave
LEFT JOIN c ON d.c_custkey IS NULL AND c.rn = 1 AND c.c_nationkey = e.nation AND c.c_mktsegment = e.segment""")
def resolve_two_stage(spark, d):
    ev = t(spark, d, "events").select(
        "event_id", "user_id",
        blank_to_null(F.when(F.col("event_type").isin("purchase", "signup"), F.col("user_id").cast("string"))
                      .otherwise(F.lit(""))).alias("chave"),
        F.floor(F.col("user_id") / 6).cast("int").alias("nation"),
        map_code("event_type", SEGMENT_OF_EVENT, fallback=None).alias("segment"))
    cust = t(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("ckey"), "c_custkey", "c_name",
                                          "c_nationkey", "c_mktsegment")
    r = resolve(ev, cust, direct=("chave", "ckey"), composite=(["nation", "segment"], ["c_nationkey", "c_mktsegment"]),
                order=["c_custkey"], take=["c_custkey", "c_name"], matched_by="via")
    return r.select("event_id", "user_id", dbl("c_custkey").alias("c_custkey"), "c_name", "via")


@query("exists_flag", """
SELECT o_orderkey, EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R')
  AS tem_devolucao FROM orders o""")
def exists_flag(spark, d):
    li = t(spark, d, "lineitem").filter(F.col("l_returnflag") == "R")
    return with_exists(t(spark, d, "orders").select("o_orderkey"), li, "o_orderkey", "l_orderkey", "tem_devolucao", grows=True)


@query("gap_anti", """
SELECT o_orderkey, o_orderdate FROM orders o
WHERE o_orderdate >= DATE '1998-01-01'
  AND NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""")
def gap_anti(spark, d):
    o = since(t(spark, d, "orders"), "o_orderdate", "1998-01-01")
    return missing_detail(o, t(spark, d, "lineitem"), "o_orderkey", "l_orderkey").select("o_orderkey", "o_orderdate")


@query("orphans", """
SELECT c_custkey, c_name FROM customer c WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = c.c_custkey)""")
def orphans(spark, d):
    return without(t(spark, d, "customer").select("c_custkey", "c_name"), t(spark, d, "events"), "c_custkey", "user_id", grows=True)


@query("value_gap", """
WITH i AS (SELECT l_orderkey, SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS v FROM lineitem GROUP BY 1)
SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS valor_total,
       CAST(i.v AS DOUBLE) AS valor_itens,
       CAST(abs(CAST(o_totalprice AS DECIMAL(12,2)) - i.v) AS DOUBLE) AS diferenca
FROM orders o JOIN i ON i.l_orderkey = o.o_orderkey
WHERE o_orderstatus = 'O' AND abs(CAST(o_totalprice AS DECIMAL(12,2)) - i.v) > 0.01""")
def value_gap(spark, d):
    items = t(spark, d, "lineitem").groupBy("l_orderkey").agg(sum_decimal("l_extendedprice").alias("v"))
    o = t(spark, d, "orders").filter(F.col("o_orderstatus") == "O").select("o_orderkey", decimal("o_totalprice").alias("vt"))
    j = o.join(items, F.col("l_orderkey") == F.col("o_orderkey")).filter(differs("vt", "v", 0.01))
    return j.select("o_orderkey", dbl("vt").alias("valor_total"), dbl("v").alias("valor_itens"),
                    dbl(F.abs(F.col("vt") - F.col("v"))).alias("diferenca"))


@query("owner_join", """
WITH ow AS (SELECT l_orderkey, l_linenumber, l_suppkey AS owner FROM (
              SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                           ORDER BY l_suppkey DESC, l_partkey DESC) AS rn
              FROM lineitem WHERE l_returnflag = 'R') WHERE rn = 1)
SELECT r.l_orderkey, r.l_linenumber, r.l_partkey, r.l_suppkey, ow.owner
FROM lineitem r JOIN ow ON ow.l_orderkey = r.l_orderkey AND ow.l_linenumber = r.l_linenumber
WHERE ow.owner IS NOT NULL""")
def owner_join(spark, d):
    li = t(spark, d, "lineitem")
    owners = (dedupe_last(li.filter(F.col("l_returnflag") == "R").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey"),
                          ["l_orderkey", "l_linenumber"], ["l_suppkey", "l_partkey"])
              .select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("owner"))
              .filter(F.col("owner").isNotNull()))
    reg = li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return match_inner(reg, owners, ["l_orderkey", "l_linenumber"])


@query("note_facts", """
WITH can AS (SELECT l_orderkey,
               CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR)
                 || '-' || CAST(l_suppkey AS VARCHAR) AS cid,
               strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS dh
             FROM lineitem WHERE l_returnflag = 'R'),
lc AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY dh DESC, cid DESC) AS rn FROM can)
       WHERE rn = 1),
pos AS (SELECT * FROM (SELECT l_orderkey, l_extendedprice,
               row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS rn
             FROM lineitem WHERE l_linestatus = 'O') WHERE rn = 1)
SELECT o.o_orderkey AS nota_id, lc.cid IS NOT NULL AS cancelada, lc.cid AS cancelamento_id,
       CAST(lc.dh AS TIMESTAMP) AS data_cancelamento, pos.l_orderkey IS NOT NULL AS tem_pdv,
       CAST(CAST(pos.l_extendedprice AS DECIMAL(12,2)) AS DOUBLE) AS valor_pdv
FROM orders o LEFT JOIN lc ON lc.l_orderkey = o.o_orderkey LEFT JOIN pos ON pos.l_orderkey = o.o_orderkey""")
def note_facts(spark, d):
    o, li = t(spark, d, "orders"), t(spark, d, "lineitem")
    s = lambda c: F.col(c).cast("string")
    notes = o.select(
        F.col("o_orderkey").alias("nota_id"), F.col("o_orderpriority").alias("hotel"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("dhEmi"), s("o_orderkey").alias("nNF"),
        F.lit("1").alias("serie"), F.lit("65").alias("mod"), F.lit("1").alias("tpAmb"),
        s("o_custkey").alias("cnpj_emit"), F.lit(None).cast("string").alias("nome_emit"),
        decimal("o_totalprice").alias("vNF"), F.lit(None).cast("string").alias("nProt"),
        F.lit("100").alias("cStat"), F.lit(None).cast("string").alias("dhRecbto"),
        F.lit(None).cast("timestamp").alias("extracted_at"))
    cancels = li.filter(F.col("l_returnflag") == "R").select(
        F.col("l_orderkey").alias("chNFe"),
        F.concat_ws("-", s("l_orderkey"), s("l_linenumber"), s("l_partkey"), s("l_suppkey")).alias("cancelamento_id"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss").alias("dhEvento"),
        F.lit(None).cast("string").alias("nProt"), F.lit(None).cast("string").alias("xJust"))
    pos = one_per_key(li.filter(F.col("l_linestatus") == "O"), "l_orderkey",
                      ["l_linenumber", "l_partkey", "l_suppkey"], take=["l_extendedprice", "l_shipdate"])
    pos = pos.select(F.col("l_orderkey").alias("chave_nfe"), F.to_date("l_shipdate").alias("data_venda"),
                     decimal("l_extendedprice").alias("subtotal_1"), F.lit(None).cast("string").alias("ponto_venda"))
    f = fact_notes(notes, cancels, pos)
    cid = one_per_key(cancels, "chNFe", ["dhEvento", "cancelamento_id"], take=["cancelamento_id"], largest=True)
    f = left_lookup(f, cid, "nota_id", "chNFe", ["cancelamento_id"], grows=True)
    return f.select("nota_id", "cancelada", "cancelamento_id",
                    F.col("data_cancelamento").cast("timestamp_ntz").alias("data_cancelamento"),
                    "tem_pdv", dbl("valor_pdv").alias("valor_pdv"))


@query("plans_occurrences", """
WITH occ AS (SELECT o_orderkey, o_custkey AS work_id,
                    CASE WHEN o_orderstatus = 'O' THEN 'OWN ' || o_orderpriority END AS nome_plano,
                    CASE WHEN o_orderstatus = 'F' THEN o_orderpriority || ' - ' || o_orderstatus END AS local_full_name
             FROM orders),
pl AS (SELECT c_custkey AS work_id, c_name AS nome_plano, c_mktsegment || ' - ' || c_name AS local_full_name
       FROM customer)
SELECT occ.o_orderkey, COALESCE(occ.nome_plano, pl.nome_plano) AS nome_plano,
       COALESCE(occ.local_full_name, pl.local_full_name) AS local_full_name,
       CASE WHEN COALESCE(occ.local_full_name, pl.local_full_name) ILIKE 'building%' THEN 'OBRA'
            WHEN COALESCE(occ.local_full_name, pl.local_full_name) ILIKE '1-URGENT%' THEN 'URG'
            ELSE trim(split_part(COALESCE(occ.local_full_name, NULL, pl.local_full_name, NULL), '-', 1)) END AS hotel
FROM occ LEFT JOIN pl ON CAST(pl.work_id AS VARCHAR) = CAST(occ.work_id AS VARCHAR)""")
def plans_occurrences(spark, d):
    o = t(spark, d, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("work_id"),
        F.when(F.col("o_orderstatus") == "O", F.concat(F.lit("OWN "), "o_orderpriority")).alias("nome_plano"),
        F.lit(None).cast("string").alias("local_name"),
        F.when(F.col("o_orderstatus") == "F", F.concat("o_orderpriority", F.lit(" - "), "o_orderstatus"))
         .alias("local_full_name"))
    plans = t(spark, d, "customer").select(
        F.col("c_custkey").alias("work_id"), F.col("c_name").alias("nome_plano"),
        F.lit(None).cast("string").alias("local_name"),
        F.concat("c_mktsegment", F.lit(" - "), "c_name").alias("local_full_name"))
    r = with_plan(o, plans, [("building", "OBRA"), ("1-URGENT", "URG")],
                  names=("nome_plano", "local_name", "local_full_name"))
    return r.select("o_orderkey", "nome_plano", "local_full_name", "hotel")


# ------------------------------------------------------------------ filters / lookups

@query("by_state", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P'")
def by_state(spark, d):
    return where_path(t(spark, d, "orders"), "o_orderstatus", "P").select("o_orderkey")


@query("period_rows", """
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-03-31'""")
def period_rows(spark, d):
    return in_period(t(spark, d, "orders"), "o_orderdate", "1996-01-01", "1996-03-31").select(
        "o_orderkey", "o_orderdate", "o_totalprice")


@query("recent_days", """
SELECT o_orderkey, o_orderdate, o_orderstatus, o_totalprice FROM orders
WHERE o_orderdate >= DATE '1998-07-03' AND o_orderdate < DATE '1998-08-03'""")
def recent_days(spark, d):
    return last_days(t(spark, d, "orders"), "o_orderdate", "1998-08-02", 30).select(
        "o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice")


@query("key_lookup", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem
WHERE l_orderkey = 1000 ORDER BY l_linenumber, l_partkey, l_suppkey""")
def key_lookup(spark, d):
    li = by_key(t(spark, d, "lineitem"), "l_orderkey", 1000)
    return sort(li, ["l_linenumber", "l_partkey", "l_suppkey"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


@query("group_items_ordered", """
SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
WHERE CAST(l_shipdate AS DATE) = DATE '1996-06-01' AND l_returnflag = 'N' AND l_extendedprice <> 0
ORDER BY l_suppkey, l_orderkey, l_linenumber""")
def group_items_ordered(spark, d):
    li = in_period(t(spark, d, "lineitem"), "l_shipdate", "1996-06-01", "1996-06-01")
    li = where_nonzero(where_path(li, "l_returnflag", "N"), "l_extendedprice")
    li = where_if(li, "l_suppkey", None)
    return sort(li, ["l_suppkey", "l_orderkey", "l_linenumber"]).select(
        "l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


@query("mart_filters", SALES_SQL + """
SELECT nota_id, CAST(data_emissao AS DATE) AS data, CAST(valor_total AS DOUBLE) AS valor_total FROM sales
WHERE hotel = '1-URGENT' AND status = 'Autorizada'
  AND CAST(data_emissao AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'
  AND data_emissao < DATE '1997-07-01'""")
def mart_filters(spark, d):
    s = sales(spark, d).withColumn("data", F.to_date("data_emissao"))
    s = filter_sales(s, hotel="1-URGENT", status="Autorizada", start="1997-01-01", end="1997-12-31")
    s = not_future(s, "data_emissao", "1997-06-30")
    return s.select("nota_id", "data", dbl("valor_total").alias("valor_total"))


@query("lookback", """
SELECT event_id, ts, user_id, event_type FROM events
WHERE ts >= DATE '2024-01-17' AND ts < DATE '2024-01-21'""")
def lookback_q(spark, d):
    return lookback(t(spark, d, "events"), "ts", "2024-01-20", 3).select("event_id", "ts", "user_id", "event_type")


# ------------------------------------------------------------------ calendar

BOUNDS_SQL = "WITH b AS (SELECT min(CAST(o_orderdate AS DATE)) AS s, max(CAST(o_orderdate AS DATE)) AS e FROM orders)\n"


@query("missing_days", BOUNDS_SQL + """
SELECT dia FROM (SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS dia FROM b) c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE CAST(o.o_orderdate AS DATE) = c.dia)""")
def missing_days_q(spark, d):
    return missing_days(t(spark, d, "orders"), "o_orderdate")


@query("date_chunks", BOUNDS_SQL + """
SELECT chunk_inicio, LEAST(chunk_inicio + 29, e) AS chunk_fim
FROM (SELECT CAST(unnest(generate_series(s, e, INTERVAL 30 DAY)) AS DATE) AS chunk_inicio, e FROM b)""")
def date_chunks_q(spark, d):
    return date_chunks(bounds(t(spark, d, "orders"), "o_orderdate"), 30)


@query("calendar", BOUNDS_SQL + """
SELECT data, CAST(year(data) AS INTEGER) AS ano, CAST(month(data) AS INTEGER) AS mes,
       strftime(data, '%b/%Y') AS mes_nome, 'T' || CAST(quarter(data) AS VARCHAR) AS trimestre
FROM (SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS data FROM b)""")
def calendar_q(spark, d):
    return calendar(bounds(t(spark, d, "orders"), "o_orderdate"))


# ------------------------------------------------------------------ scalar

@query("unit_price", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INTEGER) AS quantidade,
       CASE WHEN CAST(l_quantity AS INTEGER) > 0
            THEN (2 * CAST(round(l_extendedprice * 100) AS BIGINT) + CAST(l_quantity AS INTEGER))
                 // (2 * CAST(l_quantity AS INTEGER))
            ELSE 0 END AS valor_unitario_centavos,
       l_returnflag || ' ' || l_linestatus AS colaborador, l_linenumber = 1 AS primeira_linha
FROM lineitem""")
def unit_price_q(spark, d):
    li = t(spark, d, "lineitem").withColumn("q", F.col("l_quantity").cast("int"))
    cents = (F.round(unit_price(decimal("l_extendedprice"), "q"), 2) * 100).cast("bigint")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("q").alias("quantidade"),
                     cents.alias("valor_unitario_centavos"),
                     full_name("l_returnflag", "l_linestatus").alias("colaborador"),
                     is_one("l_linenumber").alias("primeira_linha"))


@query("date_parts", """
SELECT event_id, CAST(ts AS DATE) AS dia, epoch_us(ts) + 987654 AS micros_utc,
       epoch_us(ts) + 987654 + 10800000000 AS micros_instante, TRUE AS tem_texto
FROM (SELECT event_id, date_trunc('second', ts) AS ts FROM events)""")
def date_parts(spark, d):
    e = t(spark, d, "events").select(
        "event_id", F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".987654-03:00")).alias("txt"))
    return e.select("event_id", iso_date("txt").alias("dia"),
                    F.unix_micros(text_to_utc("txt")).alias("micros_utc"),
                    F.unix_micros(instant("txt")).alias("micros_instante"),
                    present("txt").alias("tem_texto"))


@query("text_slice", """
SELECT p_partkey, substr(p_name, 1, 5) AS campo_a, substr(p_type, 2, 3) AS campo_b,
       substr(p_name, CAST(p_size // 10 + 1 AS INTEGER), 4) AS campo_c FROM part""")
def text_slice(spark, d):
    p = t(spark, d, "part")
    return p.select("p_partkey", slice_text("p_name", 1, 5).alias("campo_a"), slice_text("p_type", 2, 3).alias("campo_b"),
                    slice_text("p_name", (F.floor(F.col("p_size") / 10) + 1).cast("int"), 4).alias("campo_c"))


@query("id_list", """
SELECT DISTINCT regexp_replace(c_name, '[^0-9]', '', 'g') AS id FROM customer
WHERE regexp_replace(c_name, '[^0-9]', '', 'g') <> ''""")
def id_list(spark, d):
    return ids_from_text(t(spark, d, "customer"), "c_name")


# ------------------------------------------------------------------ table changes

@query("dedupe_last", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS rn FROM lineitem)
WHERE rn = 1""")
def dedupe_last_q(spark, d):
    return dedupe_last(t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"])


@query("upsert_state", """
SELECT o_orderkey, 'O' AS o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'P'
UNION ALL
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders t
WHERE NOT EXISTS (SELECT 1 FROM orders u WHERE u.o_orderstatus = 'P' AND u.o_orderkey = t.o_orderkey)""")
def upsert_state(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    batch = o.filter(F.col("o_orderstatus") == "P").withColumn("o_orderstatus", F.lit("O"))
    return upsert(o, batch, "o_orderkey", "o_totalprice").select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("soft_delete", """
SELECT o_orderkey,
       CASE WHEN o_orderstatus = 'P' AND NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
            THEN 'EXCLUIDO' ELSE o_orderstatus END AS state,
       o_orderpriority AS priority, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS total
FROM orders o""")
def soft_delete_q(spark, d):
    o = t(spark, d, "orders")
    docs = o.select("o_orderkey", F.to_json(F.struct(
        F.struct(F.col("o_orderstatus").alias("state"), F.col("o_orderpriority").alias("priority")).alias("attributes"),
        decimal("o_totalprice").alias("total"))).alias("data"))
    paused = o.filter(F.col("o_orderstatus") == "P").select("o_orderkey")
    ids = gone(paused, t(spark, d, "lineitem"), "o_orderkey", "l_orderkey")
    out = soft_delete(docs, ids, "o_orderkey", ["attributes", "state"], "EXCLUIDO")
    return project(out, "data", [("state", "attributes.state", "text"), ("priority", "attributes.priority", "text"),
                                 ("total", "total", "numeric(12,2)")], keep=["o_orderkey"]) \
        .withColumn("total", dbl("total"))


# ------------------------------------------------------------------ documents

def _key44(c="o_orderkey"):
    return F.lpad(F.col(c).cast("string"), 44, "0")


def note_xml_files(spark, d) -> DataFrame:
    """Orders rendered as tax-note XML files: authorised/cancelled ones in the
    ``nfeProc`` envelope with a protocol, pending ones as a bare ``NFe``."""
    o = t(spark, d, "orders")
    inf = F.concat(
        F.lit('<infNFe Id="NFe'), _key44(), F.lit('" versao="4.00"><ide><mod>65</mod><serie>1</serie><nNF>'),
        F.col("o_orderkey").cast("string"), F.lit("</nNF><dhEmi>"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-03:00</dhEmi><tpAmb>1</tpAmb></ide><emit><CNPJ>"),
        F.lpad(F.col("o_custkey").cast("string"), 14, "0"), F.lit("</CNPJ><xNome>Emitente "),
        F.col("o_custkey").cast("string"), F.lit("</xNome></emit><total><ICMSTot><vNF>"),
        decimal("o_totalprice").cast("string"), F.lit("</vNF></ICMSTot></total></infNFe>"))
    nfe = F.concat(F.lit("<NFe>"), inf, F.lit("</NFe>"))
    proc = F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?><nfeProc xmlns="urn:example:nfe" versao="4.00">'),
                    nfe, F.lit("<protNFe><infProt><nProt>"), F.col("o_orderkey").cast("string"),
                    F.lit("</nProt><cStat>100</cStat><dhRecbto>"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"),
                    F.lit("-03:00</dhRecbto></infProt></protNFe></nfeProc>"))
    value = F.when(F.col("o_orderstatus") == "P", nfe).otherwise(proc)
    name = F.concat(F.lit("NFe"), _key44(), F.lit("-nfe.xml"))
    return o.select(value.alias("value"), F.concat(F.lit("notes/"), F.col("o_orderpriority"), F.lit("/"), name).alias("file_path"),
                    name.alias("file_name"))


@query("xml_notes", """
SELECT lpad(CAST(o_orderkey AS VARCHAR), 44, '0') AS nota_id, CAST(o_orderkey AS VARCHAR) AS nNF, '1' AS serie,
       CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS vNF,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE '100' END AS cStat,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END AS nProt
FROM orders""")
def xml_notes(spark, d):
    ok, _ = parse_note_xml(note_xml_files(spark, d))
    return ok.select("nota_id", "nNF", "serie", "vNF", "cStat", "nProt")


@query("xml_cancels", """
SELECT 'ID110111' || lpad(CAST(o_orderkey AS VARCHAR), 44, '0') || '01' AS cancelamento_id,
       lpad(CAST(o_orderkey AS VARCHAR), 44, '0') AS chNFe, '110111' AS tpEvento, '1' AS nSeqEvento,
       'Cancelada pelo cliente ' || CAST(o_custkey AS VARCHAR) AS xJust
FROM orders WHERE o_orderstatus = 'F'""")
def xml_cancels(spark, d):
    o = t(spark, d, "orders").filter(F.col("o_orderstatus") == "F")
    xml = F.concat(
        F.lit('﻿<?xml version="1.0" encoding="UTF-8"?><envEvento xmlns="urn:example:nfe" versao="1.00">'
              '<idLote>1</idLote><evento versao="1.00"><infEvento Id="ID110111'), _key44(),
        F.lit('01"><CNPJ>'), F.lpad(F.col("o_custkey").cast("string"), 14, "0"), F.lit("</CNPJ><chNFe>"), _key44(),
        F.lit("</chNFe><dhEvento>"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"),
        F.lit("-03:00</dhEvento><tpEvento>110111</tpEvento><nSeqEvento>1</nSeqEvento>"
              "<detEvento versao=\"1.00\"><descEvento>Cancelamento</descEvento><nProt>"),
        F.col("o_orderkey").cast("string"), F.lit("</nProt><xJust>Cancelada pelo cliente "),
        F.col("o_custkey").cast("string"), F.lit("</xJust></detEvento></infEvento></evento></envEvento>"))
    files = o.select(xml.alias("value"), F.lit("x").alias("file_path"),
                     F.concat(F.lit("ID110111"), _key44(), F.lit("01-can.xml")).alias("file_name"))
    ok, _ = parse_cancel_xml(files)
    return ok.select("cancelamento_id", "chNFe", "tpEvento", "nSeqEvento", "xJust")


# Fixed values of the stand-in: store / location codes -> site.
STAND_IN_CODES = {"1": "URGENTE", "2": "ALTA"}


@query("sectioned_json", """
SELECT lpad(CAST(o_orderkey AS VARCHAR), 44, '0') AS id,
       CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'URGENTE' WHEN '2' THEN 'ALTA'
            ELSE substr(o_orderpriority, 1, 1) END AS hotel,
       'pos_' || CAST(o_orderkey AS VARCHAR) || '.json' AS source_file,
       o_orderkey AS numero_comanda, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS subtotal_1
FROM orders""")
def sectioned_json(spark, d):
    o = t(spark, d, "orders")
    header = F.to_json(F.struct(F.lit("FIS").alias("Record Type"),
                                F.substring("o_orderpriority", 1, 1).alias("Store Number")))
    rec = F.to_json(F.struct(F.lit("FISID").alias("Record Type"), _key44().alias("Invoice Data Info 8"),
                             F.col("o_orderkey").alias("Check Number"), decimal("o_totalprice").alias("Sub Total 1"),
                             F.date_format("o_orderdate", "yyyy-MM-dd").alias("Business Date")))
    blank = F.to_json(F.struct(F.lit("FISID").alias("Record Type"), F.lit("   ").alias("Invoice Data Info 8")))
    value = F.concat(F.lit("[["), header, F.lit("],[{}],["), rec, F.lit(',"junk",'), blank, F.lit("],[{}]]"))
    name = F.concat(F.lit("pos_"), F.col("o_orderkey").cast("string"), F.lit(".json"))
    files = o.select(value.alias("value"), name.alias("file_path"), name.alias("file_name"))
    rows = parse_sectioned_json(files, STAND_IN_CODES)
    return rows.select(F.col("key").alias("id"), "hotel", "source_file",
                       project_one(rows, "Check Number", "bigint").alias("numero_comanda"),
                       dbl(project_one(rows, "['Sub Total 1']", "numeric(12,2)")).alias("subtotal_1"))


def project_one(df, p, typ):
    from tidewater.functions.json_paths import doc_path
    return doc_path(df, "data", p, typ)


@query("nested_array_json", """
SELECT o_orderkey AS id,
       CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'URGENTE' WHEN '2' THEN 'ALTA'
            ELSE substr(o_orderpriority, 1, 1) END AS hotel,
       'GCM_' || CAST(o_custkey AS VARCHAR) || '.json' AS source_file, o_custkey AS check_id
FROM orders WHERE o_orderkey <> 0""")
def nested_array_json(spark, d):
    o = t(spark, d, "orders")
    rec = F.to_json(F.struct(F.col("o_orderkey").alias("guestCheckLineItemID"), F.col("o_custkey").alias("guestCheckID"),
                             F.substring("o_orderpriority", 1, 1).alias("locationRef")))
    name = F.concat(F.lit("GCM_"), F.col("o_custkey").cast("string"), F.lit(".json"))
    files = o.select(F.concat(F.lit("[["), rec, F.lit("]]")).alias("value"), name.alias("file_path"),
                     name.alias("file_name"))
    rows = parse_nested_array_json(files, STAND_IN_CODES)
    return rows.select(F.col("key").alias("id"), "hotel", "source_file",
                       project_one(rows, "guestCheckID", "bigint").alias("check_id"))


def export_docs(spark, d) -> DataFrame:
    """K7 over the stand-ins: one document per segment and year of orders, with settings for some segments."""
    items = t(spark, d, "orders").join(t(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    settings = t(spark, d, "nation").filter(F.col("n_nationkey") < 3).select(
        F.element_at(F.array(F.lit("BUILDING"), F.lit("MACHINERY"), F.lit("HOUSEHOLD")), F.col("n_nationkey") + 1).alias("config_key"),
        F.when(F.col("n_nationkey") == 2, F.lit("x")).otherwise(F.col("n_nationkey").cast("string")).alias("EmpresaId"),
        F.col("n_name").alias("CodigoDaEmpresa"), F.lit("K").alias("ChaveDeAcesso"), F.lit("SER").alias("EmissordoCupom"))
    items = with_config(items.withColumn("ano", F.year("o_orderdate")), settings, "c_mktsegment")
    venda = sale_record("c_nationkey", "o_orderkey", "o_totalprice", F.nullif(F.col("c_nationkey"), F.lit(7)))
    return export_documents(items, ["c_mktsegment", "ano"], ["o_orderkey"], venda, F.lit("1998-08-02"))


EXPORT_SQL = """
WITH cfg AS (SELECT CASE n_nationkey WHEN 0 THEN 'BUILDING' WHEN 1 THEN 'MACHINERY' ELSE 'HOUSEHOLD' END AS k,
                    CASE n_nationkey WHEN 2 THEN 0 ELSE n_nationkey END AS empresa, n_name AS codigo FROM nation WHERE n_nationkey < 3),
i AS (SELECT c_mktsegment, CAST(year(o_orderdate) AS INTEGER) AS ano, o_orderkey, CAST(c_nationkey AS VARCHAR) AS pdv,
             CASE WHEN c_nationkey IN (7, 0) THEN 1 ELSE c_nationkey END AS q, round(o_totalprice * 100) AS cents,
             coalesce(empresa, 0) AS empresa, coalesce(codigo, '') AS codigo, CASE WHEN k IS NULL THEN '' ELSE 'SER' END AS serie
      FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN cfg ON k = c_mktsegment)
"""


@query("export_text", EXPORT_SQL + """
SELECT c_mktsegment, ano, 0 AS secao, CAST(NULL AS DOUBLE) AS o_orderkey, CAST(empresa AS DOUBLE) AS numero, codigo AS texto,
       '1998-08-02' AS outro FROM i GROUP BY ALL
UNION ALL SELECT c_mktsegment, ano, 1, CAST(o_orderkey AS DOUBLE), CAST(q AS DOUBLE),
       pdv || '|' || serie || '|' || CAST(o_orderkey AS VARCHAR),
       CAST((2 * CAST(cents AS BIGINT) + q) // (2 * q) AS VARCHAR) FROM i
UNION ALL SELECT c_mktsegment, ano, 2, CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), ']}}', NULL FROM i GROUP BY ALL""")
def export_text(spark, d):
    """Every line of the documents: header fields, item values and footer."""
    x = export_docs(spark, d).withColumn("secao", F.col("place.section"))
    item = F.from_json(F.regexp_replace("line", "^,", ""), "CodigoPDV string, EmissordoCupom string, CodigoExterno string, "
                                                           "Quantidade double, ValorUnitario double")
    head = F.from_json(F.concat("line", F.lit("]}}")), "EmpresaId int, CodigoDaEmpresa string, DataDoMovimento string")
    x = x.withColumns({"i": F.when(F.col("secao") == 1, item), "h": F.when(F.col("secao") == 0, head)})
    return x.select("c_mktsegment", "ano", "secao", dbl("place.o0").alias("o_orderkey"),
                    F.coalesce(dbl("h.EmpresaId"), "i.Quantidade").alias("numero"),
                    F.coalesce("h.CodigoDaEmpresa", F.concat_ws("|", *[F.when(F.col("secao") == 1, F.col(f"i.{c}")) for c in
                                                                       ("CodigoPDV", "EmissordoCupom", "CodigoExterno")]).substr(F.when(F.col("secao") == 1, 1), F.lit(999)),
                               F.when(F.col("secao") == 2, F.col("line"))).alias("texto"),
                    F.coalesce("h.DataDoMovimento", F.round(F.col("i.ValorUnitario") * 100).cast("bigint").cast("string")).alias("outro"))


@query("export_groups", EXPORT_SQL + """
SELECT c_mktsegment, ano, count(*) AS itens, CAST(min(o_orderkey) AS VARCHAR) AS primeiro, CAST(max(o_orderkey) AS VARCHAR) AS ultimo
FROM i GROUP BY 1, 2""")
def export_groups(spark, d):
    """Each whole document is valid JSON with its items in order."""
    from tidewater.sinks.export import checked_documents
    return checked_documents(export_docs(spark, d), ["c_mktsegment", "ano"]).select(
        "c_mktsegment", "ano", F.when(F.col("valid"), F.col("items")).alias("itens"), F.col("first").alias("primeiro"), F.col("last").alias("ultimo"))


# ------------------------------------------------------------------ more views and sources

@query("ledger_fact", """
WITH l AS (SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR)
                    || '-' || CAST(l_suppkey AS VARCHAR) AS lancamento_id,
                  CAST(l_orderkey AS VARCHAR) AS numero, '1' AS serie, l_linestatus AS hotel,
                  NULLIF(CASE WHEN l_returnflag = 'R' THEN lpad(CAST(l_partkey AS VARCHAR), 44, '0') ELSE '' END, '') AS direct
           FROM lineitem),
n AS (SELECT lpad(CAST(o_orderkey AS VARCHAR), 44, '0') AS nota_id, CAST(o_orderkey AS VARCHAR) AS nNF, '1' AS serie,
             o_orderstatus AS hotel, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE '100' END AS cStat FROM orders),
c AS (SELECT DISTINCT lpad(CAST(o_orderkey AS VARCHAR), 44, '0') AS chNFe FROM orders WHERE o_orderstatus = 'F'),
m AS (SELECT l.lancamento_id, l.hotel, COALESCE(nd.nota_id, nc.nota_id) AS chave_nfe,
             COALESCE(nd.cStat, nc.cStat) AS status_sefaz
      FROM l LEFT JOIN n nd ON nd.nota_id = l.direct
      LEFT JOIN n nc ON nd.nota_id IS NULL AND nc.nNF = l.numero AND nc.serie = l.serie AND nc.hotel = l.hotel)
SELECT m.*, EXISTS (SELECT 1 FROM c WHERE c.chNFe = m.chave_nfe) AS cancelada FROM m""")
def ledger_fact(spark, d):
    return ledger_fact_full(spark, d).select("lancamento_id", "hotel", "chave_nfe", "status_sefaz", "cancelada")


def ledger_fact_full(spark, d):
    """V6 over the stand-ins: ledger = line items, notes = orders."""
    from tidewater.plans.fiscal import fact_ledger
    li, o = t(spark, d, "lineitem"), t(spark, d, "orders")
    s = lambda c: (F.col(c) if isinstance(c, str) else c).cast("string")
    ledger = li.select(
        F.concat_ws("-", s("l_orderkey"), s("l_linenumber"), s("l_partkey"), s("l_suppkey")).alias("lancamento_id"),
        F.col("l_linestatus").alias("hotel"), F.concat(F.lit("Empresa "), s(F.col("l_suppkey") % 5)).alias("empresa"),
        F.to_date("l_shipdate").alias("data_emissao"), F.lit("NFCE").alias("tipo_documento"),
        s("l_orderkey").alias("numero_documento"), F.lit("1").alias("serie"), F.col("l_returnflag").alias("cfop"),
        s("l_partkey").alias("codigo_produto"), F.concat(F.lit("P"), s("l_partkey")).alias("descricao_produto"),
        decimal("l_quantity", 12, 4).alias("quantidade"), F.lit(None).cast("decimal(12,2)").alias("valor_unitario"),
        decimal("l_extendedprice").alias("valor_total_item"), F.lit(None).cast("decimal(12,2)").alias("desconto"),
        decimal("l_extendedprice").alias("valor_total_documento"),
        F.when(F.col("l_returnflag") == "R", _key44("l_partkey")).otherwise(F.lit("")).alias("chave_sefaz_raw"))
    notes = o.select(_key44().alias("nota_id"), s("o_orderkey").alias("nNF"), F.lit("1").alias("serie"),
                     F.col("o_orderstatus").alias("hotel"),
                     F.when(F.col("o_orderstatus") != "P", F.lit("100")).alias("cStat"),
                     F.lit(None).cast("string").alias("nProt"), F.lit(None).cast("string").alias("dhRecbto"))
    cancels = o.filter(F.col("o_orderstatus") == "F").select(_key44().alias("chNFe"))
    return fact_ledger(ledger, notes, cancels)


@query("measures_by_calendar", SALES_SQL + """, b AS (SELECT min(CAST(data_emissao AS DATE)) AS s, max(CAST(data_emissao AS DATE)) AS e FROM sales),
cal AS (SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS data FROM b),
per AS (SELECT CAST(data_emissao AS DATE) AS d,
               SUM(valor_total) FILTER (WHERE status <> 'Cancelada') AS f,
               count(*) FILTER (WHERE status = 'Autorizada') AS a, count(*) FILTER (WHERE status = 'Cancelada') AS c,
               count(*) FILTER (WHERE status = 'Pendente SEFAZ') AS p,
               count(*) FILTER (WHERE status = 'Autorizada' AND NOT tem_fiscal) AS sf,
               count(*) FILTER (WHERE status = 'Autorizada' AND NOT tem_pdv) AS sp
        FROM sales GROUP BY 1)
SELECT cal.data, CAST(year(cal.data) AS INTEGER) AS ano, CAST(month(cal.data) AS INTEGER) AS mes,
       strftime(cal.data, '%b/%Y') AS mes_nome, 'T' || CAST(quarter(cal.data) AS VARCHAR) AS trimestre,
       CAST(per.f AS DOUBLE) AS faturamento_total, COALESCE(per.a, 0) AS notas_autorizadas,
       COALESCE(per.c, 0) AS notas_canceladas, COALESCE(per.p, 0) AS pendentes_sefaz,
       COALESCE(per.sf, 0) AS nfe_sem_fiscal, COALESCE(per.sp, 0) AS nfe_sem_pdv
FROM cal LEFT JOIN per ON per.d = cal.data""")
def measures_by_calendar_q(spark, d):
    from tidewater.plans.measures import measures_by_calendar
    s = sales(spark, d)
    return measures_by_calendar(s, bounds(s, "data_emissao")).withColumn("faturamento_total", dbl("faturamento_total"))


def _files(df, value, name):
    return df.select(value.alias("value"), name.alias("file_path"), name.alias("file_name"))


@query("paged_envelopes", """
SELECT CAST(event_id AS VARCHAR) AS key, event_type AS type, 1 AS page, 2 AS total_pages FROM events
UNION ALL
SELECT CAST(event_id AS VARCHAR) || '-b', 'follow_up', 1, 2 FROM events""")
def paged_envelopes(spark, d):
    from tidewater.sources.documents import parse_paged_envelopes
    e = t(spark, d, "events")
    item = lambda i, ty: F.to_json(F.struct(i.alias("id"), ty.alias("type"),
                                            F.struct(F.col("user_id").alias("user_id")).alias("attributes")))
    page = F.concat(F.lit('{"data":['), item(F.col("event_id").cast("string"), F.col("event_type")), F.lit(","),
                    item(F.concat(F.col("event_id").cast("string"), F.lit("-b")), F.lit("follow_up")),
                    F.lit('],"included":[{"id":"x","type":"location"}],"meta":{"pagination":'
                          '{"total_pages":2,"current_page":1,"per_page":200}}}'))
    rows = parse_paged_envelopes(_files(e, page, F.concat(F.lit("events_"), F.col("event_id").cast("string"), F.lit(".json"))))
    return rows.select("key", F.try_variant_get("data", "$.type", "string").alias("type"), "page", "total_pages")


@query("detail_envelopes", """
SELECT CAST(o_orderkey AS VARCHAR) AS key, o_orderpriority AS priority, CAST(o_orderkey AS VARCHAR) AS root_id,
       2 AS included_items FROM orders WHERE o_orderstatus <> 'P'""")
def detail_envelopes(spark, d):
    from tidewater.sources.documents import parse_detail_envelopes
    o = t(spark, d, "orders")
    body = F.to_json(F.struct(F.col("o_orderkey").cast("string").alias("id"), F.lit("failure").alias("type"),
                              F.struct(F.col("o_orderpriority").alias("priority")).alias("attributes")))
    doc = F.when(F.col("o_orderstatus") == "P", F.lit('{"errors":[{"status":"404"}]}')).otherwise(
        F.concat(F.lit('{"data":'), body, F.lit(',"included":[{"id":"1","type":"event","attributes":{"operator_id":'),
                 F.col("o_custkey").cast("string"), F.lit('}},{"id":"2","type":"location","attributes":{"name":"n"}}]}')))
    ok, _ = parse_detail_envelopes(_files(o, doc, F.concat(F.lit("failure_"), F.col("o_orderkey").cast("string"), F.lit(".json"))))
    return ok.select("key", F.try_variant_get("data", "$.data.attributes.priority", "string").alias("priority"),
                     F.try_variant_get("data", "$.id", "string").alias("root_id"),
                     F.size(F.try_variant_get("data", "$.included", "array<variant>")).alias("included_items"))


@query("json_array", """
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR)
         || '-' || CAST(l_suppkey AS VARCHAR) AS key,
       l_returnflag AS ANCFOP FROM lineitem""")
def json_array(spark, d):
    from tidewater.sources.documents import parse_json_array
    li = t(spark, d, "lineitem")
    s = lambda c: F.col(c).cast("string")
    rec = F.to_json(F.struct(F.concat_ws("-", s("l_orderkey"), s("l_linenumber"), s("l_partkey"), s("l_suppkey"))
                             .alias("IDLANCAMENTOICMSBASE"), F.col("l_returnflag").alias("ANCFOP")))
    files = _files(li, F.concat(F.lit("["), rec, F.lit(',"noise",7]')),
                   F.concat(F.lit("ledger_"), s("l_orderkey"), F.lit(".json")))
    rows = parse_json_array(files)
    return rows.select("key", F.try_variant_get("data", "$.ANCFOP", "string").alias("ANCFOP"))


@query("dead_letters", """
SELECT CAST(date_trunc('second', ts) AS TIMESTAMP) AS logged_at, event_type AS resource_type,
       CAST(event_id AS VARCHAR) AS id, 'falha ' || CAST(user_id AS VARCHAR) || chr(10) || chr(9) || 'detalhe' AS error
FROM events
UNION ALL
SELECT CAST(date_trunc('second', ts) AS TIMESTAMP), 'retry', CAST(user_id AS VARCHAR), '404 Not Found' FROM events""")
def dead_letters(spark, d):
    from tidewater.sources.documents import parse_dead_letters
    e = t(spark, d, "events")
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    text = F.concat(stamp, F.lit(" | "), F.col("event_type"), F.lit(" | ID: "), F.col("event_id").cast("string"),
                    F.lit(" | Erro: falha "), F.col("user_id").cast("string"), F.lit("\n\tdetalhe\n\n"),
                    stamp, F.lit(" | retry | ID: "), F.col("user_id").cast("string"), F.lit(" | Erro: 404 Not Found\n"))
    return parse_dead_letters(_files(e, text, F.concat(F.lit("ids_"), F.col("event_id").cast("string"), F.lit(".log"))))


@query("export_receipts", """
WITH i AS (SELECT c_mktsegment, o_orderkey, CAST(o_totalprice AS DECIMAL(12,2)) AS total, l_linenumber, l_partkey, l_quantity,
                  CAST(l_extendedprice AS DECIMAL(12,2)) AS v
           FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey)
SELECT c_mktsegment, CAST(o_orderkey AS DOUBLE) AS comanda, 'recibo' AS linha, CAST(total AS DOUBLE) AS valor, CAST(NULL AS DOUBLE) AS quantidade,
       count(*) AS linhas FROM (SELECT DISTINCT c_mktsegment, o_orderkey, total FROM i) GROUP BY ALL
UNION ALL SELECT c_mktsegment, CAST(o_orderkey AS DOUBLE), CAST(l_partkey AS VARCHAR), CAST(v AS DOUBLE), CAST(l_quantity AS DOUBLE), count(*) FROM i GROUP BY ALL
UNION ALL SELECT c_mktsegment, CAST(o_orderkey AS DOUBLE), 'fim', NULL, NULL, count(*) FROM (SELECT DISTINCT c_mktsegment, o_orderkey FROM i) GROUP BY ALL
UNION ALL SELECT DISTINCT c_mktsegment, CAST(NULL AS DOUBLE), 'documento', NULL, NULL, 2 FROM i""")
def export_receipts(spark, d):
    from tidewater.sinks.export import export_receipts_xml
    li = (t(spark, d, "lineitem").join(t(spark, d, "orders"), F.col("o_orderkey") == F.col("l_orderkey"))
          .join(t(spark, d, "customer"), F.col("c_custkey") == F.col("o_custkey")))
    docs = export_receipts_xml(li, ["c_mktsegment"], "o_orderkey",
                               {"NumeroCOO": F.col("o_orderkey"), "ValorTotal": decimal("o_totalprice")},
                               {"CodigoProduto": F.col("l_partkey"), "Quantidade": F.col("l_quantity"),
                                "ValorTotalLiquido": decimal("l_extendedprice")},
                               ["l_linenumber", "l_partkey", "l_suppkey"])
    tag = lambda name: F.nullif(F.regexp_extract("line", f"<{name}>([^<]*)</{name}>", 1), F.lit(""))
    kind = (F.when(F.col("line").startswith("<PDVVenda>"), F.lit("recibo")).when(F.col("line") == "</Itens></PDVVenda>", F.lit("fim"))
            .when(F.col("line").isin("<Vendas>", "</Vendas>"), F.lit("documento")).otherwise(tag("CodigoProduto")))
    return docs.select("c_mktsegment", dbl("place.check").alias("comanda"), kind.alias("linha"),
                       dbl(F.coalesce(tag("ValorTotal"), tag("ValorTotalLiquido"))).alias("valor"),
                       dbl(tag("Quantidade")).alias("quantidade")).groupBy("c_mktsegment", "comanda", "linha", "valor", "quantidade").agg(
        F.count(F.lit(1)).alias("linhas"))


# ------------------------------------------------------------------ the reference's timed-out reads (Q29, Q15)

LEDGER_SQL = """
WITH l AS (SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR)
                    || '-' || CAST(l_suppkey AS VARCHAR) AS lancamento_id,
                  CAST(l_orderkey AS VARCHAR) AS numero, '1' AS serie, l_linestatus AS hotel, CAST(l_shipdate AS DATE) AS dia,
                  NULLIF(CASE WHEN l_returnflag = 'R' THEN lpad(CAST(l_partkey AS VARCHAR), 44, '0') ELSE '' END, '') AS direct
           FROM lineitem),
n AS (SELECT lpad(CAST(o_orderkey AS VARCHAR), 44, '0') AS nota_id, CAST(o_orderkey AS VARCHAR) AS nNF, '1' AS serie,
             o_orderstatus AS hotel, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE '100' END AS cStat FROM orders),
c AS (SELECT DISTINCT lpad(CAST(o_orderkey AS VARCHAR), 44, '0') AS chNFe FROM orders WHERE o_orderstatus = 'F'),
m AS (SELECT l.lancamento_id, l.hotel, l.dia, COALESCE(nd.nota_id, nc.nota_id) AS chave_nfe,
             COALESCE(nd.cStat, nc.cStat) AS status_sefaz
      FROM l LEFT JOIN n nd ON nd.nota_id = l.direct
      LEFT JOIN n nc ON nd.nota_id IS NULL AND nc.nNF = l.numero AND nc.serie = l.serie AND nc.hotel = l.hotel)
"""


@query("ledger_recent", LEDGER_SQL + """
SELECT m.lancamento_id, m.hotel, m.dia AS data_emissao, m.chave_nfe, m.status_sefaz,
       EXISTS (SELECT 1 FROM c WHERE c.chNFe = m.chave_nfe) AS cancelada
FROM m WHERE m.dia >= DATE '1998-07-03' AND m.dia < DATE '1998-08-03'""")
def ledger_recent(spark, d):
    from tidewater.plans.audits import ledger_recent as q29a
    f = q29a(ledger_fact_full(spark, d), "1998-08-02", 30)
    return f.select("lancamento_id", "hotel", "data_emissao", "chave_nfe", "status_sefaz", "cancelada")


@query("sales_notes_recent", SALES_SQL + """
SELECT nota_id, hotel, data_emissao, CAST(valor_total AS DOUBLE) AS valor_total, status, tem_pdv, tem_fiscal
FROM sales WHERE data_emissao >= DATE '1998-07-03' AND data_emissao < DATE '1998-08-03'""")
def sales_notes_recent(spark, d):
    from tidewater.plans.audits import sales_notes_recent as q29b
    s = q29b(sales(spark, d), "1998-08-02", 30, limit=None)
    return s.select("nota_id", "hotel", "data_emissao", dbl("valor_total").alias("valor_total"), "status",
                    "tem_pdv", "tem_fiscal")


@query("daily_recent", SALES_SQL + """
SELECT hotel, CAST(data_emissao AS DATE) AS data, count(*) AS total_notas,
       count(*) FILTER (WHERE status = 'Autorizada') AS notas_autorizadas,
       CAST(COALESCE(SUM(valor_total) FILTER (WHERE status <> 'Cancelada'), 0) AS DOUBLE) AS valor_total_dia
FROM sales WHERE data_emissao IS NOT NULL
GROUP BY 1, 2 HAVING CAST(data_emissao AS DATE) >= DATE '1998-07-03' AND CAST(data_emissao AS DATE) <= DATE '1998-08-02'""")
def daily_recent(spark, d):
    from tidewater.plans.audits import sales_recent
    return sales_recent(sales_daily(sales(spark, d)), "1998-08-02", 30).withColumn("valor_total_dia", dbl("valor_total_dia"))


# ------------------------------------------------------------------ maintenance views over documents (V2, V3)

MAINTENANCE_RULES = [("nation 1 ", "ONE")]


def _inc(*items):
    """An ``included`` array: (id, type, name, full_name) tuples of Columns."""
    return F.array(*[F.struct(i.alias("id"), ty.alias("type"),
                              F.struct(n.alias("name"), fn.alias("full_name")).alias("attributes"))
                     for i, ty, n, fn in items])


@query("maintenance_views", """
WITH pd AS (SELECT CAST(c_custkey AS VARCHAR) AS work_id, 'Plano ' || c_name AS nome_plano,
                   'Local ' || CAST(c_nationkey AS VARCHAR) AS local_name,
                   'Nation ' || CAST(c_nationkey AS VARCHAR) || ' - ' || c_mktsegment AS local_full_name
            FROM customer WHERE c_acctbal > 0),
pb AS (SELECT CAST(c_custkey AS VARCHAR) AS work_id, c_name AS nome_plano, CAST(NULL AS VARCHAR) AS local_name,
              CAST(NULL AS VARCHAR) AS local_full_name
       FROM customer c WHERE NOT EXISTS (SELECT 1 FROM pd WHERE pd.work_id = CAST(c.c_custkey AS VARCHAR))),
p AS (SELECT * FROM pd UNION ALL SELECT * FROM pb),
od AS (SELECT CAST(o_orderkey AS VARCHAR) AS scheduled_work_id, CAST(o_custkey AS INTEGER) AS work_id,
              o_orderstatus AS status, o_orderdate AS data_agendada, 'Trabalho ' || CAST(o_orderkey AS VARCHAR) AS nome_plano,
              'Sala ' || o_orderpriority AS local_name, CAST(NULL AS VARCHAR) AS local_full_name
       FROM orders WHERE o_orderstatus = 'F'),
ob AS (SELECT CAST(o_orderkey AS VARCHAR) AS scheduled_work_id, CAST(o_custkey AS INTEGER) AS work_id,
              o_orderstatus AS status, o_orderdate AS data_agendada, CAST(NULL AS VARCHAR) AS nome_plano,
              CAST(NULL AS VARCHAR) AS local_name, CAST(NULL AS VARCHAR) AS local_full_name
       FROM orders o WHERE NOT EXISTS (SELECT 1 FROM od WHERE od.scheduled_work_id = CAST(o.o_orderkey AS VARCHAR))),
u AS (SELECT * FROM od UNION ALL SELECT * FROM ob)
SELECT u.scheduled_work_id, u.work_id, u.status, u.data_agendada,
       COALESCE(u.nome_plano, p.nome_plano) AS nome_plano, COALESCE(u.local_name, p.local_name) AS local_name,
       COALESCE(u.local_full_name, p.local_full_name) AS local_full_name,
       CASE WHEN COALESCE(u.local_full_name, p.local_full_name) ILIKE 'nation 1 %' THEN 'ONE'
            ELSE trim(split_part(COALESCE(u.local_full_name, u.local_name, p.local_full_name, p.local_name), '-', 1))
       END AS hotel
FROM u LEFT JOIN p ON CAST(u.work_id AS VARCHAR) = p.work_id""")
def maintenance_views(spark, d):
    from tidewater.plans.maintenance import dim_plans, fact_occurrences
    c, o = t(spark, d, "customer"), t(spark, d, "orders")
    s = lambda x: F.col(x).cast("string")
    none = F.lit(None).cast("string")
    plan_bulk = c.select(s("c_custkey").alias("work_id"), F.to_json(F.struct(
        F.struct(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("type")).alias("attributes"))).alias("data"))
    plan_det = c.filter(F.col("c_acctbal") > 0).select(s("c_custkey").alias("work_id"), F.to_json(F.struct(
        F.struct(s("c_custkey").alias("id"), F.struct(F.concat(F.lit("Plano "), "c_name").alias("name")).alias("attributes"))
        .alias("data"),
        _inc((F.lit("w"), F.lit("work_type"), F.col("c_mktsegment"), none),
             (F.lit("l"), F.lit("location"), F.concat(F.lit("Local "), s("c_nationkey")),
              F.concat(F.lit("Nation "), s("c_nationkey"), F.lit(" - "), "c_mktsegment"))).alias("included"))).alias("data"))
    start = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    attrs = F.struct(F.col("o_custkey").alias("work_id"), F.col("o_orderstatus").alias("state"), start.alias("start_date"))
    occ_bulk = o.select(s("o_orderkey").alias("scheduled_work_id"), F.to_json(F.struct(attrs.alias("attributes"))).alias("data"))
    occ_det = o.filter(F.col("o_orderstatus") == "F").select(s("o_orderkey").alias("scheduled_work_id"), F.to_json(F.struct(
        F.struct(attrs.alias("attributes")).alias("data"),
        _inc((F.lit("l"), F.lit("location"), F.concat(F.lit("Sala "), "o_orderpriority"), none),
             (F.lit("w"), F.lit("work"), F.concat(F.lit("Trabalho "), s("o_orderkey")), none)).alias("included"))).alias("data"))
    plans = dim_plans(plan_det, plan_bulk, MAINTENANCE_RULES)
    occ = fact_occurrences(occ_det, occ_bulk, plans, MAINTENANCE_RULES)
    return occ.select("scheduled_work_id", "work_id", "status", "data_agendada", "nome_plano", "local_name",
                      "local_full_name", "hotel")


# Fixed values of the stand-in: event type -> registry action.
ACTION_OF_EVENT = {"view": "STARTED", "purchase": "PAUSED", "signup": "RESUMED", "error": "COMPLETED", "click": "CREATED"}


@query("work_hours_docs", """
WITH r AS (SELECT user_id, CAST(ts AS DATE) AS dia, event_id, ts,
                  CASE event_type WHEN 'view' THEN 'STARTED' WHEN 'purchase' THEN 'PAUSED' WHEN 'signup' THEN 'RESUMED'
                                  WHEN 'error' THEN 'COMPLETED' WHEN 'click' THEN 'CREATED' END AS action
           FROM events),
o AS (SELECT *, lead(ts) OVER w AS next_ts, lead(action) OVER w AS next_action
      FROM r WINDOW w AS (PARTITION BY user_id, dia ORDER BY ts, event_id))
SELECT CAST(user_id AS VARCHAR) || '-' || strftime(dia, '%Y-%m-%d') AS failure_id,
       CAST(user_id AS INTEGER) AS operator_id, action AS status_inicio, next_action AS status_fim,
       ts AS data_inicio, next_ts AS data_fim,
       (epoch_us(next_ts) - epoch_us(ts)) / CAST(3600000000 AS DOUBLE) AS horas_decimais
FROM o WHERE action IN ('STARTED', 'RESUMED') AND next_action IN ('PAUSED', 'COMPLETED') AND next_ts IS NOT NULL""")
def work_hours_docs(spark, d):
    """V4 over detail documents: many documents of one ticket (user and day),
    each with the event (owner = user) and one registry, so that no group is
    collected."""
    from tidewater.plans.maintenance import work_hours
    e = t(spark, d, "events").withColumn("dia", F.to_date("ts"))
    attrs = lambda op, ev, act, dt: F.struct(op.alias("operator_id"), ev.alias("event_id"), act.alias("action"),
                                             dt.alias("date"))
    reg = F.struct(F.col("event_id").cast("string").alias("id"), F.lit("event_registry").alias("type"),
                   attrs(F.col("user_id"), F.lit(1).cast("bigint"), map_code("event_type", ACTION_OF_EVENT, fallback=None),
                         F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")).alias("attributes"))
    fid = F.concat_ws("-", F.col("user_id").cast("string"), F.col("dia").cast("string"))
    owner = F.struct(F.lit("1").alias("id"), F.lit("event").alias("type"),
                     attrs(F.col("user_id"), F.lit(None).cast("bigint"), F.lit(None).cast("string"),
                           F.lit(None).cast("string")).alias("attributes"))
    details = e.select(fid.alias("failure_id"),
                       F.to_json(F.struct(F.struct(fid.alias("id")).alias("data"), F.array(owner, reg).alias("included"))).alias("data"))
    return work_hours(details, "failure_id").select("failure_id", "operator_id", "status_inicio", "status_fim",
                                                    "data_inicio", "data_fim", "horas_decimais")


# ------------------------------------------------------------------ output presentation

# Day columns of the registered outputs leave as midnight TIMESTAMPs in both
# engines: Spark hands a DATE to pandas as datetime.date objects, DuckDB as
# datetime64, so a value-level comparison would see '2024-01-01' against
# '2024-01-01 00:00:00'. As timestamps both are datetime64 (the library
# functions themselves still return DATE).
DAY_COLUMNS = {
    "daily_mart": ["data"], "monthly_revenue": ["mes"], "counts_by_group": ["dia"], "ledger_by_day": ["dia"],
    "mart_filters": ["data"], "missing_days": ["dia"], "date_chunks": ["chunk_inicio", "chunk_fim"],
    "calendar": ["data"], "date_parts": ["dia"], "measures_by_calendar": ["data"],
    "ledger_recent": ["data_emissao"], "daily_recent": ["data"],
}


def _days_as_timestamps(name: str, cols: list[str]) -> None:
    fn = QUERIES[name]

    def run(spark, d, _fn=fn, _cols=tuple(cols)):
        df = _fn(spark, d)
        return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in _cols else F.col(c) for c in df.columns])
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[name] = run
    repl = ", ".join(f"CAST({c} AS TIMESTAMP) AS {c}" for c in cols)
    ORACLE[name] = f"SELECT * REPLACE ({repl}) FROM (\n{ORACLE[name]}\n) AS q"


for _name, _cols in DAY_COLUMNS.items():
    _days_as_timestamps(_name, _cols)


# SURVEY §2 ids whose own function a registered query runs; ``audit_queries`` adds the named queries and views.
COVERS = {
    "daily_mart": "V11 G1 F11", "sales_status": "V10 F5 G3 J1 J6", "missing_side": "P10", "measures": "G10",
    "monthly_revenue": "F12", "counts_by_group": "G7", "ledger_by_day": "G6", "checks_items_value": "G4",
    "overlap": "G2", "distinct_tuple": "G5", "table_counts": "G8 U2", "top_products": "O3 G6",
    "json_projection": "F1 F2", "json_roundtrip": "F1 F2", "first_in_array": "A1 J10 O5 G9",
    "explode_filter": "A2 J11 G9", "work_intervals": "W1 F6", "hours_per_operator": "G6", "prefer_detail": "U1 J7",
    "location_to_hotel": "F4 P3 F9", "resolve_two_stage": "J4 J5 F7 C1", "exists_flag": "J6", "gap_anti": "J8 J9 P5",
    "orphans": "J7", "value_gap": "P9 F13", "owner_join": "J2 K2", "note_facts": "V8 J3 F15",
    "plans_occurrences": "F4 D1", "by_state": "P1", "period_rows": "P6", "recent_days": "P8", "key_lookup": "P14 O1",
    "group_items_ordered": "P11 P12", "mart_filters": "P13 T7", "lookback": "T2 P8", "missing_days": "T4 F21",
    "date_chunks": "T3", "calendar": "F21", "unit_price": "F3 F8 F14", "date_parts": "F10 F15 X1 X2",
    "text_slice": "F22", "id_list": "S10 U3 F16", "dedupe_last": "K2", "upsert_state": "K1 K2",
    "soft_delete": "K5 T5 F20", "xml_notes": "S5 F16 F17", "xml_cancels": "S6", "sectioned_json": "S3 C1 A3",
    "nested_array_json": "S4 C1 A3", "export_groups": "K7 G9 F18 F19", "export_text": "K7 G9 F18 F19",
    "ledger_fact": "V6 J4 J5 J6", "measures_by_calendar": "Q31 G10 F21", "paged_envelopes": "S1",
    "detail_envelopes": "S2", "json_array": "S7", "dead_letters": "S14", "export_receipts": "K8 G9",
    "ledger_recent": "Q29 V6 P8", "sales_notes_recent": "Q29 V10 P8", "daily_recent": "Q15 V11 P8",
    "maintenance_views": "V2 V3 U1 A1 F4", "work_hours_docs": "V4 A2 J2 W1 F6",
}
