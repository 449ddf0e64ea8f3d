"""Maintenance views (V1-V5) over bronze tables ``(key, data, extracted_at)``.

Bulk documents have ``attributes`` at the root; detail documents have an
extra ``data`` level and an ``included`` array of ``{id, type, attributes}``.
Site prefix rules for ``hotel_of`` are deployment data: pass ``site_rules``
as ``[(prefix, code), ...]`` (four entries in the reference deployment).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.arrays import first_of_type
from tidewater.functions.json_paths import doc_as, project
from tidewater.functions.scalar import hotel_of
from tidewater.operators.joins import left_lookup, prefer
from tidewater.operators.windows import work_intervals
from tidewater.fixed_values import LOCATION_TYPES

INCLUDED = "array<struct<id: string, type: string, attributes: map<string, string>>>"

OPERATOR_SPEC = [
    ("nome_operador", "attributes.full_name", "text"),
    ("email", "attributes.email", "text"),
    ("telefone", "attributes.phone", "text"),
    ("celular", "attributes.cellphone", "text"),
    ("tipo_conta", "attributes.account", "text"),
    ("custo_por_hora", "attributes.cost_per_hour", "numeric"),
    ("warehouse_id", "attributes.warehouse_id", "integer"),
    ("entity_id", "attributes.entity_id", "integer"),
    ("fuso_horario", "attributes.timezone", "text"),
    ("is_from_network", "attributes.is_from_network", "boolean"),
    ("data_criacao_origem", "attributes.created_at", "timestamp"),
]

PLAN_SPEC = [
    ("nome_plano", "name", "text"), ("descricao", "description", "text"), ("tipo_plano", "type", "text"),
    ("periodicidade", "periodicity", "text"), ("frequencia", "recurrence.FREQ", "text"),
    ("intervalo_frequencia", "recurrence.INTERVAL", "text"),
    ("data_inicio_recorrencia", "recurrence.DTSTART", "text"),
    ("client_id", "client_id", "integer"), ("entity_id", "entity_id", "integer"),
    ("supplier_id", "supplier_id", "integer"), ("cost_center_id", "cost_center_id", "integer"),
    ("work_type_id", "work_type_id", "integer"), ("auto_close", "auto_close", "boolean"),
    ("auto_pilot", "auto_pilot", "boolean"),
]

OCCURRENCE_SPEC = [
    ("work_id", "work_id", "integer"), ("status", "state", "text"), ("visita_numero", "visit", "integer"),
    ("entity_id", "entity_id", "integer"), ("running", "running", "boolean"),
    ("data_agendada", "start_date", "timestamp"), ("data_agendada_original", "original_start_date", "timestamp"),
    ("data_inicio_real", "real_start_date", "timestamp"), ("data_conclusao", "completed_date", "timestamp"),
    ("data_ultima_alteracao", "last_status_change_date", "timestamp"),
    ("percentual_conclusao", "completed_percentage", "numeric"),
    ("tempo_execucao_iso", "time_running", "text"), ("duracao_mao_de_obra_iso", "manpower_duration", "text"),
    ("custo_mao_de_obra", "manpower_cost", "numeric"), ("started_by_id", "started_by_id", "integer"),
    ("completed_by_id", "completed_by_id", "integer"),
]


def dim_operators(raw: DataFrame, key: str = "operator_id") -> DataFrame:
    """V1: operator dimension, 11 typed attributes."""
    return (project(raw, "data", OPERATOR_SPEC, keep=[key, "extracted_at"])
            .withColumnRenamed("extracted_at", "data_ultima_sincronizacao"))


def _attrs(raw: DataFrame, key: str, spec, root: str, lookups: dict) -> DataFrame:
    """Typed attributes at ``root`` + first-of-type lookups in ``included``."""
    full = [(n, f"{root}.{p}" if root else f"attributes.{p}", t) for n, p, t in spec]
    s = project(raw.withColumn("_inc", doc_as(raw, "data", "$.included", INCLUDED)),
                "data", full, keep=[key, "extracted_at", "_inc"])
    for name, (types, field) in lookups.items():
        s = s.withColumn(name, first_of_type("_inc", types).getField("attributes").getItem(field))
    return s.drop("_inc")


def _plan_rows(raw: DataFrame, detail: bool) -> DataFrame:
    lookups = {"local_name": (LOCATION_TYPES, "name"), "local_full_name": (LOCATION_TYPES, "full_name"),
               "work_type_name": (("work_type",), "name")}
    return _attrs(raw, "work_id", PLAN_SPEC, "data.attributes" if detail else "", lookups)


def dim_plans(details: DataFrame, bulk: DataFrame, site_rules: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """V2: plan rows from details, plus bulk rows with no detail (U1); first
    location and work type from ``included``; site from the location."""
    u = prefer(_plan_rows(details, True), _plan_rows(bulk, False), "work_id")
    return u.withColumn("hotel", hotel_of("local_full_name", ["local_full_name", "local_name"], site_rules))


def _occurrence_rows(raw: DataFrame, detail: bool) -> DataFrame:
    lookups = {"local_name": (LOCATION_TYPES, "name"), "local_full_name": (LOCATION_TYPES, "full_name"),
               "nome_plano": (("work",), "name"), "work_type_name": (("work_type",), "name")}
    return _attrs(raw, "scheduled_work_id", OCCURRENCE_SPEC, "data.attributes" if detail else "", lookups)


def with_plan(occ: DataFrame, plans: DataFrame, site_rules: Sequence[tuple[str, str]] = (),
              key: str = "work_id",
              names: Sequence[str] = ("nome_plano", "work_type_name", "local_name", "local_full_name")) -> DataFrame:
    """V3's second half: left join to the plan (keys compared as text, D1) and
    ``COALESCE(own, plan)`` per name, then the site from the merged names."""
    p = plans.select(F.col(key).cast("string").alias("_pk"), *[F.col(n).alias(f"_p_{n}") for n in names])
    j = left_lookup(occ.withColumn("_ok", F.col(key).cast("string")), p, "_ok", "_pk", [f"_p_{n}" for n in names])
    out = j
    for n in names:
        out = out.withColumn(f"_own_{n}", F.col(n)).withColumn(n, F.coalesce(F.col(n), F.col(f"_p_{n}")))
    site = hotel_of(F.coalesce(F.col("_own_local_full_name"), F.col("_p_local_full_name")),
                    ["_own_local_full_name", "_own_local_name", "_p_local_full_name", "_p_local_name"], site_rules) \
        if "local_full_name" in names else F.lit(None).cast("string")
    return out.withColumn("hotel", site).drop("_ok", *[f"_p_{n}" for n in names], *[f"_own_{n}" for n in names])


def fact_occurrences(details: DataFrame, bulk: DataFrame, plans: DataFrame,
                     site_rules: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """V3: occurrence fact -- detail else bulk, three ``included`` lookups,
    then plan names where its own are missing.

    Note: plans must be unique per ``work_id`` (V2 is: details and bulk are
    keyed tables and U1 keeps one of the two)."""
    u = prefer(_occurrence_rows(details, True), _occurrence_rows(bulk, False), "scheduled_work_id")
    return with_plan(u, plans, site_rules)


def work_hours(details: DataFrame, parent: str) -> DataFrame:
    """V4 (``parent='failure_id'``) and V5 (``'scheduled_work_id'``).

    Events and their registries live in the same document's ``included``
    array, so each registry gets its event's owner inside the document
    (a higher-order lookup, J2 on (parent, event) without a shuffle); the
    registries are then exploded (A2), those without an owner dropped (D17),
    paired with the next action (W1, the only shuffle) and turned into hours
    (F6)."""
    inc = F.coalesce(doc_as(details, "data", "$.included", INCLUDED), F.array())
    events = F.filter(inc, lambda x: x["type"] == "event")
    eid = lambda x: x["attributes"].getItem("event_id").try_cast("bigint")
    owner = lambda r: F.get(F.filter(events, lambda e: e["id"].try_cast("bigint") == eid(r)), 0)["attributes"] \
        .getItem("operator_id").try_cast("int")
    regs = F.transform(F.filter(inc, lambda x: x["type"] == "event_registry"),
                       lambda r: F.struct(eid(r).alias("event_id"), r["attributes"].getItem("action").alias("action"),
                                          r["attributes"].getItem("date").try_cast("timestamp_ntz").alias("event_time"),
                                          r["id"].try_cast("bigint").alias("event_registry_id"),
                                          owner(r).alias("operator_id")))
    reg = details.select(parent, F.explode(regs).alias("r")).select(parent, "r.*")
    return work_intervals(reg, parent=parent)
