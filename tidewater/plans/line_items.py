"""POS line items, typed (bronze ``(line_item_id, data, extracted_at)``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.json_paths import project
from tidewater.functions.scalar import full_name, is_one, unit_price

LINE_ITEM_SPEC = [
    ("data_negocio", "businessDate", "text"),
    ("hotel", "locationName", "text"),
    ("hotel_codigo", "hotel", "text"),
    ("tipo_pedido", "orderTypeName", "text"),
    ("comanda_id", "guestCheckID", "bigint"),
    ("numero_comanda", "checkNum", "integer"),
    ("numero_linha", "lineNum", "integer"),
    ("centro_receita_num", "revenueCenterNum", "integer"),
    ("centro_receita", "revenueCenterName", "text"),
    ("grupo", "majorGroupName", "text"),
    ("subgrupo", "familyGroupName", "text"),
    ("codigo_produto", "menuItemNum", "integer"),
    ("produto", "menuItemName1", "text"),
    ("quantidade", "lineCount", "integer"),
    ("numerador", "numerator", "integer"),
    ("valor_total", "lineTotal", "numeric"),
    ("_first", "transactionEmployeeFirstName", "text"),
    ("_last", "transactionEmployeeLastName", "text"),
    ("_void", "isVoidFlag", "text"),
    ("dt_transacao", "transactionDateTime", "timestamp"),
]


def fact_line_items(raw: DataFrame) -> DataFrame:
    """Typed line items + unit price (F3) + employee name (F8) + void
    flag (F14). ``hotel`` is the location name (D5); ``hotel_codigo`` the
    canonical code the parser added."""
    s = project(raw, "data", LINE_ITEM_SPEC, keep=["line_item_id", "extracted_at"])
    return (s.withColumn("valor_unitario", unit_price("valor_total", "quantidade"))
             .withColumn("colaborador", full_name("_first", "_last"))
             .withColumn("cancelado", is_one("_void"))
             .drop("_first", "_last", "_void"))


def internal_consumption_export(raw: DataFrame, day: str, config: DataFrame | None = None,
                                location: str | None = None) -> DataFrame:
    """Q30 + K7: the day's internal-consumption documents, one per location, as ordered lines."""
    from tidewater.plans.audits import internal_items, items
    from tidewater.sinks.export import export_documents, sale_record, with_config
    it = internal_items(items(raw), day, location)
    it = with_config(it, config, "location_name")
    venda = sale_record("revenueCenterNum", "menuItemNum", "valor", "lineCount")
    return export_documents(it, ["location_name"], ["comanda_id", "numero_linha"], venda, F.lit(day))
