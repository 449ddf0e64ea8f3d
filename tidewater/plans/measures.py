"""G10 measures and Q31 (measures by calendar day)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.aggregates import count_where, mart
from tidewater.operators.incremental import calendar
from tidewater.operators.joins import left_lookup
from tidewater.fixed_values import STATUS_AUTHORISED, STATUS_CANCELLED, STATUS_PENDING


def measure_columns(status: str = "status", value: str = "valor_total") -> dict[str, Column]:
    """The six measures as aggregate Columns (filter context = condition).

    An empty context sums to NULL (a blank in the BI tool); counts give 0."""
    st = F.col(status)
    auth = st == STATUS_AUTHORISED
    return {
        "faturamento_total": F.sum(F.when(st != STATUS_CANCELLED, F.col(value))),
        "notas_autorizadas": count_where(auth),
        "notas_canceladas": count_where(st == STATUS_CANCELLED),
        "pendentes_sefaz": count_where(st == STATUS_PENDING),
        "nfe_sem_fiscal": count_where(auth & ~F.col("tem_fiscal")),
        "nfe_sem_pdv": count_where(auth & ~F.col("tem_pdv")),
    }


def measures(sales: DataFrame, by: Sequence) -> DataFrame:
    """All six measures for any grouping of V10."""
    return mart(sales, list(by), measure_columns())


def measures_by_calendar(sales: DataFrame, span: DataFrame, day_col: str = "data_emissao") -> DataFrame:
    """Q31: one row per calendar day (F21) with the measures of that day;
    days without notes are kept (counts 0, revenue NULL)."""
    per_day = measures(sales.withColumn("_d", F.to_date(day_col)), ["_d"])
    cal = calendar(span)
    names = list(measure_columns().keys())
    out = left_lookup(cal, per_day, "data", "_d", names)
    for n in names:
        if n != "faturamento_total":
            out = out.withColumn(n, F.coalesce(F.col(n), F.lit(0).cast("bigint")))
    return out
