"""A1-A3: embedded arrays and record merge, as higher-order functions.

No ``explode ... LIMIT 1`` lateral: that plan joins on the array and loses the
array order. ``filter`` + ``get`` keeps the order and stays per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def of_types(type_field: str, types: Sequence[str]):
    types = list(types)
    return lambda x: x.getField(type_field).isin(types)


def first_of_type(arr, types: Sequence[str], type_field: str = "type") -> Column:
    """First element whose ``type`` is in ``types`` (array
    order), NULL when none or when the array is NULL."""
    return F.get(F.filter(_c(arr), of_types(type_field, types)), 0)


def first_where(arr, pred) -> Column:
    """A1 with any predicate ``x -> Column``."""
    return F.get(F.filter(_c(arr), pred), 0)


def explode_type(df: DataFrame, arr, types: Sequence[str], keep: Sequence[str],
                 alias: str = "val", type_field: str = "type") -> DataFrame:
    """One row per element of ``type`` (``COALESCE(arr, '[]')``)."""
    a = F.coalesce(_c(arr), F.array())
    return df.select(*[F.col(k) for k in keep],
                     F.explode(F.filter(a, of_types(type_field, types))).alias(alias))


def merge_record(added, rec) -> Column:
    """A3: ``{**added, **rec}`` on maps: added keys first, the record wins on
    a clash. Independent of ``spark.sql.mapKeyDedupPolicy``."""
    added, rec = _c(added), _c(rec)
    return F.map_concat(
        F.map_filter(added, lambda k, v: ~F.array_contains(F.map_keys(rec), k)), rec)
