"""K7 / K8: one nested document per group (site, day), as ordered lines.

A document is written as text lines, never as one array or string that holds a
group: a header line, a line per item, a footer line, each with the place it
has in its group. ``write_documents`` range-partitions the lines by (group,
place), so the part files of a group's folder, read in name order, are the one
document of that group, whatever its size and however many tasks wrote it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.scalar import config_key, export_quantity, export_unit_price, int_or_zero
from tidewater.fixed_values import EXPORT_REQUEST_CONSTANTS, EXPORT_UNIT
from tidewater.session import scratch_dir

REQUEST_CONSTANTS = EXPORT_REQUEST_CONSTANTS


def with_config(items: DataFrame, config: DataFrame | None, name_col: str) -> DataFrame:
    """per-site settings keyed by ``upper(name)`` with spaces -> ``_``.

    ``config`` has ``config_key, EmpresaId, CodigoDaEmpresa, ChaveDeAcesso,
    EmissordoCupom`` (one row per site -- tiny, so AQE broadcasts it by size).
    Missing settings give '' and ``EmpresaId`` 0."""
    items = items.withColumn("_cfg", config_key(F.col(name_col)))
    if config is None:
        return items.select("*", F.lit(0).alias("EmpresaId"), F.lit("").alias("CodigoDaEmpresa"),
                            F.lit("").alias("ChaveDeAcesso"), F.lit("").alias("EmissordoCupom"))
    c = config.select(F.col("config_key").alias("_ck"), int_or_zero("EmpresaId").alias("EmpresaId"),
                      F.coalesce("CodigoDaEmpresa", F.lit("")).alias("CodigoDaEmpresa"),
                      F.coalesce("ChaveDeAcesso", F.lit("")).alias("ChaveDeAcesso"),
                      F.coalesce("EmissordoCupom", F.lit("")).alias("EmissordoCupom"))
    j = items.join(c, items["_cfg"] == c["_ck"], "left").drop("_ck")
    return j.fillna({"EmpresaId": 0, "CodigoDaEmpresa": "", "ChaveDeAcesso": "", "EmissordoCupom": ""})


def sale_record(pdv_code, item_code, total, count, serial="EmissordoCupom") -> Column:
    """one ``Venda`` -- codes as text ('' when missing, so every Venda has
    the same keys), unit 'UN', quantity ``count or 1``, unit price HALF_UP to
    2 places (D9: decimal, not binary float)."""
    c = lambda x: F.col(x) if isinstance(x, str) else x
    return F.struct(
        F.coalesce(c(pdv_code).cast("string"), F.lit("")).alias("CodigoPDV"),
        F.coalesce(c(serial), F.lit("")).alias("EmissordoCupom"),
        F.coalesce(c(item_code).cast("string"), F.lit("")).alias("CodigoExterno"),
        F.lit(EXPORT_UNIT).alias("UnidadeMedida"),
        export_quantity(c(count)).cast("double").alias("Quantidade"),
        export_unit_price(c(total), c(count)).cast("double").alias("ValorUnitario"))


def _place(section: int, *keys: Column, sub: int = 0) -> Column:
    return F.struct(F.lit(section).alias("section"), *[k.alias(f"o{i}") for i, k in enumerate(keys)], F.lit(sub).alias("sub"))


def _no_keys(df: DataFrame, cols: Sequence[str]) -> list[Column]:
    types = dict(df.dtypes)
    return [F.lit(None).cast(types[c]) for c in cols]


def _evaluated_once(rows: DataFrame) -> DataFrame:
    """The rows of an export, which its header, item and footer lines all read:
    checkpointed, so that the input (joins and all) is read once."""
    scratch_dir(rows.sparkSession)
    return rows.checkpoint(eager=True)


def export_documents(items: DataFrame, group: Sequence[str], order: Sequence[str], venda: Column,
                     movement_date: Column) -> DataFrame:
    """K7: ``(group..., place, line)``, one JSON document per group.

    ``items`` carries the F18 config columns (``with_config``) and the order
    columns, a total order within a group; ``venda`` is the per-item struct
    (``sale_record``). The header has the settings of the first item."""
    group, order = list(group), list(order)
    hdr = ["EmpresaId", "CodigoDaEmpresa", "ChaveDeAcesso"]
    rows = items.select(*group, *[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)], *hdr,
                        venda.alias("_venda"), movement_date.alias("_date"))
    rows = _evaluated_once(rows)
    keys = [f"_o{i}" for i in range(len(order))]
    at = F.struct(*keys)
    heads = rows.groupBy(*group).agg(F.min(at).alias("_first"), F.min_by(F.struct(*hdr, "_date"), at).alias("_h"))
    fields = F.struct(F.col("_h.EmpresaId").alias("EmpresaId"), *[F.lit(v).alias(k) for k, v in REQUEST_CONSTANTS.items()],
                      F.col("_h._date").alias("DataDoMovimento"), F.col("_h.CodigoDaEmpresa").alias("CodigoDaEmpresa"),
                      F.col("_h.ChaveDeAcesso").alias("ChaveDeAcesso"))
    opening = F.concat(F.regexp_replace(F.to_json(fields), r"\}$", ""), F.lit(',"Vendas":{"Venda":['))
    none = _no_keys(rows, keys)
    firsts = heads.select(*[F.col(x).alias(f"_g{i}") for i, x in enumerate(group)], "_first")
    same = [F.col(x).eqNullSafe(F.col(f"_g{i}")) for i, x in enumerate(group)]
    joined = rows.join(firsts, same, "left")
    item = F.concat(F.when(at == F.col("_first"), F.lit("")).otherwise(F.lit(",")), F.to_json("_venda"))
    return (heads.select(*group, _place(0, *none).alias("place"), opening.alias("line"))
            .unionByName(joined.select(*group, _place(1, *[F.col(k) for k in keys]).alias("place"), item.alias("line")))
            .unionByName(heads.select(*group, _place(2, *none).alias("place"), F.lit("]}}").alias("line"))))


def export_receipts_xml(items: DataFrame, group: Sequence[str], check: str, check_fields: Mapping[str, Column],
                        item_fields: Mapping[str, Column], order: Sequence[str]) -> DataFrame:
    """K8: ``(group..., place, line)`` of ``Vendas/PDVVenda[...]/Itens/Item[...]``:
    one XML document per group, one receipt per check with header fields (those
    of its first item) and its items."""
    group, order = list(group), list(order)
    rows = items.select(*group, F.col(check).alias("_check"), *[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)],
                        F.struct(*[c.alias(n) for n, c in check_fields.items()]).alias("_head"),
                        F.struct(*[c.alias(n) for n, c in item_fields.items()]).alias("_item"))
    rows = _evaluated_once(rows)
    keys = [f"_o{i}" for i in range(len(order))]
    c, none = F.col("_check"), _no_keys(rows, keys)
    flat = lambda x, tag: F.regexp_replace(F.to_xml(x, {"rowTag": tag}), r"\n\s*", "")
    checks = rows.groupBy(*group, "_check").agg(F.min_by("_head", F.struct(*keys)).alias("_head"))
    groups = checks.select(*group).distinct()
    no_check = _no_keys(rows, ["_check"])
    lines = [groups.select(*group, _place(0, *no_check, *none).alias("place"), F.lit("<Vendas>").alias("line")),
             checks.select(*group, _place(1, c, *none, sub=0).alias("place"),
                           F.regexp_replace(flat(F.col("_head"), "PDVVenda"), "</PDVVenda>$", "<Itens>").alias("line")),
             rows.select(*group, _place(1, c, *[F.col(k) for k in keys], sub=1).alias("place"), flat(F.col("_item"), "Item").alias("line")),
             checks.select(*group, _place(2, c, *none).alias("place"), F.lit("</Itens></PDVVenda>").alias("line")),
             groups.select(*group, _place(3, *no_check, *none).alias("place"), F.lit("</Vendas>").alias("line"))]
    # a receipt's closing line follows its items: sections 1 and 2 are one, told apart by ``end``
    out = lines[0]
    for x in lines[1:]:
        out = out.unionByName(x)
    p = F.col("place")
    body = p["section"].isin(1, 2)
    return out.withColumn("place", F.struct(
        F.when(body, 1).otherwise(p["section"]).alias("section"), p["o0"].alias("check"),
        F.when(p["section"] == 2, 1).otherwise(0).alias("end"), *[p[f"o{i + 1}"].alias(f"o{i}") for i in range(len(order))], p["sub"].alias("sub")))


def write_documents(lines: DataFrame, out: str, group: Sequence[str]) -> None:
    """One folder per group; its part files, in name order, are its document."""
    places = [F.col(f"place.{f.name}") for f in lines.schema["place"].dataType.fields]
    ordered = lines.repartitionByRange(*[F.col(g) for g in group], *places).sortWithinPartitions(*[F.col(g) for g in group], *places)
    ordered.select(*group, "line").write.mode("overwrite").partitionBy(*group).text(out)


def document_text(lines: DataFrame, group: Sequence[str]) -> DataFrame:
    """``(group..., document)``: each document as one string, for groups known to be small (tests, previews)."""
    return lines.groupBy(*group).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "line"))),
                                                              lambda x: x["line"]), "\n").alias("document"))


def checked_documents(lines: DataFrame, group: Sequence[str]) -> DataFrame:
    """``(group..., valid, items, first, last)`` of K7 documents of any size, from
    their lines: whether header, items and footer make one JSON document, the
    number of items, and ``CodigoExterno`` of the first and last by place. Each
    line is parsed in its own row; only counts, minima and maxima meet."""
    section, place = F.col("place.section"), F.col("place")
    item = section == 1
    # the rest of the document as it would close around the line: a line that is not one value fails or counts as more
    whole = F.when(section == 0, F.concat("line", F.lit("]}}"))).when(item, F.concat(F.lit('{"Vendas":{"Venda":['), F.regexp_replace("line", "^,", ""), F.lit("]}}")))
    x = lines.select(*group, "line", "place", F.try_parse_json(whole).alias("_doc"))
    venda = F.try_variant_get("_doc", "$.Vendas.Venda", "array<struct<CodigoExterno: string>>")
    x = x.withColumn("_venda", venda)
    good = F.when(section == 0, F.size("_venda") == 0).when(item, F.size("_venda") == 1).otherwise(F.col("line") == "]}}")
    comma = F.col("line").startswith(",")
    code, at = F.get("_venda", F.lit(0))["CodigoExterno"], F.when(item, place)
    count = lambda c: F.count(F.when(c, True))
    found = x.groupBy(*group).agg(
        count(item).alias("items"), count(section == 0).alias("_heads"), count(section == 2).alias("_feet"),
        count(~F.coalesce(good, F.lit(False))).alias("_bad"), count(item & ~comma).alias("_bare"),
        F.min_by(comma, at).alias("_comma"), F.min_by(code, at).alias("first"), F.max_by(code, at).alias("last"))
    valid = "_heads = 1 and _feet = 1 and _bad = 0 and _bare = least(items, 1) and not coalesce(_comma, false)"
    return found.select(*group, F.expr(valid).alias("valid"), "items", "first", "last")
