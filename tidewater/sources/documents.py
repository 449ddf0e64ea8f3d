"""Document parsers (S1-S7, S10, S14). Each takes rows of
``(value, file_path, file_name)`` -- batch or stream -- and returns bronze
rows ``(key, data VARIANT, arrival)`` plus, where the reference raises, rejects
``(file_name, error)`` instead of an exception. Each file is parsed once;
documents stay binary VARIANT from there on (``to_json`` when text is needed).

The parsers of JSON files take ``errors=True``: their output then has a column
``error`` and at least one row for every file that was read: a file of the
wrong shape gives one row with its error, a file without records one row
without key and error. ``records`` and ``rejects`` tell them apart, so that a
job parses once, keeps what is good and reports what is not.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.arrays import merge_record
from tidewater.functions.json_paths import once
from tidewater.functions.scalar import clean_key, digits, map_code
from tidewater.operators.joins import left_lookup, one_per_key, without
from tidewater.session import scratch_dir
from tidewater.sources.arrays import GROUP_BYTES, scan_arrays
from tidewater.sources.files import arrival, strip_bom


def _as_map(v: Column) -> Column:
    """A VARIANT object as map<string,variant>; NULL for anything else."""
    return F.try_variant_get(v, "$", "map<string,variant>")


def _with_fields(rec: Column, **cols: Column) -> Column:
    """A3: ``{**added, **rec}`` as a VARIANT object; ``rec`` is a VARIANT
    object and wins on a clash. No text is produced: bronze documents are
    stored as VARIANT (``to_json`` gives the JSON text when needed)."""
    added = _as_map(F.to_variant_object(F.struct(*[c.alias(k) for k, c in cols.items()])))
    return F.to_variant_object(merge_record(added, _as_map(rec)))


def _elements(files: DataFrame, p: str) -> DataFrame:
    """Adds ``pos``, ``e`` (elements of the JSON array at path ``p`` of the VARIANT
    ``v``) and ``error``; one row with a NULL ``e`` where there are none."""
    arr = F.try_variant_get("v", p, "array<variant>")
    error = (F.when(F.col("v").isNull(), F.lit("not JSON"))
              .when(arr.isNull(), F.lit(f"no array at {p}")))
    rows = files.select("*", error.alias("error"), arr.alias("_arr"))
    return rows.select(*files.columns, "error", F.posexplode_outer("_arr").alias("pos", "e"))


def _when(files: DataFrame) -> list[Column]:
    """The parts of ``arrival`` that a file has, as plain columns (see ``_arrived``)."""
    at = arrival(files)
    return [at["day"].alias("_day"), at["time"].alias("_time")]


def _arrived() -> Column:
    return F.struct(F.col("_day").alias("day"), F.col("_time").alias("time"), F.col("file_name").alias("name"),
                    F.coalesce("pos", F.lit(0)).alias("pos")).alias("arrival")


def _out(rows: DataFrame, errors: bool) -> DataFrame:
    return rows if errors else rows.filter(F.col("error").isNull() & F.col("key").isNotNull()).drop("error")


def records(parsed: DataFrame) -> DataFrame:
    """The good rows of a parse with ``errors=True``."""
    return _out(parsed, False)


def rejects(parsed: DataFrame) -> DataFrame:
    """``(file_name, error)`` of a parse with ``errors=True``."""
    return parsed.filter(F.col("error").isNotNull()).select("file_name", "error")


# ---------------------------------------------------------------- S1 / S2


def parse_paged_envelopes(pages: DataFrame, errors: bool = False) -> DataFrame:
    """``data[]`` of every landed list page; ``included`` of list pages
    is dropped (D18). Columns: key, data, page, total_pages, file_name, arrival.
    Each page is parsed once (VARIANT)."""
    rows = pages.select("file_name", *_when(pages), once(F.try_parse_json("value"), "v"))
    rows = rows.select(
        "file_name", "_day", "_time", "v",
        F.coalesce(F.try_variant_get("v", "$.meta.pagination.current_page", "int"), F.lit(1)).alias("page"),
        F.coalesce(F.try_variant_get("v", "$.meta.pagination.total_pages", "int"), F.lit(1)).alias("total_pages"))
    rows = _elements(rows, "$.data")
    return _out(rows.select(F.try_variant_get("e", "$.id", "string").alias("key"), F.col("e").alias("data"),
                            "page", "total_pages", "file_name", _arrived(),
                            "error"), errors)


def page_completeness(rows: DataFrame) -> DataFrame:
    """S1 check, per list (the day in the file name): pages seen vs the last page
    announced. ``rows`` of ``errors=True`` count pages without records too."""
    return rows.groupBy(F.col("arrival.day").alias("day")).agg(
        F.count_distinct(F.when(F.col("error").isNull(), F.col("page")) if "error" in rows.columns else F.col("page")).alias("pages_seen"),
        F.max("total_pages").alias("total_pages"))


def incomplete_lists(rows: DataFrame) -> DataFrame:
    """The lists that lack pages; a load or a reconciliation must not use them."""
    return page_completeness(rows).filter(F.col("pages_seen") < F.col("total_pages"))


def parse_detail_envelopes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Detail envelopes; reject when ``data`` (or its id) is missing;
    hoist ``data.id`` to a root ``id``; ``included`` is kept."""
    rows = docs.select("file_name", arrival(docs), once(F.try_parse_json("value"), "v"))
    rows = rows.select("file_name", "arrival", "v", F.try_variant_get("v", "$.data.id", "string").alias("key"))
    ok = rows.filter(F.col("key").isNotNull()).select("key", _with_fields(F.col("v"), id=F.col("key")).alias("data"),
                                                      "file_name", "arrival")
    rejects = rows.filter(F.col("key").isNull()).select("file_name", F.lit("envelope without data").alias("error"))
    return ok, rejects


# ---------------------------------------------------------------- S3 / S4


def parse_sectioned_json(files: DataFrame, store_codes: Mapping[str, str],
                         key_field: str = "Invoice Data Info 8",
                         header_field: str = "Store Number", errors: bool = False) -> DataFrame:
    """S3: POS file ``[[header],[{}],[records],[{}]]``, parsed once per file.

    Site = code map of the header's store number (fallback: the number itself,
    '' when absent); records from section 2, objects only, non-blank trimmed
    key; each record gains ``id, hotel, source_file`` (its own fields win).
    A file of fewer sections has no records; one that is no JSON array is an error."""
    files = files.select("file_name", *_when(files), once(F.try_parse_json("value"), "v"))
    store = F.coalesce(F.try_variant_get("v", f"$[0][0]['{header_field}']", "string"), F.lit(""))
    sections = F.try_variant_get("v", "$", "array<variant>")
    rows = _elements(files.select("*", map_code(store, store_codes).alias("hotel"), sections.isNotNull().alias("_list"),
                                  (F.size(sections) > 2).alias("_has")), "$[2]")
    rows = rows.withColumn("error", F.when(F.col("_list") & ~F.col("_has"), None).otherwise(F.col("error")))
    return _out(_pos_records(rows, key_field, errors), errors)


def _pos_records(rows: DataFrame, key_field: str, errors: bool) -> DataFrame:
    key = F.trim(F.coalesce(F.try_variant_get("e", f"$['{key_field}']", "string"), F.lit("")))
    rows = rows.withColumn("key", F.when(_as_map(F.col("e")).isNotNull(), F.nullif(key, F.lit(""))))
    return _site_records(rows, errors)


def _site_records(rows: DataFrame, errors: bool) -> DataFrame:
    """Records with ``key`` and ``hotel`` gain ``id, hotel, source_file``; their own fields win."""
    return rows.select("key", "hotel", F.col("file_name").alias("source_file"),
                       F.when(F.col("key").isNotNull(), _with_fields(F.col("e"), id=F.col("key"), hotel=F.col("hotel"),
                                                                     source_file=F.col("file_name"))).alias("data"),
                       _arrived(), *(["file_name"] if errors else []), "error")


def parse_nested_array_json(files: DataFrame, location_codes: Mapping[str, str],
                            key_field: str = "guestCheckLineItemID",
                            code_field: str = "locationRef", errors: bool = False) -> DataFrame:
    """Line-item file ``[[rec, ...]]``; element 0; skip a falsy key
    (missing, null, 0, '', false); location code -> site, fallback the code."""
    files = files.select("file_name", *_when(files), once(F.try_parse_json("value"), "v"))
    return _out(_line_item_records(_elements(files, "$[0]"), location_codes, key_field, code_field, errors), errors)


def _line_item_records(rows: DataFrame, location_codes: Mapping[str, str], key_field: str, code_field: str, errors: bool) -> DataFrame:
    raw_key = F.try_variant_get("e", f"$.{key_field}", "string")
    falsy = raw_key.isNull() | raw_key.isin("0", "", "false", "0.0")
    code = F.coalesce(F.try_variant_get("e", f"$.{code_field}", "string"), F.lit(""))
    rows = rows.select("file_name", "_day", "_time", "pos", "e", "error", map_code(code, location_codes).alias("hotel"),
                       F.when(_as_map(F.col("e")).isNotNull() & ~falsy, F.try_variant_get("e", f"$.{key_field}", "bigint")).alias("key"))
    return _site_records(rows, errors)


# ---------------------------------------------------------------- S5 / S6

_IDE = "struct<mod: string, serie: string, nNF: string, dhEmi: string, tpAmb: string>"
_INF = (f"struct<_Id: string, ide: {_IDE}, emit: struct<CNPJ: string, xNome: string>, "
        "total: struct<ICMSTot: struct<vNF: string>>>")
NOTE_XML_SCHEMA = (f"NFe struct<infNFe: {_INF}>, infNFe {_INF}, "
                   "protNFe struct<infProt: struct<nProt: string, cStat: string, dhRecbto: string>>, "
                   "_corrupt_record string")
CANCEL_XML_SCHEMA = ("evento struct<infEvento: struct<_Id: string, CNPJ: string, chNFe: string, "
                     "dhEvento: string, tpEvento: string, nSeqEvento: string, "
                     "detEvento: struct<nProt: string, xJust: string>>>, _corrupt_record string")


def parse_note_xml(files: DataFrame, hotel: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Tax-note XML with or without the ``nfeProc`` envelope.

    Key = ``infNFe/@Id`` without the ``NFe`` prefix, else 44 digits of the file
    name; rejected unless 44 long. Keeps the whole XML in ``xml_content``."""
    rows = files.select("file_name", arrival(files), strip_bom("value").alias("xml_content"),
                        (hotel if hotel is not None else F.lit(None).cast("string")).alias("hotel"))
    rows = rows.select("*", once(F.from_xml("xml_content", NOTE_XML_SCHEMA), "x"))
    inf = F.coalesce(F.col("x.NFe.infNFe"), F.col("x.infNFe"))
    raw_id = inf.getField("_Id")
    key = F.when(F.coalesce(raw_id, F.lit("")) != "", clean_key(raw_id)).otherwise(
        F.when(F.length(digits(F.col("file_name"))) == 44, digits(F.col("file_name"))))
    rows = rows.select("*", inf.alias("inf"), key.alias("nota_id"))
    corrupt = F.col("x._corrupt_record").isNotNull() | F.col("x").isNull()
    error = (F.when(corrupt, F.lit("invalid XML"))
              .when(F.col("inf").isNull(), F.lit("infNFe not found"))
              .when(F.col("nota_id").isNull(), F.lit("invalid key")))
    rows = rows.withColumn("error", error)
    ide, emit = F.col("inf.ide"), F.col("inf.emit")
    prot = F.col("x.protNFe.infProt")
    fields = {
        "id": F.col("nota_id"), "nota_id": F.col("nota_id"), "hotel": F.col("hotel"),
        "source_file": F.col("file_name"),
        "dhEmi": ide.getField("dhEmi"), "nNF": ide.getField("nNF"), "serie": ide.getField("serie"),
        "mod": ide.getField("mod"), "tpAmb": ide.getField("tpAmb"),
        "cnpj_emit": emit.getField("CNPJ"), "nome_emit": emit.getField("xNome"),
        "vNF": F.col("inf.total.ICMSTot.vNF"),
        "nProt": prot.getField("nProt"), "cStat": prot.getField("cStat"), "dhRecbto": prot.getField("dhRecbto"),
        "xml_content": F.col("xml_content"),
    }
    ok = rows.filter(F.col("error").isNull()).select(
        *[c.alias(n) for n, c in fields.items() if n != "id"],
        F.to_variant_object(F.struct(*[c.alias(n) for n, c in fields.items()])).alias("data"), "arrival")
    rejects = rows.filter(F.col("error").isNotNull()).select("file_name", "error")
    return ok, rejects


def parse_cancel_xml(files: DataFrame, hotel: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Cancellation event ``envEvento/evento/infEvento``; rejects XML that
    does not parse or lacks ``evento`` / ``infEvento``."""
    rows = files.select("file_name", arrival(files), strip_bom("value").alias("xml_content"),
                        (hotel if hotel is not None else F.lit(None).cast("string")).alias("hotel"))
    rows = rows.select("*", once(F.from_xml("xml_content", CANCEL_XML_SCHEMA), "x"))
    inf = F.col("x.evento.infEvento")
    error = (F.when(F.col("x._corrupt_record").isNotNull() | F.col("x").isNull(), F.lit("invalid XML"))
              .when(F.col("x.evento").isNull(), F.lit("evento not found"))
              .when(inf.isNull(), F.lit("infEvento not found")))
    rows = rows.withColumn("error", error)
    event_id = F.coalesce(inf.getField("_Id"), F.lit(""))
    fields = {
        "id": event_id, "cancelamento_id": event_id, "chNFe": inf.getField("chNFe"), "hotel": F.col("hotel"),
        "source_file": F.col("file_name"), "dhEvento": inf.getField("dhEvento"),
        "tpEvento": inf.getField("tpEvento"), "nSeqEvento": inf.getField("nSeqEvento"),
        "cnpj": inf.getField("CNPJ"), "nProt": inf.getField("detEvento").getField("nProt"),
        "xJust": inf.getField("detEvento").getField("xJust"), "xml_content": F.col("xml_content"),
    }
    ok = rows.filter(F.col("error").isNull()).select(
        *[c.alias(n) for n, c in fields.items() if n != "id"],
        F.to_variant_object(F.struct(*[c.alias(n) for n, c in fields.items()])).alias("data"), "arrival")
    return ok, rows.filter(F.col("error").isNotNull()).select("file_name", "error")


# ---------------------------------------------------------------- S7


def parse_json_array(files: DataFrame, key_field: str = "IDLANCAMENTOICMSBASE", errors: bool = False) -> DataFrame:
    """Flat JSON array of records; ``id = str(record[key_field])``.

    The record is kept whole (plus the root ``id``); ``arrival`` lets a batch be
    de-duplicated with the last occurrence winning (K2). Records without the
    key keep a NULL key."""
    files = files.select("file_name", *_when(files), once(F.try_parse_json("value"), "v"))
    return _array_out(_array_records(_elements(files, "$"), key_field), errors)


def _array_records(rows: DataFrame, key_field: str) -> DataFrame:
    key = F.try_variant_get("e", f"$.{key_field}", "string")
    rows = rows.filter(F.col("error").isNotNull() | F.col("e").isNull() | _as_map(F.col("e")).isNotNull())
    return rows.select(key.alias("key"), F.when(F.col("e").isNotNull(), _with_fields(F.col("e"), id=key)).alias("data"), "file_name",
                       F.coalesce("pos", F.lit(0)).alias("pos"), _arrived(), "error")


def _array_out(rows: DataFrame, errors: bool) -> DataFrame:
    return rows if errors else rows.filter(F.col("error").isNull() & F.col("data").isNotNull()).drop("error")


# ---------------------------------------------------------------- S3, S4, S7 for files of any size


def _scanned(spark, path: str, depth: int, chosen, group_bytes: int) -> DataFrame:
    """What ``_elements`` gives, from a scan in splits: ``pos`` is the byte at which a
    record begins, and every file has a row without a record. Parsed once, into a checkpoint."""
    scratch_dir(spark)
    found, files = scan_arrays(spark, path, depth, chosen, group_bytes)
    parsed = found.select("file_path", "file_name", *_when(found), "section", F.col("off").alias("pos"),
                          once(F.try_parse_json("value"), "e")).checkpoint(eager=True)
    broken = parsed.where(F.col("e").isNull()).select("file_path").distinct().withColumn("_broken", F.lit("not JSON"))
    files = files.join(broken, "file_path", "left").withColumn("error", F.coalesce("error", "_broken")).checkpoint(eager=True)
    good = without(parsed, files.where(F.col("error").isNotNull()), "file_path").withColumn("error", F.lit(None).cast("string"))
    none = files.select("file_path", "file_name", *_when(files), F.lit(None).cast("long").alias("section"), F.lit(None).cast("long").alias("pos"),
                        F.lit(None).cast("variant").alias("e"), "error")
    return good.unionByName(none)


def scan_json_array(spark, path: str, key_field: str = "IDLANCAMENTOICMSBASE", errors: bool = False, chosen=None,
                    group_bytes: int = GROUP_BYTES) -> DataFrame:
    """S7 as ``parse_json_array``, for files of any size: read in splits
    (``sources.arrays``), those that ``chosen`` keeps (a filter over ``file_name``)."""
    return _array_out(_array_records(_scanned(spark, path, 1, chosen, group_bytes), key_field), errors)


def scan_nested_array_json(spark, path: str, location_codes: Mapping[str, str], key_field: str = "guestCheckLineItemID",
                           code_field: str = "locationRef", errors: bool = False, chosen=None,
                           group_bytes: int = GROUP_BYTES) -> DataFrame:
    """S4 as ``parse_nested_array_json``, for files of any size: read in splits."""
    rows = _scanned(spark, path, 2, chosen, group_bytes).where("section = 0 or section is null")
    return _out(_line_item_records(rows, location_codes, key_field, code_field, errors), errors)


def scan_sectioned_json(spark, path: str, store_codes: Mapping[str, str], key_field: str = "Invoice Data Info 8",
                        header_field: str = "Store Number", errors: bool = False, chosen=None,
                        group_bytes: int = GROUP_BYTES) -> DataFrame:
    """S3 as ``parse_sectioned_json``, for files of any size: read in splits."""
    rows = _scanned(spark, path, 2, chosen, group_bytes)
    first = one_per_key(rows.where("section = 0").select("file_path", "pos", "e"), "file_path", ["pos"], take=["e"])
    header = first.select("file_path", F.try_variant_get("e", f"$['{header_field}']", "string").alias("_store"))
    rows = left_lookup(rows.where("section = 2 or section is null"), header, "file_path", "file_path", ["_store"])
    rows = rows.withColumn("hotel", map_code(F.coalesce("_store", F.lit("")), store_codes))
    return _out(_pos_records(rows, key_field, errors), errors)


# ---------------------------------------------------------------- S10 / S14


def ids_from_text(df: DataFrame, col: str = "value", name: str = "id") -> DataFrame:
    """Strip non-digits, drop empties, distinct."""
    d = F.regexp_replace(F.col(col), r"[^0-9]", "")
    return df.select(d.alias(name)).filter(F.col(name) != "").distinct()


def read_id_list(spark, path: str) -> DataFrame:
    """One id per line (header and noise allowed)."""
    return ids_from_text(spark.read.text(path))


_DEAD = r"(?s)^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}) \| ([^|]*?) \| ID: ([^|]*?) \| Erro: (.*)$"


def parse_dead_letters(files: DataFrame) -> DataFrame:
    """``time | type | ID: n | Erro: msg`` records; a message may span
    lines (the next record starts with a timestamp at line start). This reads
    the legacy text log, one file per row; new failures are written by K6 as
    a typed, date-partitioned table instead."""
    recs = files.select(F.explode(F.split(F.col("value"),
                                          r"\r?\n(?=\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2} \| )")).alias("r"))
    recs = recs.filter(F.regexp_like(F.col("r"), F.lit(r"^\d{4}-\d{2}-\d{2} ")))
    g = lambda i: F.regexp_extract(F.col("r"), _DEAD, i)
    return recs.select(F.to_timestamp_ntz(g(1)).alias("logged_at"), F.trim(g(2)).alias("resource_type"),
                       F.trim(g(3)).alias("id"), F.regexp_replace(g(4), r"\s+$", "").alias("error"))
