"""F1 / F2: JSON path projection with typed casts (schema-on-read).

A view is data: a list of ``(name, path, type)``, with further types after it
that the text must also fit (a column may stay text and yet have to be a
moment). ``project`` compiles the whole list into one parse per row (all leaves
read as text) and one cast per column. The parse of JSON text stands behind a
generator: Spark would otherwise copy it into every column and filter.

One policy for all casts: text that is no value of its type gives NULL, never
an error, and is reported. ``project(malformed="bad")`` adds the list of such
columns with their text, NULL where there are none; ``cast_metrics`` counts
them while a table is written, ``cast_counts`` in a query, and
``cast_rejects`` lists them.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.scalar import instant, iso_date

# Target types of the reference's casts (SURVEY §1 "Types used").
TYPES = {
    "text": T.StringType(),
    "numeric": T.DecimalType(38, 18),
    "numeric(12,2)": T.DecimalType(12, 2),
    "numeric(12,4)": T.DecimalType(12, 4),
    "integer": T.IntegerType(),
    "bigint": T.LongType(),
    "smallint": T.ShortType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
    "timestamptz": T.TimestampType(),
    "double": T.DoubleType(),
}


def as_type(t) -> T.DataType:
    return TYPES[t] if isinstance(t, str) else t


def split_path(path: str) -> list[str]:
    """``'data.attributes.name'`` or ``'$.data.attributes.name'`` -> parts.

    A part with dots or spaces goes in brackets: ``"['Sub Total 1']"``.
    """
    p = path[2:] if path.startswith("$.") else path.lstrip("$")
    parts, buf, i = [], "", 0
    while i < len(p):
        c = p[i]
        if c == "[":
            j = p.index("]", i)
            parts.append(p[i + 1:j].strip("'\""))
            i = j + 1
            if i < len(p) and p[i] == ".":
                i += 1
            continue
        if c == ".":
            if buf:
                parts.append(buf)
            buf = ""
        else:
            buf += c
        i += 1
    if buf:
        parts.append(buf)
    return parts


def typed(col: Column, t) -> Column:
    """cast text to a type; malformed text gives NULL. ``iso_date`` takes
    the literal date of an ISO text (X1), ``instant`` its moment."""
    if t in ("iso_date", "instant"):
        return iso_date(col) if t == "iso_date" else instant(col)
    dt = as_type(t)
    if isinstance(dt, T.StringType):
        return col
    return col.try_cast(dt)


def path(doc: Column | str, p: str, t="text") -> Column:
    """one JSON path of a JSON-text column, typed.  ``->>`` semantics: a
    JSON null or a missing key gives SQL NULL; an object gives its JSON text."""
    doc = F.col(doc) if isinstance(doc, str) else doc
    json_path = "$" + "".join(f"['{k}']" if (" " in k or "." in k) else f".{k}" for k in split_path(p))
    return typed(F.get_json_object(doc, json_path), t)


def _schema_for(paths: Iterable[Sequence[str]]) -> T.StructType:
    tree: dict = {}
    for parts in paths:
        node = tree
        for k in parts[:-1]:
            nxt = node.setdefault(k, {})
            if not isinstance(nxt, dict):  # a leaf and a branch share a name
                nxt = node[k] = {}
            node = nxt
        node.setdefault(parts[-1], None)

    def build(node: dict) -> T.StructType:
        return T.StructType([
            T.StructField(k, T.StringType() if v is None else build(v), True)
            for k, v in node.items()])
    return build(tree)


def variant_path(parts: Sequence[str]) -> str:
    """Parts -> a VARIANT path (``$.a['b c'].d``)."""
    return "$" + "".join(f"['{k}']" if not k.isidentifier() else f".{k}" for k in parts)


def is_variant(df: DataFrame, col: str) -> bool:
    return dict(df.dtypes)[col] == "variant"


def once(value: Column, name: str) -> Column:
    """``value`` as a column that is computed once: a generator's output is never
    inlined back into later filters and projections (predicate pushdown would
    otherwise substitute a parse into every reference to it)."""
    return F.explode(F.array(value)).alias(name)


def project(df: DataFrame, doc: str, spec: Sequence[tuple], keep: Sequence[str] = (), malformed: str | None = None) -> DataFrame:
    """Compile a ``(name, path, type)`` spec into one select.

    ``doc`` names the document column: a VARIANT (bronze default -- parsed
    once at ingest, each path is a cheap navigation of the binary value) or
    JSON text (parsed once per row with one ``from_json`` for the whole spec).
    Leaves are read as text, then cast to the spec type, so both forms give
    the same values. Columns in ``keep`` pass through first. ``malformed``
    names a further column: the columns whose text is no value of a type of
    theirs, as ``array<struct<column, text>>``, NULL if there are none."""
    keep = [k for k in keep if k in df.columns]  # audit columns such as extracted_at are optional
    paths = [split_path(p) for _, p, *_ in spec]
    if is_variant(df, doc):
        raw = [F.try_variant_get(F.col(doc), variant_path(parts), "string") for parts in paths]
        if malformed:
            df = df.select(*keep, once(F.struct(*[c.alias(f"r{i}") for i, c in enumerate(raw)]), "_parsed"))
            raw = [F.col(f"_parsed.r{i}") for i in range(len(raw))]
    else:
        df = df.select(*keep, once(F.from_json(F.col(doc), _schema_for(paths)), "_parsed"))
        raw = []
        for parts in paths:
            c = F.col("_parsed")
            for k in parts:
                c = c.getField(k)
            raw.append(c)
    out = [typed(c, t).alias(name) for c, (name, _, t, *_) in zip(raw, spec)]
    if malformed:
        out.append(_cast_failures([(name, c, [t, *more]) for c, (name, _, t, *more) in zip(raw, spec)]).alias(malformed))
    return df.select(*[F.col(k) for k in keep], *out)


def casting(spec: Sequence[tuple]) -> dict[str, list]:
    """The columns of a spec whose text has to fit a type: name -> types."""
    types = {name: [t for t in (t0, *more) if not isinstance(TYPES.get(t, t), T.StringType)] for name, _, t0, *more in spec}
    return {name: ts for name, ts in types.items() if ts}


def _cast_failures(columns: Sequence[tuple]) -> Column:
    found = []
    for name, raw, types in columns:
        bad = [typed(raw, t).isNull() for t in types if not isinstance(TYPES.get(t, t), T.StringType)]
        if bad:
            any_bad = bad[0]
            for b in bad[1:]:
                any_bad = any_bad | b
            found.append(F.when(raw.isNotNull() & any_bad, F.struct(F.lit(name).alias("column"), raw.alias("text"))))
    if not found:
        return F.lit(None).cast("array<struct<column:string,text:string>>")
    listed = F.array_compact(F.array(*found))
    return F.when(F.size(listed) > 0, listed)


def cast_metrics(spec: Sequence[tuple], malformed: str = "malformed") -> dict[str, Column]:
    """Per casting column of the spec, the count of its malformed values, as
    aggregates: for ``observed`` (K3), so that a refresh reports them in the same pass."""
    def count(name):
        return F.count_if(F.coalesce(F.exists(F.col(malformed), lambda x: x["column"] == name), F.lit(False)))
    return {name: count(name) for name in casting(spec)}


def cast_counts(rows: DataFrame, spec: Sequence[tuple], malformed: str = "malformed") -> DataFrame:
    """(column, rows, malformed), one row per casting column of the spec, zeros included; one aggregate."""
    metrics = cast_metrics(spec, malformed)
    one = rows.agg(F.count(F.lit(1)).alias("rows"), *[c.alias(f"n_{name}") for name, c in metrics.items()])
    return one.select("rows", F.explode(F.array(*[F.struct(F.lit(name).alias("column"), F.col(f"n_{name}").alias("malformed"))
                                                  for name in metrics])).alias("x")).select("x.column", "rows", "x.malformed")


def cast_rejects(rows: DataFrame, key: str, spec: Sequence[tuple], malformed: str = "malformed") -> DataFrame:
    """(file_name, error) of every malformed value, for ``write_rejects`` (K6); ``file_name`` is the record's key."""
    kinds = F.create_map(*[F.lit(x) for name, ts in casting(spec).items() for x in (name, " and ".join(map(str, ts)))])
    bad = rows.where(F.col(malformed).isNotNull()).select(F.col(key).cast("string").alias("file_name"), F.explode(malformed).alias("x"))
    return bad.select("file_name", F.concat(F.col("x.column"), F.lit(": '"), F.col("x.text"), F.lit("' is no "), kinds[F.col("x.column")])
                      .alias("error"))


def doc_path(df: DataFrame, doc: str, p: str, t="text") -> Column:
    """One path of a document column of either form (VARIANT or JSON text)."""
    if is_variant(df, doc):
        return typed(F.try_variant_get(F.col(doc), variant_path(split_path(p)), "string"), t)
    return path(F.col(doc), p, t)


def doc_as(df: DataFrame, doc: str, p: str, ddl: str) -> Column:
    """A sub-document of either form as a typed value (``ddl``), e.g. the
    ``included`` array as array<struct<...>>."""
    if is_variant(df, doc):
        return F.try_variant_get(F.col(doc), p, ddl)
    return F.from_json(F.get_json_object(F.col(doc), p), ddl)
