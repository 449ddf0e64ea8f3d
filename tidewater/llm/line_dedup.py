"""Line dedup (operator 3): a log-template tree, native DataFrame functions only.

A line is parsed at fixed depth: its token count is the first level of the
tree, its ``LEAD`` leading tokens the next ones; a token with a digit is a
variable field (``<*>``) everywhere. A leaf then holds the templates of its
lines. The line itself is the narrowest template. The tokens behind the lead are
cut into ``PARTS`` parts (fewer where there are fewer tokens), and wider
templates leave one part variable, or two. What a template must fix is counted
in tokens, the lead included: ``ONE`` with one variable part, ``TWO`` with two.

A template recurs if its lines stand in ``min_docs`` documents or more; one with
two variable parts, or that fixes fewer than ``SURE`` tokens, in twice as many. Of a
recurring template's lines only the first stays: the one in the document with
the smallest doc_id (then text hash, then line number); all others are dropped
from their texts. Copies with another doc_id are other documents.

Template keys are 64-bit hashes. One pass over the texts gives key lists
without text, counted by partial aggregation, so that a line that stands in a
third of all documents shuffles few rows; a second pass drops the lines.

Defined cases: NULL and empty texts stay as they are; lines without a token
stay; rows equal in doc_id and text count as one document and get the same
result; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import SMALL_SIDE, SPACE, cut, id_text, positional, row_key, small, staged

LEAD, PARTS, MIN_DOCS = 3, 5, 3
ONE, TWO, SURE = 4, 9, 11  # fixed tokens
VARIABLE = [v for size in (1, 2) for v in itertools.combinations(range(PARTS), size)]


def needed(key: Column, min_docs: int) -> Column:
    """The documents that a key asks for: its lowest bit is set if it asks for twice as many."""
    return F.when(key.bitwiseAND(F.lit(1)) == 1, 2 * min_docs).otherwise(min_docs)


def line_keys(docs: DataFrame) -> DataFrame:
    """(a, b, doc_id, line, keys) for every line: the keys of its templates, the
    line's own first. a, b stand for the row (see ``row_key``)."""
    row = docs.withColumn("row", row_key(F.col("doc_id"), F.col("text")))
    lines = row.select(F.col("row.a").alias("a"), F.col("row.b").alias("b"), "doc_id",
                       F.posexplode(F.split("text", "\n")).alias("line", "x"))
    masked = F.when(F.col("x").rlike("[0-9]"), F.regexp_replace("x", r"[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*", "<*>")).otherwise(F.col("x"))
    bare = lines.select("a", "b", "doc_id", "line", F.btrim(masked, F.lit(" \t\n\x0b\x0c\r")).alias("x"))
    t = bare.select("a", "b", "doc_id", "line", F.when(F.col("x") != "", F.split("x", SPACE)).alias("t"))
    # hashes of the lead and of the parts, each computed once
    # (projections of this size stay within what the JVM compiles; nothing here but
    # the keys can be NULL)
    one, size = ["a", "b", "doc_id", "line"], F.coalesce(F.size("t"), F.lit(0))
    sized = t.select(*one, "t", size.alias("n"), F.greatest(size - LEAD, F.lit(0)).alias("m"))
    n, m = F.col("n"), F.col("m")
    cut_at = sized.select(*one, "t", "n", "m", F.shiftleft(F.xxhash64(n, F.lit(-1), "t"), 1).alias("own"),
                          F.xxhash64(n, F.slice("t", 1, LEAD)).alias("lead"), *[F.expr(f"m * {j} div {PARTS}").cast("int").alias(f"c{j}") for j in range(1, PARTS)])
    cuts = [F.lit(0), *[F.col(f"c{j}") for j in range(1, PARTS)], m]
    parts = cut_at.select(*one, "n", "own", "lead",
                          *[(n - (cuts[j + 1] - cuts[j])).alias(f"f{j}") for j in range(PARTS)],
                          *[F.xxhash64(F.lit(j), F.slice("t", cuts[j] + LEAD + 1, cuts[j + 1] - cuts[j])).alias(f"p{j}") for j in range(PARTS)])

    def wide(v: tuple[int, ...]) -> Column:
        h = F.col("lead")  # the parts' hashes are salted by their place
        for j in range(PARTS):
            h = h if j in v else h.bitwiseXOR(F.col(f"p{j}"))
        h = F.shiftleft(F.xxhash64(h, F.lit(VARIABLE.index(v))), 1)
        if len(v) > 1:
            return F.when(F.col(f"f{v[0]}") + F.col(f"f{v[1]}") - n >= TWO, h.bitwiseOR(F.lit(1).cast("long")))
        # an empty part leaves the line's own template, asked for more documents: it drops nothing by itself
        fixed = F.col(f"f{v[0]}")
        return F.when(fixed >= SURE, h).when(fixed >= ONE, h.bitwiseOR(F.lit(1).cast("long")))

    # NULL where a line has no such template
    keys = F.when(F.col("n") > LEAD, F.array("own", *map(wide, VARIABLE))).when(F.col("n") > 0, F.array("own")).otherwise(
        F.array().cast("array<bigint>"))
    return parts.select("a", "b", "doc_id", "line", keys.alias("keys"))


def dropped_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(a, b, drop): the line numbers to drop from each document that loses any.

    The texts are parsed once, to a table of key lists. Only keys of enough
    lines, found by partial counts, are looked at by document."""
    lines = staged(line_keys(docs), "lines")
    often = cut(lines.select(F.explode("keys").alias("key")).where("key is not null").groupBy("key").agg(F.count("*").alias("n")).where(
        F.col("n") >= needed(F.col("key"), min_docs)).select("key"))
    found = staged(lines.select("a", "b", "doc_id", "line", F.explode("keys").alias("key")).join(small(often), "key"), "recurring")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "a", "b", "line"))
    per_doc = found.groupBy("key", "a", "b").agg(first.alias("first"))
    recurring = cut(per_doc.groupBy("key").agg(F.count("*").alias("docs"), F.min("first").alias("first")).where(
        F.col("docs") >= needed(F.col("key"), min_docs)).select("key", F.col("first.a").alias("fa"), F.col("first.b").alias("fb"), F.col("first.line").alias("fl")))
    lost = found.join(small(recurring, SMALL_SIDE // 2), "key").where("a <> fa or b <> fb or line <> fl")
    return cut(lost.groupBy("a", "b").agg(F.collect_set("line").alias("drop")))


def without_lines(df: DataFrame, key: Column, text: Column, drops: DataFrame) -> DataFrame:
    """``df`` with ``kept_text`` and ``drop`` (NULL where nothing goes)."""
    joined = df.withColumns({"a": key["a"], "b": key["b"]}).join(small(drops, SMALL_SIDE // 8), ["a", "b"], "left")
    kept = F.filter(F.split(text, "\n"), lambda x, i: ~F.array_contains("drop", i))
    return joined.withColumn("kept_text", F.when(F.col("drop").isNull(), text).otherwise(F.array_join(kept, "\n")))


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """The rows of ``docs``, columns as they are, without the recurring lines;
    a column ``n_chars`` is the length of the text that stays."""
    names = docs.columns
    i, t = names.index(id_col), names.index(text_col)
    df = positional(docs)
    drops = dropped_lines(id_text(docs, id_col, text_col), min_docs)
    out = without_lines(df, row_key(F.col(f"c{i}"), F.col(f"c{t}")), F.col(f"c{t}"), drops)
    cols = {f"c{t}": F.col("kept_text")}
    if "n_chars" in names:
        c = names.index("n_chars")
        kind = df.schema[c].dataType
        cols[f"c{c}"] = F.when(F.col("drop").isNull(), F.col(f"c{c}")).otherwise(F.length("kept_text").cast(kind))
    return out.select(*[cols.get(c, F.col(c)).alias(c) for c in df.columns]).toDF(*names)


def line_report(docs: DataFrame, *, min_docs: int = MIN_DOCS) -> DataFrame:
    """One row per document: doc_id, n_lines (with a token), n_dropped, text (what stays)."""
    df = id_text(docs)
    out = without_lines(df, row_key(F.col("doc_id"), F.col("text")), F.col("text"), dropped_lines(df, min_docs))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return out.select("doc_id", F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
                      F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_dropped"),
                      F.col("kept_text").alias("text"))


def oracle(min_docs: int = MIN_DOCS) -> str:
    """DuckDB SQL for ``line_report`` over ``documents`` (keys are lists, not hashes)."""
    m = f"(len(t) - {LEAD})"
    size = [f"({m} * {j + 1} // {PARTS} - {m} * {j} // {PARTS})" for j in range(PARTS)]
    part = [f"t[{LEAD} + 1 + ({m} * {j} // {PARTS}) : {LEAD} + ({m} * {j + 1} // {PARTS})]" for j in range(PARTS)]

    def template(v):
        fixed = f"(len(t) - {' - '.join(size[j] for j in v)})"
        there = " AND ".join([f"{fixed} >= {ONE if len(v) == 1 else TWO}", *[f"{size[j]} > 0" for j in v]])
        need = 2 * min_docs if len(v) > 1 else f"CASE WHEN {fixed} < {SURE} THEN {2 * min_docs} ELSE {min_docs} END"
        rest = ", ".join(p for j, p in enumerate(part) if j not in v)
        return f"CASE WHEN {there} THEN {{'need': {need}, 'key': [[len(t)::varchar, '{v}'], t[1:{LEAD}], {rest}]}} END"

    own = f"{{'need': {min_docs}, 'key': [['-1'], t]}}"
    wide = ", ".join(template(v) for v in VARIABLE)
    return f"""
WITH d AS (SELECT DISTINCT doc_id, text FROM documents),
l AS (SELECT doc_id, text AS body, unnest(string_split(text, chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d WHERE text IS NOT NULL),
k AS (SELECT doc_id, body, i, list_filter(regexp_split_to_array(
        regexp_replace(line, '[^\\x20\\x09-\\x0D]*[0-9][^\\x20\\x09-\\x0D]*', '<*>', 'g'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS t FROM l),
x AS (SELECT doc_id, body, i, e.key AS key, e.need AS need FROM (
        SELECT doc_id, body, i, unnest(CASE WHEN len(t) > {LEAD} THEN [{own}, {wide}] ELSE [{own}] END) AS e
        FROM k WHERE len(t) > 0) WHERE e IS NOT NULL),
r AS (SELECT key, min((doc_id IS NULL, doc_id, md5(body), i)) AS first FROM x GROUP BY key
      HAVING count(DISTINCT (coalesce(doc_id::varchar, ''), doc_id IS NULL, body)) >= min(need)),
drops AS (SELECT DISTINCT x.doc_id, x.body, x.i FROM x JOIN r ON x.key = r.key
          WHERE (x.doc_id IS NULL, x.doc_id, md5(x.body), x.i) IS DISTINCT FROM r.first),
kept AS (SELECT l.doc_id, l.body, string_agg(l.line, chr(10) ORDER BY l.i) FILTER (g.i IS NULL) AS text,
                count(g.i) AS n_dropped,
                count(*) FILTER (regexp_matches(l.line, '[^\\x20\\x09-\\x0D]')) AS n_lines
         FROM l LEFT JOIN drops g ON l.doc_id IS NOT DISTINCT FROM g.doc_id AND l.body = g.body AND l.i = g.i GROUP BY l.doc_id, l.body)
SELECT o.doc_id, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_dropped, 0) AS n_dropped,
       CASE WHEN o.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text
FROM documents o LEFT JOIN kept k ON o.doc_id IS NOT DISTINCT FROM k.doc_id AND o.text = k.body"""
