"""Merkle dataset manifest (operator 12) with incremental witnesses.

A row is a leaf: the SHA-256 of its fields, each with its length before it. The
leaves of a group (a source) stand in order of their id; while several nodes
remain, every ``ARITY`` consecutive ones become the SHA-256 of their digests as
hex text, a last run of fewer as well. The roots of the groups, in order of the
groups, are the leaves of the tree above them.

A witness of a leaf holds, level by level, the siblings before and after the
node above it, so that root and proof follow from leaf and witness alone.

Method. Nodes are appended in order, in aligned blocks of ``ARITY ** levels``;
one task streams through a block. It keeps the open subtrees, as a counter in
base ``ARITY`` keeps its digits; a leaf's witness starts with its subtree, and
each time a run of siblings is complete the witnesses below it get one more
level (``append``). The roots of the blocks are the appends of the next round, by
the same function, and what their witnesses gain extends those of their blocks.
A round divides the nodes by the size of a block (6,561), so three rounds do for
10^11 rows; the groups' roots go through the same rounds.

No task holds more than a block, whatever the size of a group: places come from
a range partitioning by (group, id) that is written once, and from the counts of
the partitions before. Texts are hashed where they are read and never shuffled.

Defined cases: NULL fields are ``-`` in a leaf; a NULL group is a group of its
own before all others; NULL ids come first; rows that repeat an id follow each
other by their leaves; an empty table gives an empty result; other columns
never matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewater.llm.common import col, staged

ARITY, LEVELS = 3, 8
HOLE = "|"  # where a node's own digest goes among its siblings'


def leaf_of(fields: list[Column]) -> Column:
    """SHA-256 over the fields: ``-`` for NULL, else byte count, colon, value."""
    parts = [F.coalesce(F.concat(F.octet_length(f.cast("string")).cast("string"), F.lit(":"), f.cast("string")), F.lit("-")) for f in fields]
    return F.sha2(F.encode(F.concat(*parts), "UTF-8"), 256)


def height(n: int) -> int:
    """Levels above n leaves."""
    levels = 0
    while ARITY ** levels < n:
        levels += 1
    return levels


def append(digests: Iterator[str], levels: int) -> tuple[str, list[list[str]]]:
    """(root, witnesses) of a stream of nodes, ``levels`` levels up. A witness has
    one text a level: the siblings with ``HOLE`` in the node's own place."""
    from hashlib import sha256
    witnesses: list[list[str]] = []
    # open[k]: complete subtrees of height k that wait for siblings, as (digest, first leaf, leaf after the last)
    open_: list[list[tuple[str, int, int]]] = [[] for _ in range(levels + 1)]

    def close(level: int) -> None:
        run, open_[level] = open_[level], []
        for i, (_, first, after) in enumerate(run):
            around = "".join([x for x, _, _ in run[:i]]) + HOLE + "".join([x for x, _, _ in run[i + 1:]])
            for w in witnesses[first:after]:
                w.append(around)
        put(level + 1, (sha256("".join([x for x, _, _ in run]).encode()).hexdigest(), run[0][1], run[-1][2]))

    def put(level: int, node: tuple[str, int, int]) -> None:
        open_[level].append(node)
        if level < levels and len(open_[level]) == ARITY:
            close(level)

    for i, digest in enumerate(digests):
        witnesses.append([])
        put(0, (digest, i, i + 1))
    for level in range(levels):  # the end of the stream completes what is open
        if open_[level]:
            close(level)
    return open_[levels][0][0], witnesses


def witnesses(nodes: DataFrame, name: str, levels: int) -> DataFrame:
    """(g, i, w, root) for nodes (g, i, n, digest): node i of the n of group g."""
    size = ARITY ** levels

    def block(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("i")
        root, w = append(iter(rows["digest"].tolist()), min(levels, height(int(rows["n"].iloc[0]))))
        return pd.DataFrame({"g": rows["g"], "i": rows["i"], "n": rows["n"], "w": w, "top": [root] + [None] * (len(rows) - 1)})

    found = staged(nodes.select("g", "i", "n", "digest", F.expr(f"i div {size}").alias("b")).groupBy("g", "b").applyInPandas(
        block, "g string, i long, n long, w array<string>, top string"), name)
    tops = found.where("top is not null").select("g", F.expr(f"i div {size}").alias("i"),
                                                 F.expr(f"(n + {size - 1}) div {size}").alias("n"), F.col("top").alias("digest"))
    if not tops.where("n > 1").limit(1).count():
        return found.drop("top").join(tops.select("g", F.col("digest").alias("root")), "g").select("g", "i", "w", "root")
    # groups of one block are done (their top has no level above it); the others' tops are appended in turn
    up = staged(witnesses(tops, name + "-up", levels), name + "-joined").select("g", F.col("i").alias("b"), F.col("w").alias("above"), "root")
    return found.withColumn("b", F.expr(f"i div {size}")).join(up, ["g", "b"]).select("g", "i", F.concat("w", "above").alias("w"), "root")


def places(rows: DataFrame, name: str, order: list[str]) -> DataFrame:
    """``rows`` with ``i``, the place in their group ``g`` by ``order``, and ``n``, the size of the group."""
    sorted_ = rows.repartitionByRange("g", *order).sortWithinPartitions("g", *order).select(
        "*", F.spark_partition_id().alias("pid"), F.monotonically_increasing_id().alias("pos"))
    sorted_ = staged(sorted_, name)  # written: the ranges are sampled once
    runs = sorted_.groupBy("g", "pid").agg(F.min("pos").alias("first"), F.count("*").alias("rows"))
    whole = W.partitionBy("g")  # at most one row for each partition
    runs = runs.select("g", "pid", "first", F.sum("rows").over(whole).alias("n"),
                       F.coalesce(F.sum("rows").over(whole.orderBy("pid").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return sorted_.join(staged(runs, name + "-runs"), ["g", "pid"]).withColumn("i", F.col("before") + F.col("pos") - F.col("first")) \
        .drop("pid", "pos", "first", "before")


def folded(leaf: Column, witness: Column) -> Column:
    """The root that a leaf and its witness give."""
    return F.aggregate(witness, leaf, lambda node, around: F.sha2(F.replace(around, F.lit(HOLE), node), 256))


def proof(witness: Column) -> Column:
    """All siblings' digests, level by level and left to right."""
    return F.replace(F.array_join(witness, ""), F.lit(HOLE), F.lit(""))


def manifest(docs: DataFrame, group_col: str = "source", id_col: str = "doc_id",
             fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), replaced: dict[str, Column] | None = None,
             levels: int = LEVELS) -> DataFrame:
    """One row per row of ``docs``: its id ``doc_id``, ``leaf``, ``other`` (the leaf
    with the fields of ``replaced`` in place of their own; NULL without them),
    ``subroot`` of its group, ``root`` of all, and ``witness`` from the leaf to the root."""
    leaf = leaf_of([col(docs, f) for f in fields])
    other = leaf_of([replaced.get(f, col(docs, f)) for f in fields]) if replaced else F.lit(None).cast("string")
    group = col(docs, group_col).cast("string")
    rows = staged(docs.select(F.when(group.isNull(), "").otherwise(F.concat(F.lit("="), group)).alias("g"), col(docs, id_col).alias("id"),
                              leaf.alias("digest"), other.alias("other"), F.monotonically_increasing_id().alias("uid")), "leaves")
    leaves = staged(places(rows, "sorted", ["id", "digest", "uid"]).drop("uid"), "places")
    inner = staged(witnesses(leaves, "blocks", levels), "witnesses")
    groups = inner.where("i = 0").select(F.lit("").alias("g"), F.col("g").alias("id"), F.col("root").alias("digest"))
    groups = staged(places(groups, "groups", ["id"]), "group-places")
    outer = staged(witnesses(groups, "group-blocks", levels).join(groups.select("i", F.col("id").alias("group")), "i").select(
        F.col("group").alias("g"), F.col("w").alias("above"), F.col("root").alias("top")), "group-witnesses")
    return (leaves.select("g", "i", "id", "digest", "other").join(inner, ["g", "i"]).join(outer, "g")
            .select(F.col("id").alias("doc_id"), F.col("digest").alias("leaf"), "other", F.col("root").alias("subroot"),
                    F.col("top").alias("root"), F.concat("w", "above").alias("witness")))


def audit(docs: DataFrame, tampered: Column, **kinds) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256, and whether the row
    with the text ``tampered`` in place of its own still folds to the root."""
    found = manifest(docs, replaced={"text": tampered}, **kinds)
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2(proof(F.col("witness")), 256).alias("proof_sha256"),
                        folded(F.col("other"), F.col("witness")).alias("folded_root")) \
        .withColumn("verified", F.col("folded_root") == F.col("root"))


def oracle() -> str:
    """DuckDB SQL of ``op12``'s rows: the tree level by level, witnesses from it."""
    leaf = "sha256(" + " || ".join(f"coalesce(strlen({f}::varchar) || ':' || {f}::varchar, '-')"
                                   for f in ("doc_id", "source", "lang", "n_chars", "text")) + ")"
    return rf"""
WITH RECURSIVE poly AS (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b::bigint, range(8)),
       lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
crc AS (SELECT DISTINCT doc_id, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda x: ascii(x)::bigint)),
       lambda c, x: xor(c >> 8, t[1 + (xor(c, x) & 255)])), 4294967295) % 2 = 0 AS hit FROM documents, poly),
d AS (SELECT row_number() OVER () AS r, doc_id, source, {leaf} AS leaf,
      {leaf.replace("text::", "replace(text, chr(10), '')::")} AS cut FROM documents),
l AS (SELECT d.*, CASE WHEN hit THEN cut ELSE leaf END AS other,
      row_number() OVER (PARTITION BY source ORDER BY d.doc_id NULLS FIRST, leaf, r) - 1 AS i, count(*) OVER (PARTITION BY source) AS n
      FROM d LEFT JOIN crc ON d.doc_id IS NOT DISTINCT FROM crc.doc_id),
t AS (SELECT 0 AS k, coalesce('=' || source, '') AS g, i, n, leaf AS x FROM l
      UNION ALL
      SELECT k + 1, g, i // {ARITY}, (max(n) + {ARITY - 1}) // {ARITY}, sha256(string_agg(x, '' ORDER BY i)) FROM t WHERE n > 1 GROUP BY k, g, i // {ARITY}),
s AS (SELECT g, x AS subroot, row_number() OVER (ORDER BY encode(g)) - 1 AS i, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (SELECT 0 AS k, i, n, subroot AS x FROM s
      UNION ALL SELECT k + 1, i // {ARITY}, (max(n) + {ARITY - 1}) // {ARITY}, sha256(string_agg(x, '' ORDER BY i)) FROM u WHERE n > 1 GROUP BY k, i // {ARITY}),
a AS (SELECT a.k, a.g, a.i, string_agg(CASE WHEN a.i = b.i THEN '{HOLE}' ELSE b.x END, '' ORDER BY b.i) AS w
      FROM t a JOIN t b ON a.k = b.k AND a.g = b.g AND a.i // {ARITY} = b.i // {ARITY} WHERE a.n > 1 GROUP BY a.k, a.g, a.i),
b AS (SELECT a.k, a.i, string_agg(CASE WHEN a.i = b.i THEN '{HOLE}' ELSE b.x END, '' ORDER BY b.i) AS w
      FROM u a JOIN u b ON a.k = b.k AND a.i // {ARITY} = b.i // {ARITY} WHERE a.n > 1 GROUP BY a.k, a.i),
inner_w AS (SELECT l.r, list(a.w ORDER BY a.k) AS w FROM l JOIN a ON a.g = coalesce('=' || source, '') AND a.i = l.i // ({ARITY} ** a.k)::bigint GROUP BY l.r),
outer_w AS (SELECT s.g, list(b.w ORDER BY b.k) AS w FROM s JOIN b ON b.i = s.i // ({ARITY} ** b.k)::bigint GROUP BY s.g),
f AS (SELECT doc_id, leaf, other, subroot, (SELECT x FROM u WHERE n = 1) AS root, list_concat(coalesce(i.w, []), coalesce(o.w, [])) AS w
      FROM l JOIN s ON s.g = coalesce('=' || l.source, '') LEFT JOIN inner_w i ON i.r = l.r LEFT JOIN outer_w o ON o.g = s.g),
v AS (SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(w, ''), '{HOLE}', '')) AS proof_sha256,
      list_reduce(list_prepend(other, w), lambda node, around: sha256(replace(around, '{HOLE}', node))) AS folded_root FROM f)
SELECT *, folded_root = root AS verified FROM v"""
