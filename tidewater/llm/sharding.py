"""Sharding (operator 7): a hierarchical weighted hash tree, native functions only.

Shards hang in racks, racks in regions. A row descends the tree: at every node
each child makes a draw, -ln(u) / weight with u hashed from the row's key and
the child's name, and the smallest draw wins (the weighted rendezvous rule). A
child's weight is the sum of its shards', so a child wins in proportion to its
weight, and a draw depends on that child alone: when a weight changes, only rows
that this child wins or loses move, and within subtrees whose weights stay the
same nothing moves.

Law ``key``: the doc_id and the tree decide alone. A new shard that joins as a
region of its own takes rows only into itself; one that joins an existing rack
also lets rows move between the shards of the subtrees above it that gained
weight, nowhere else.

Slots number the rows of a shard from 0 without gaps. The rows, without their
texts, are checkpointed with a row number, which deals them evenly into buckets
of about ``bucket_rows``, so no hot doc_id or text gathers anywhere; a window
numbers the rows of one (shard, bucket), and the counts of the shard's buckets
before it are added. Slots follow (bucket, doc_id).

Defined cases: a NULL doc_id is a key like any other; repeated doc_ids share a shard and get different slots; a NULL text has
size 8 and the crc of an empty text; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewater.llm.common import cut, id_text

#: name -> subtree; a leaf is (shard number, weight)
Tree = dict


def regular_tree(regions: int, racks: int, shards: int, weight: float = 1.0) -> Tree:
    number = iter(range(regions * racks * shards))
    return {f"region{r}": {f"rack{k}": {f"shard{s}": (next(number), weight) for s in range(shards)}
                           for k in range(racks)} for r in range(regions)}


def with_new_region(tree: Tree, shard: int, weight: float = 1.0) -> Tree:
    """``tree`` and one more shard as a region of its own."""
    return {**tree, f"region{len(tree)}": {"rack0": {"shard0": (shard, weight)}}}


def weight_of(node) -> float:
    return sum(weight_of(x) for x in node.values()) if isinstance(node, dict) else node[1]


def draw(key: Column, path: str, weight: float) -> Column:
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(path)), 11) + 0.5) / float(1 << 53)
    return -F.log(u) / weight


def descend(key: Column, node, path: str = "") -> Column:
    """The shard that ``key`` reaches below ``node``."""
    if not isinstance(node, dict):
        return F.lit(node[0])
    children = [(f"{path}/{name}", child) for name, child in node.items() if weight_of(child) > 0]
    if len(children) == 1:
        return descend(key, children[0][1], children[0][0])
    drawn = F.array_min(F.array(*[F.struct(draw(key, p, weight_of(c)).alias("d"), F.lit(i).alias("i"))
                                  for i, (p, c) in enumerate(children)]))["i"]
    below = [descend(key, c, p) for p, c in children]
    if not any(isinstance(c, dict) for _, c in children):
        return F.get(F.array(*below), drawn)
    out = F.when(F.lit(False), F.lit(None).cast("int"))
    for i, b in enumerate(below):
        out = out.when(drawn == i, b)
    return out


def slots(rows: DataFrame, bucket_rows: int = 20_000) -> DataFrame:
    """``rows`` (doc_id, uid, shard, ...) with ``slot``."""
    n = max(1, math.ceil(rows.count() / bucket_rows))
    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64("uid"), F.lit(n)))
    before = dealt.groupBy("shard", "bucket").agg(F.count("*").alias("n")).select(
        "shard", "bucket", F.coalesce(F.sum("n").over(W.partitionBy("shard").orderBy("bucket").rowsBetween(
            W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    own = F.row_number().over(W.partitionBy("shard", "bucket").orderBy("doc_id", "uid"))
    return (dealt.withColumn("own", own).join(before, ["shard", "bucket"])
            .withColumn("slot", F.col("before") + F.col("own") - 1).drop("own", "before", "bucket"))


def shard(docs: DataFrame, tree: Tree, grown: Tree | None = None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("\0null"))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = cut(id_text(docs, id_col, text_col).select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        descend(key, tree).cast("int").alias("shard"),
        (descend(key, grown) if grown else F.lit(None)).cast("int").alias("grown_shard"),
        F.monotonically_increasing_id().alias("uid")))
    return slots(rows).select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                              F.col("slot").cast("long").alias("slot"), "grown_shard")
