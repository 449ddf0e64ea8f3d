"""Filter interaction audit (operator 13): which filter removes what, in every order.

Each filter of a chain gives a row a failure flag. In the removal game, a set of
filters (a coalition) is worth the number of rows that fail at least one of its
members. The Hart-Mas-Colell potential of a coalition S,

    P({}) = 0,  P(S) = (worth(S) + sum of P(S without i) for i in S) / |S|,

is computed once for each of the 32 coalitions, in exact integers: |S|! P(S). A
filter's Shapley value is P(all) - P(all without it). What a step of an order
removes is the difference in worth between the coalitions after and before it,
so all 120 orders follow from the 32 worths, and the rows are read once.

Rows leave their text behind where they are read: a hash for equality, and five
flags. Copies of a text, however many, are counted by partial aggregates; no
group of rows is ever collected. What comes out of the last aggregate has at most
32 rows for each part.

Defined cases: a NULL text is an empty one, and equal to it; a NULL part is ''; a
row with a NULL id is no copy of a smaller id, nor has it labels; rows that
repeat an id are counted each, are no copies of each other, and share labels,
where one label of several suffices; an empty table gives an empty result; other
columns never matter.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import SPACE, col, cut

NAMES = "ABCDE"
ALL = (1 << len(NAMES)) - 1
COUNTED = ("n", "good", "toxic")


def failures(text: Column, words: Column) -> list[Column]:
    """The flags of the filters that read one text: A, B, C, D."""
    n = F.size(words)
    upper = F.char_length(text) - F.char_length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return [n < 100, 100 * F.size(F.array_distinct(words)) < 80 * n, 100 * upper > 10 * F.char_length(text), text.rlike("[#$%&*|]")]


def failed_masks(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(part, mask, n, good, toxic): rows by the set of filters that they fail, as bits."""
    text = docs.select(col(docs, id_col).alias("id"), F.coalesce(col(docs, part_col).cast("string"), F.lit("")).alias("part"),
                       F.coalesce(col(docs, text_col), F.lit("")).alias("text"))
    words = text.withColumn("words", F.array_remove(F.split("text", SPACE), ""))
    mask = sum((F.when(bad, 1 << i).otherwise(0) for i, bad in enumerate(failures(F.col("text"), F.col("words")))), F.lit(0))
    # rows of one id and text are one row with a count from here on
    rows = words.select("id", "part", F.sha2("text", 256).alias("key"), mask.alias("mask")).groupBy("id", "part", "key", "mask").agg(F.count("*").alias("n"))
    marks = labels.where(col(labels, "doc_id").isNotNull()).groupBy(col(labels, "doc_id").alias("id")).agg(
        F.coalesce(F.max(col(labels, "quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(col(labels, "toxic") == 1), F.lit(False)).alias("toxic"))
    # NULL ids are dealt out by their text, and meet nothing
    spread = F.when(F.col("id").isNull(), F.col("key")).otherwise("")
    rows = rows.withColumn("spread", spread).join(marks.withColumn("spread", F.lit("")), ["id", "spread"], "left")
    kinds = ["key", "part", "mask", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic")]
    # of equal texts: how many rows of each kind, and how many of them have the smallest id of the kind
    rows = rows.groupBy(*kinds, F.col("id").isNull().alias("no_id"), "id").agg(F.sum("n").alias("n"))
    equal = cut(rows.groupBy("key", "part", "mask", "good", "toxic", "no_id").agg(
        F.sum("n").alias("n"), F.min("id").alias("low"), F.min_by("n", "id").alias("at_low")))
    each = equal.join(equal.groupBy("key").agg(F.min("low").alias("lowest")), "key")
    first = F.when(F.col("no_id"), F.col("n")).when(F.col("low") == F.col("lowest"), F.col("at_low")).otherwise(F.lit(0))
    split = each.withColumn("first", first).select(
        "part", "good", "toxic", F.explode(F.array(
            F.struct(F.col("mask"), F.col("first").alias("n")),
            F.struct(F.col("mask").bitwiseOR(F.lit(16)).alias("mask"), (F.col("n") - F.col("first")).alias("n")))).alias("x"))
    return split.groupBy("part", F.col("x.mask").alias("mask")).agg(
        F.sum("x.n").alias("n"), F.sum(F.when(F.col("good"), F.col("x.n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("x.n")).otherwise(0)).alias("toxic"))


def worths(masks: DataFrame) -> DataFrame:
    """(part, and per count an array over the coalitions): rows that fail one of
    a coalition's filters; coalition 0 holds the number of all rows."""
    met = masks.select("part", *COUNTED, F.explode(F.filter(F.sequence(F.lit(0), F.lit(ALL)), lambda s: (s == 0) | (
        s.bitwiseAND(F.col("mask")) != 0))).alias("s"))
    sums = met.groupBy("part", "s").agg(*[F.sum(c).alias(c) for c in COUNTED])
    whole = sums.groupBy("part").agg(*[F.map_from_entries(F.collect_list(F.struct("s", c))).alias(c) for c in COUNTED])  # 32 entries
    return whole.select("part", *[F.array(*[F.coalesce(F.col(c)[s], F.lit(0)) for s in range(ALL + 1)]).alias(c) for c in COUNTED])


def members(coalition: int) -> list[int]:
    return [i for i in range(len(NAMES)) if coalition >> i & 1]


def potentials(worth: list[int]) -> list[int]:
    """|S|! P(S) of every coalition S (a set of bits) of the game ``worth``."""
    found = [0] * len(worth)
    for s in range(1, len(worth)):
        inside = members(s)
        found[s] = factorial(len(inside) - 1) * worth[s] + sum(found[s ^ 1 << i] for i in inside)
    return found


def shapley_sums(worth: list[int]) -> list[int]:
    """Per filter, its Shapley value times the number of orders: P(all) less P(all without it), times n!."""
    p, n = potentials(worth), len(NAMES)
    return [p[-1] - n * p[ALL ^ 1 << i] for i in range(n)]


def report(total: int, n: list[int], good: list[int], toxic: list[int]) -> list[tuple]:
    """The rows of one part: order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    shapley, rows = shapley_sums(n), []
    for order in permutations(range(len(NAMES))):
        before = 0
        for step, i in enumerate(order, 1):
            after = before | 1 << i
            removed = n[after] - n[before]
            rows.append(("".join([NAMES[x] for x in order]), step, total - n[after], removed, n[1 << i] - removed, n[ALL] - n[ALL ^ 1 << i],
                         good[after] - good[before], toxic[after] - toxic[before], shapley[i]))
            before = after
    return rows


COLUMNS = ["filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """One row per part, order of the filters and step."""
    def parts(batches):
        for batch in batches:
            for r in batch.itertuples(index=False):
                games = {c: [0, *map(int, getattr(r, c)[1:])] for c in COUNTED}
                out = pd.DataFrame(report(int(r.n[0]), **games), columns=COLUMNS)
                out.insert(0, "part", r.part)
                yield out

    return worths(failed_masks(docs, labels, id_col, text_col, part_col)).mapInPandas(
        parts, "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
               "good_lost long, toxic_lost long, shapley long")


def oracle() -> str:
    """DuckDB SQL of ``op13``'s rows, by counting the rows in every order."""
    any_of = " OR ".join(f"(f.{c} AND strpos(substr(o.filter_order, 1, {{k}}), '{c}') > 0)" for c in NAMES)
    flag = "CASE letter " + " ".join(f"WHEN '{c}' THEN f.{c}" for c in NAMES) + " END"
    alone = "CASE letter " + " ".join(f"WHEN '{c}' THEN f.{c}" + "".join(f" AND NOT f.{x}" for x in NAMES if x != c) for c in NAMES) + " END"
    before = any_of.replace("{k}", "step - 1")
    letters = "(VALUES " + ", ".join(f"('{c}')" for c in NAMES) + ")"
    tables = ", ".join(f"{letters} t{i}(c{i})" for i in range(5))
    apart = " AND ".join(f"c{i} != c{j}" for i in range(5) for j in range(i))
    return rf"""
WITH w AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
d AS (SELECT doc_id, part, len(w) < 100 AS A, 100 * len(list_distinct(w)) < 80 * len(w) AS B,
      100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t) AS C, regexp_matches(t, '[#$%&*|]') AS D,
      coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS E FROM w),
l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
f AS (SELECT part, A, B, C, D, E, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
      FROM d LEFT JOIN l ON d.doc_id = l.doc_id GROUP BY ALL),
o AS (SELECT c0 || c1 || c2 || c3 || c4 AS filter_order FROM {tables} WHERE {apart}),
s AS (SELECT filter_order, step::int AS step, substr(filter_order, step::int, 1) AS letter FROM o, range(1, 6) x(step)),
r AS (SELECT part, o.filter_order, o.step, o.letter,
      coalesce(sum(f.n) FILTER (NOT coalesce({before}, false) AND NOT {flag}), 0) AS kept,
      coalesce(sum(f.n) FILTER (NOT ({before}) AND {flag}), 0) AS removed,
      coalesce(sum(f.n) FILTER (({before}) AND {flag}), 0) AS redundant,
      coalesce(sum(f.n) FILTER ({alone}), 0) AS unique_fails,
      coalesce(sum(f.good) FILTER (NOT ({before}) AND {flag}), 0) AS good_lost,
      coalesce(sum(f.toxic) FILTER (NOT ({before}) AND {flag}), 0) AS toxic_lost
      FROM f, s o GROUP BY ALL)
SELECT part, filter_order, step, kept::bigint AS kept, removed::bigint AS removed, redundant::bigint AS redundant,
       unique_fails::bigint AS unique_fails, good_lost::bigint AS good_lost, toxic_lost::bigint AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, letter))::bigint AS shapley FROM r"""
