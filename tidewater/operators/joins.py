"""Joins: detail-else-bulk, top-1 lookups, two-stage
resolution, existence flags, anti-joins.

Scale rules used throughout:
* never an ``OR`` join (Spark plans it as a nested loop) -- the two-stage
  match is a chain of two equi-joins, the second with NULL keys where the first hit;
* the right side of a lookup is first reduced to one row per key with
  ``row_number() = 1``, which Catalyst plans with a partial (map-side)
  WindowGroupLimit, so a hot key on the right never reaches one task whole,
  and the join can only fan out by one;
* left rows whose key is NULL cannot match: they join on a salted stand-in
  key and a null flag, so they spread over reducers instead of all hashing
  to one (see ``left_lookup``); the flag is a condition, not a key, so a right
  side that is already partitioned by its key is not shuffled again;
* several lookups on the same key are merged into one join
  (``left_lookup_many``) or share one salted key (``left_joins``), so the big
  side is shuffled once; a chain on several keys carries one small salt, not
  the columns to hash it from;
* no broadcast hints. Spark guesses a side's size from its files: the keys of
  millions of rows may pass for less than ``spark.sql.autoBroadcastJoinThreshold``
  and then stand whole in every task. A right side that grows as the left
  does (``grows``) is therefore merged at any size; AQE splits skewed
  partitions.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _list(x) -> list:
    return [x] if isinstance(x, str) else list(x)


def _all(conds: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds)


_TAG = itertools.count()


def _tag() -> str:
    """Unique suffix for join-side columns: joins resolve by name, never by a
    DataFrame-qualified reference (which breaks on self-joins)."""
    return f"_j{next(_TAG)}"


def match_left(left: DataFrame, right: DataFrame, on, how: str = "left") -> DataFrame:
    """Equi-join; a string or list ``on`` merges the key (``USING``)."""
    return left.join(right, on, how)


def match_inner(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join on several keys.  The right side must be unique per key
    (event ids are); use ``one_per_key`` first when it is not."""
    return left.join(right, list(on), "inner")


def reconcile(left: DataFrame, right: DataFrame, key, how: str = "inner") -> DataFrame:
    """Join two sources of the same documents by their key."""
    return left.join(right, _list(key), how)


def one_per_key(df: DataFrame, key, order, take: Sequence[str] | None = None,
                largest: bool = False) -> DataFrame:
    """One row per key: the smallest (or largest) by ``order``.

    Written as ``row_number() OVER (PARTITION BY key ORDER BY order) = 1``:
    Catalyst plans it with a *partial* WindowGroupLimit before the shuffle,
    so every map task keeps one row per key and a key holding a third of the
    rows arrives as one row per task (same protection as a partial aggregate,
    without packing rows into structs). ``order`` must be a total order for a
    deterministic pick (D4)."""
    from pyspark.sql import Window
    key, order = _list(key), _list(order)
    take = list(take) if take is not None else [c for c in df.columns if c not in key]
    oc = [F.col(c) if isinstance(c, str) else c for c in order]
    ordering = [c.desc_nulls_last() if largest else c.asc_nulls_last() for c in oc]
    w = Window.partitionBy(*[F.col(k) for k in key]).orderBy(*ordering)
    return (df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
              .select(*key, *[c for c in take if c not in key]))


_SALTABLE = ("string", "bigint", "int", "smallint", "tinyint")


def _salt_for(dtype: str, salt: Column) -> Column | None:
    """A stand-in key value of ``dtype`` spread by ``salt``, or None if the
    type has no cheap stand-in."""
    if dtype == "string":
        return salt.cast("string")
    if dtype == "bigint":
        return salt
    if dtype in ("int", "smallint", "tinyint"):
        bound = {"int": 2 ** 31 - 1, "smallint": 2 ** 15 - 1, "tinyint": 127}[dtype]
        return F.pmod(salt, F.lit(bound)).cast(dtype)
    return None


_ATOMIC = ("string", "bigint", "int", "smallint", "tinyint", "double", "float", "boolean", "date",
           "timestamp", "timestamp_ntz")


def _merged(right: DataFrame, grows: bool) -> DataFrame:
    return right.hint("merge") if grows else right


def _row_hash(df: DataFrame) -> Column:
    """Deterministic hash of a row from up to eight atomic columns (maps,
    variants and arrays are skipped: cheap, and every type hashes)."""
    cols = [F.col(c) for c, t in df.dtypes if t in _ATOMIC or t.startswith("decimal")][:8]
    return F.xxhash64(*cols) if cols else F.lit(0).cast("bigint")


SALTS = 1 << 16  # values of a carried salt: enough to spread rows over any number of reducers


def _salt(df: DataFrame) -> Column:
    """A small salt to carry through a chain of joins: two bytes a row where its columns would be hundreds."""
    return F.pmod(_row_hash(df), F.lit(SALTS))


def left_lookup(left: DataFrame, right_unique: DataFrame, left_keys, right_keys,
                take: Sequence[str], salt: Column | None = None, grows: bool = False) -> DataFrame:
    """Left join to a right side that is unique per key (so no fan-out).

    Rows with a NULL key cannot match; in a plain join they would all hash to
    one reducer. Here they join on a salted stand-in key (``salt``, or a hash
    of the row) under a condition that they never meet, so they spread over
    all reducers and still never match -- one pass, no second scan. Key types
    without a cheap stand-in fall back to splitting the NULL rows off.
    ``grows``: the right side grows as the left does; it is never broadcast.
    """
    left_keys, right_keys, take = _list(left_keys), _list(right_keys), list(take)
    g = _tag()
    ltypes = dict(left.dtypes)
    r = right_unique.select(*[F.col(k).alias(f"{g}k{i}") for i, k in enumerate(right_keys)],
                            *[F.col(c).alias(f"{g}t{j}") for j, c in enumerate(take)])
    types, r = dict(r.dtypes), _merged(r, grows)
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in left_keys])
    salt = _row_hash(left) if salt is None else salt
    stand_ins = [_salt_for(ltypes[k], salt) for k in left_keys]
    out_cols = [*[F.col(c) for c in left.columns], *[F.col(f"{g}t{j}").alias(c) for j, c in enumerate(take)]]
    if all(sv is not None for sv in stand_ins):
        l = left.select("*", any_null.alias(f"{g}ln"),
                        *[F.coalesce(F.col(k), sv).alias(f"{g}lk{i}") for i, (k, sv) in enumerate(zip(left_keys, stand_ins))])
        cond = _all([F.col(f"{g}lk{i}") == F.col(f"{g}k{i}") for i in range(len(left_keys))]
                    + [~F.col(f"{g}ln")])
        return l.join(r, cond, "left").select(*out_cols)
    nonnull = ~any_null
    cond = _all([F.col(lk) == F.col(f"{g}k{i}") for i, lk in enumerate(left_keys)])
    hit = left.filter(nonnull).join(r, cond, "left").select(*out_cols)
    miss = left.filter(any_null).select("*", *[F.lit(None).cast(types[f"{g}t{j}"]).alias(c) for j, c in enumerate(take)])
    return hit.unionByName(miss)


def left_joins(left: DataFrame, left_key: str, rights: Sequence[tuple]) -> DataFrame:
    """Several left joins on the same key with ONE shuffle and sort of ``left``.

    ``rights`` is ``[(right, right_key, take), ...]``, sides that grow as the
    left does and need not be unique: several right rows fan out. NULL keys are
    spread as in ``left_lookup``, by one salted key for all joins."""
    g = _tag()
    salt = _salt_for(dict(left.dtypes)[left_key], _salt(left))
    key = F.col(left_key) if salt is None else F.coalesce(F.col(left_key), salt)
    out = left.select("*", key.alias(f"{g}lk"), F.col(left_key).isNull().alias(f"{g}ln"))
    for i, (right, right_key, take) in enumerate(rights):
        r = right.select(F.col(right_key).alias(f"{g}k{i}"), *[F.col(c) for c in take if c != right_key])
        out = out.join(_merged(r, True), (F.col(f"{g}lk") == F.col(f"{g}k{i}")) & ~F.col(f"{g}ln"), "left")
    return out.select(*[F.col(c) for c in left.columns], *[F.col(c) for _, _, take in rights for c in take])


def left_lookup_many(left: DataFrame, left_key: str, rights: Sequence[tuple]) -> DataFrame:
    """Several left lookups on the same key with ONE shuffle of ``left``.

    ``rights`` is ``[(right_unique, right_key, take), ...]``; every right side
    is unique per key. They are first merged into one row per key (a union
    and a partial ``first(ignorenulls)`` aggregate over the small sides),
    then joined once -- instead of re-shuffling the big side for each."""
    cols, parts = [], []
    for _, _, take in rights:
        cols += list(take)
    types = {}
    for r, _, take in rights:
        types.update({c: t for c, t in r.dtypes if c in take})
    for r, rk, take in rights:
        parts.append(r.select(F.col(rk).alias("_mk"),
                              *[F.col(c) if c in take else F.lit(None).cast(types[c]).alias(c) for c in cols]))
    merged = parts[0]
    for p in parts[1:]:
        merged = merged.unionByName(p)
    merged = merged.groupBy("_mk").agg(*[F.first(c, ignorenulls=True).alias(c) for c in cols])
    return left_lookup(left, merged, left_key, "_mk", cols, grows=True)


def lookup_first(left: DataFrame, right: DataFrame, left_key, right_key, order,
                 take: Sequence[str]) -> DataFrame:
    """``LEFT JOIN LATERAL (... WHERE r.key = l.key ORDER BY order LIMIT 1)``.

    Blank keys should already be NULL (``blank_to_null``). ``take`` may name
    the right key columns too; names must not clash with ``left``'s."""
    right_key = _list(right_key)
    first = one_per_key(right, right_key, order, take=[c for c in take if c not in right_key])
    return left_lookup(left, first, left_key, right_key, take)


def resolve(left: DataFrame, right: DataFrame, direct: tuple, composite: tuple, order,
            take: Sequence[str], matched_by: str | None = None) -> DataFrame:
    """J4 + J5: top-1 by a direct key, else top-1 by a composite key.

    ``direct = (left_col, right_col)``; ``composite = ([left cols], [right cols])``.
    One chain of two lookups over one read of ``left``: where the direct key
    hit, the composite keys are NULL, so those rows cannot match again (and are
    spread by ``left_lookup``, both times by one small salt). The result has the ``take`` columns of whichever
    match won and, if ``matched_by`` is given, a column saying 'direct',
    'composite' or NULL. Both right sides are first reduced to one row per key
    (smallest by ``order``, D4), so neither join can fan out.
    """
    lk, rk = direct
    lcs, rcs = list(composite[0]), list(composite[1])
    take, g = list(take), _tag()
    sides = []
    for n, keys in (("d", [rk]), ("c", rcs)):
        one = one_per_key(right, keys, order, take=[c for c in take if c not in keys])
        sides.append(one.select(*[F.col(k).alias(f"{g}{n}k{i}") for i, k in enumerate(keys)],
                                *[F.col(c).alias(f"{g}{n}{i}") for i, c in enumerate(take)], F.lit(True).alias(f"{g}{n}hit")))
    cols = lambda n: [f"{g}{n}{i}" for i in range(len(take))] + [f"{g}{n}hit"]
    salted = left.withColumn(f"{g}s", _salt(left))
    first = left_lookup(salted, sides[0], lk, f"{g}dk0", cols("d"), salt=F.col(f"{g}s"), grows=True)
    first = first.select("*", *[F.when(F.col(f"{g}dhit").isNull(), F.col(c)).alias(f"{g}l{i}") for i, c in enumerate(lcs)])
    both = left_lookup(first, sides[1], [f"{g}l{i}" for i in range(len(lcs))], [f"{g}ck{i}" for i in range(len(rcs))], cols("c"),
                       salt=F.col(f"{g}s"), grows=True)
    won = [F.when(F.col(f"{g}dhit"), F.col(f"{g}d{i}")).otherwise(F.col(f"{g}c{i}")).alias(c) for i, c in enumerate(take)]
    via = [F.when(F.col(f"{g}dhit"), F.lit("direct")).when(F.col(f"{g}chit"), F.lit("composite")).alias(matched_by)] if matched_by else []
    return both.select(*[F.col(c) for c in left.columns], *won, *via)


def with_exists(left: DataFrame, right: DataFrame, left_on, right_on, flag: str, grows: bool = False) -> DataFrame:
    """``EXISTS (...)`` as a boolean column, no fan-out: left join to the
    distinct right keys (distinct is a partial aggregate)."""
    left_on, right_on = _list(left_on), _list(right_on)
    keys = (right.select(*[F.col(r).alias(f"_ek{i}") for i, r in enumerate(right_on)])
                 .distinct().withColumn(flag, F.lit(True)))
    out = left_lookup(left, keys, left_on, [f"_ek{i}" for i in range(len(right_on))], [flag], grows=grows)
    return out.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def without(left: DataFrame, right: DataFrame, left_on, right_on=None, grows: bool = False) -> DataFrame:
    """Rows of ``left`` with no match in ``right``
    (``NOT EXISTS``; equals ``NOT IN`` when keys are non-null). ``grows`` as in ``left_lookup``."""
    return _filter_join(left, right, left_on, right_on, "left_anti", grows)


def _filter_join(left, right, left_on, right_on, how, grows):
    left_on = _list(left_on)
    right_on = _list(right_on) if right_on is not None else left_on
    g = _tag()
    # distinct keys: a partial aggregate whose shuffle already partitions by
    # the join key, so a right-side key holding a third of the rows arrives
    # as one row and the join needs no further exchange of that side
    r = right.select(*[F.col(c).alias(f"{g}k{i}") for i, c in enumerate(right_on)]).distinct()
    cond = _all([F.col(l) == F.col(f"{g}k{i}") for i, l in enumerate(left_on)])
    return left.join(_merged(r, grows), cond, how)


def missing_detail(bulk: DataFrame, detail: DataFrame, key: str, detail_key: str | None = None) -> DataFrame:
    """Bulk rows whose key has no detail document."""
    return without(bulk, detail, key, detail_key or key, grows=True)


def prefer(details: DataFrame, bulk: DataFrame, key: str) -> DataFrame:
    """Detail rows, plus bulk rows whose key has no detail (``UNION ALL``
    + ``NOT EXISTS``). Both inputs must have the same columns."""
    return details.unionByName(without(bulk, details.select(key), key, grows=True))
