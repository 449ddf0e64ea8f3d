"""W1 and the worked-interval views built on it (V4, V5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.scalar import hours_between
from tidewater.fixed_values import END_ACTIONS, START_ACTIONS


_NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def _bucket(df: DataFrame, col: str, width: float):
    """Bucket monotone in ``col``; None when the type has no such bucket."""
    dt = dict(df.dtypes)[col]
    if dt.startswith("timestamp"):
        return F.floor(F.unix_micros(F.col(col).cast("timestamp")) / F.lit(width * 1e6))
    if dt == "date":
        return F.floor(F.unix_date(F.col(col)) / F.lit(width / 86400.0))
    if dt in _NUMERIC or dt.startswith("decimal"):
        return F.floor(F.col(col) / F.lit(width))
    return None


def with_next(df: DataFrame, by: Sequence[str], order: Sequence[str], cols: Sequence[str],
              prefix: str = "next_", strategy: str = "bucket", width: float = 3600.0) -> DataFrame:
    """``lead(col) OVER (PARTITION BY by ORDER BY order)`` for each col.

    ``strategy='group'`` is the plain window: one shuffle on ``by``, but one
    task holds a whole group.  ``strategy='bucket'`` (default) has the same plan
    for every group, of any size, and survives one that holds a third of all
    rows; it is deterministic (no partition ids, no sampling):

    1. every row gets a bucket of the first order column (``width`` seconds for
       times, units for numbers), so a hot group spreads over its buckets;
    2. the first row of every bucket is a partial aggregate (``min_by``); a
       window over those rows (one per bucket, bounded by the time span, not by
       the data) gives each bucket the first row of the next non-empty bucket
       of its group;
    3. that row is appended to the bucket as a sentinel sorting last, and
       ``lead`` runs inside (group, bucket): the bucket's last real row leads
       into the sentinel -- no join, one shuffle of the data (the window's),
       NULL groups handled as the window handles them.
    ``order`` should be a total order within a group (ties make lead arbitrary,
    as in SQL). A text first order column has no monotone bucket; the plain
    window is used then.
    """
    by, order, cols = list(by), list(order), list(cols)
    bucket = _bucket(df, order[0], width) if strategy != "group" else None
    if bucket is None:  # 'group', or a first order column with no monotone bucket (text)
        w = Window.partitionBy(*by).orderBy(*order)
        return df.select("*", *[F.lead(c).over(w).alias(prefix + c) for c in cols])

    b = df.withColumn("_b", bucket.cast("bigint")).withColumn("_s", F.lit(0))
    firsts = (b.groupBy(*by, "_b")
               .agg(F.min_by(F.struct(*[F.col(c).alias(f"_v{i}") for i, c in enumerate(cols)]),
                             F.struct(*[F.col(o) for o in order])).alias("_f")))
    nxt = (firsts.select(*by, "_b", F.lead("_f").over(Window.partitionBy(*by).orderBy("_b")).alias("_nf"))
                 .filter(F.col("_nf").isNotNull()))
    # one sentinel row per bucket carrying the next bucket's first row; it
    # sorts after the bucket's rows, so the last real row's lead reads it
    sentinels = nxt.select(*by, "_b", *[F.col("_nf").getField(f"_v{i}").alias(c)
                                        for i, c in enumerate(cols) if c not in by],
                           F.lit(1).alias("_s"))
    u = b.unionByName(sentinels, allowMissingColumns=True)
    w = Window.partitionBy(*by, "_b").orderBy("_s", *[F.col(o) for o in order])
    return (u.select(*[F.col(c) for c in df.columns], *[F.lead(c).over(w).alias(prefix + c) for c in cols],
                     F.col("_s"))
             .filter(F.col("_s") == 0).drop("_s"))


def work_intervals(registries: DataFrame, parent: str, event: str = "event_id",
                   time: str = "event_time", seq: str = "event_registry_id",
                   action: str = "action", owner: str = "operator_id",
                   events: DataFrame | None = None,
                   starts: Sequence[str] = START_ACTIONS,
                   ends: Sequence[str] = END_ACTIONS,
                   strategy: str = "bucket", width: float = 3600.0) -> DataFrame:
    """V4 / V5: worked intervals from state transitions.

    ``registries`` has (parent, event, time, seq, action); ``events`` has
    (parent, event, owner) and is unique per (parent, event). Registries of an
    event with no owner are dropped; the owner is the event's (D17). A row is
    kept when its action starts work and the next action of the same
    (parent, event) ends it.
    """
    if events is not None:
        owned = events.filter(F.col(owner).isNotNull()).select(parent, event, owner)
        raw = registries.join(owned, [parent, event], "inner")
    else:
        raw = registries.filter(F.col(owner).isNotNull())
    raw = raw.select(parent, event, owner, action, time, seq)
    nxt = with_next(raw, [parent, event], [time, seq], [time, action], strategy=strategy, width=width)
    keep = (F.col(action).isin(list(starts)) & F.col("next_" + action).isin(list(ends))
            & F.col("next_" + time).isNotNull())
    return nxt.filter(keep).select(
        F.col(parent), F.col(owner).alias("operator_id"),
        F.col(action).alias("status_inicio"), F.col("next_" + action).alias("status_fim"),
        F.col(time).alias("data_inicio"), F.col("next_" + time).alias("data_fim"),
        (F.col("next_" + time) - F.col(time)).alias("duracao"),
        hours_between(time, "next_" + time).alias("horas_decimais"))
