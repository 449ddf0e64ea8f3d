"""Bronze table changes: de-duplication, upsert, soft delete,
dead letters, versioned writes, view registry.

Plain Parquet has no MERGE, so a table is a folder of versions
``<base>/v=<n>/`` (each complete, with ``_SUCCESS``); readers take the newest
complete one. Writing a new version and then reading it is also how a job cuts
lineage: the folder lives under the shared ``spark.checkpoint.dir`` (or the
table's own shared location), never on a machine-local disk.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators.joins import one_per_key, with_exists, without
from tidewater.fixed_values import DELETED_MARKER


def _list(x) -> list:
    return [x] if isinstance(x, str) else list(x)


def dedupe_last(df: DataFrame, key, order) -> DataFrame:
    """K2: one row per key, the LAST by ``order`` wins.

    ``row_number() = 1`` by descending ``order``, planned by Catalyst with a
    partial WindowGroupLimit, so a hot key is reduced to one row in every map
    task before the shuffle. Parsers return ``arrival``, the order for landed
    files: day in the file name, time of the file, file name, place in it."""
    key = _list(key)
    cols = [c for c in df.columns if c not in key]
    return one_per_key(df, key, _list(order), take=cols, largest=True).select(*df.columns)


def upsert(target: DataFrame, updates: DataFrame, key, order,
           stamp: str | None = None) -> DataFrame:
    """K1: ``INSERT ... ON CONFLICT (key) DO UPDATE``.

    The batch is first de-duplicated (K2, D13; not if ``order`` is empty, for a
    batch that has one row per key); its rows replace the target's rows of the
    same key, the rest of the target is kept. With ``stamp`` the batch rows get
    ``stamp = current_timestamp()`` (``extracted_at``). Idempotent: applying
    the same batch twice gives the same table."""
    key = _list(key)
    batch = dedupe_last(updates, key, order) if order else updates
    if stamp:
        batch = batch.withColumn(stamp, F.current_timestamp())
    kept = without(target, batch.select(*key), key)
    return batch.unionByName(kept, allowMissingColumns=True)


def _set_in_variant(v: Column, parts: Sequence[str], value: Column) -> Column:
    """Return a VARIANT with ``parts`` set to ``value`` (a VARIANT); other
    fields and their JSON types are kept."""
    m = F.variant_get(v, "$", "map<string,variant>")
    k = parts[0]
    if len(parts) == 1:
        new = value
    else:
        child = F.coalesce(m[k], F.parse_json(F.lit("{}")))
        new = _set_in_variant(child, parts[1:], value)
    merged = F.map_concat(F.map_filter(m, lambda kk, _: kk != F.lit(k)), F.create_map(F.lit(k), new))
    return F.to_variant_object(merged)


def set_path(doc: Column, parts: Sequence[str], value: str) -> Column:
    """``jsonb_set(doc, '{a,b}', '"value"')`` on JSON text."""
    return F.to_json(_set_in_variant(F.parse_json(doc), list(parts), F.parse_json(F.lit(json.dumps(value)))))


def soft_delete(df: DataFrame, ids: DataFrame, key: str, parts: Sequence[str],
                marker: str = DELETED_MARKER, doc: str = "data", ids_key: str | None = None,
                stamp: str | None = None) -> DataFrame:
    """K5: mark documents of the given ids -- ``parts`` is the path of the
    state field (``['attributes','state']`` for bulk rows,
    ``['data','attributes','status']`` for detail rows) -- and refresh
    ``stamp``. Other rows pass unchanged. Works on VARIANT or JSON-text
    documents; only the marked rows are rewritten."""
    flagged = with_exists(df, ids, key, ids_key or key, "_gone")
    if dict(df.dtypes)[doc] == "variant":
        new = _set_in_variant(F.col(doc), list(parts), F.parse_json(F.lit(json.dumps(marker))))
    else:
        new = set_path(F.col(doc), parts, marker)
    out = flagged.withColumn(doc, F.when(F.col("_gone"), new).otherwise(F.col(doc)))
    if stamp:
        out = out.withColumn(stamp, F.when(F.col("_gone"), F.current_timestamp()).otherwise(F.col(stamp)))
    return out.drop("_gone")


class Metrics:
    """Result of ``observed``: ``get`` is the metrics dict once an action ran.

    Spark prunes a plan branch it proves empty (also at runtime, under AQE)
    together with its observation; no metrics arrive then, which can only
    mean that no row passed: ``rows`` reads 0 and other metrics None."""

    def __init__(self, obs, names):
        self._obs, self._names = obs, names

    @property
    def get(self) -> dict:
        try:
            return self._obs.get
        except Exception:  # noqa: BLE001 -- pruned as empty, see above
            return {"rows": 0, **{n: None for n in self._names}}


def observed(df: DataFrame, name: str = "batch", **metrics: Column):
    """K3: running totals and error counts of a load, from the same job.

    Returns ``(df, metrics)``; after the write (any action on ``df``)
    ``metrics.get`` holds ``rows`` plus the named metrics, e.g.
    ``errors=F.count_if(F.col("error").isNotNull())``. No second pass over
    the data and no bounded client-side batches."""
    from pyspark.sql import Observation
    obs = Observation(name)
    out = df.observe(obs, F.count(F.lit(1)).alias("rows"), *[c.alias(k) for k, c in metrics.items()])
    return out, Metrics(obs, list(metrics))


def write_rejects(rejects: DataFrame, path: str, job_date: str, job: str) -> None:
    """K6: failures (``file_name, error``) of one job and day, as the folder
    ``job_date=<day>/job=<name>`` of the dead-letter table (S14 / S10 read it
    back). The folder is replaced, so a job that is run again does not double
    its rows, and one that now succeeds clears them."""
    rejects.write.mode("overwrite").parquet(f"{path}/job_date={job_date}/job={job}")


_VERSION = re.compile(r"v=(\d+)$")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def versions(spark: SparkSession, base: str, complete: bool = True) -> list[int]:
    """Versions of a table folder, oldest first (metadata only). By default
    only complete ones (with ``_SUCCESS``); ``complete=False`` lists every
    version folder, including one a crashed write left behind."""
    fs, p = _fs(spark, base)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        m = _VERSION.search(st.getPath().getName())
        if m and (not complete or fs.exists(st.getPath().suffix("/_SUCCESS"))):
            out.append(int(m.group(1)))
    return sorted(out)


def read_current(spark: SparkSession, base: str) -> DataFrame | None:
    """The newest complete version of a bronze/gold table."""
    vs = versions(spark, base)
    return read_folder(spark, f"{base}/v={vs[-1]}") if vs else None


def write_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Keep a table folder's schema beside its files: a table without rows may have none."""
    fs, p = _fs(spark, f"{path}/_schema")
    out = fs.create(p, True)
    try:
        out.write(bytearray(schema.json().encode()))
    finally:
        out.close()


def read_schema(spark: SparkSession, path: str) -> T.StructType | None:
    fs, p = _fs(spark, f"{path}/_schema")
    if not fs.exists(p):
        return None
    with_text = fs.open(p)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(with_text, "UTF-8")
    finally:
        with_text.close()
    return T.StructType.fromJson(json.loads(text))


def read_folder(spark: SparkSession, path: str) -> DataFrame:
    """A table folder; one without files has no rows of the schema kept with it."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        schema = read_schema(spark, path)
        if e.getCondition() != "UNABLE_TO_INFER_SCHEMA" or schema is None:
            raise
        return spark.createDataFrame([], schema)


def commit_version(df: DataFrame, base: str, partition_by: Sequence[str] = (), keep: int = 3) -> DataFrame:
    """K1/K4 swap: write ``df`` as the next version and return it read back.

    Readers of the previous version are never disturbed (no in-place
    overwrite); a failed write leaves no ``_SUCCESS`` and is ignored. The
    newest ``keep`` complete versions stay, older ones are removed."""
    spark = df.sparkSession
    vs = versions(spark, base, complete=False)   # skip folders of crashed writes too
    n = (vs[-1] + 1) if vs else 0
    w = by_partition(df, partition_by).write.mode("error")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(f"{base}/v={n}")
    write_schema(spark, f"{base}/v={n}", df.schema)
    for old in versions(spark, base)[:-keep]:
        fs, p = _fs(spark, f"{base}/v={old}")
        fs.delete(p, True)
    return read_folder(spark, f"{base}/v={n}")


def by_partition(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of a table partition meet in few tasks (as many as its size asks
    for: Spark splits large ones and joins small ones), so a write makes few
    files per partition instead of tasks x partitions."""
    return df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df


def upsert_table(updates: DataFrame, base: str, key, order, stamp: str | None = "extracted_at") -> DataFrame:
    """K1 on a versioned table folder: current version + batch -> next version.
    For small tables: it rewrites the whole table (else ``upsert_partitioned``)."""
    spark = updates.sparkSession
    current = read_current(spark, base)
    batch = dedupe_last(updates, key, order) if order else updates
    if stamp:
        batch = batch.withColumn(stamp, F.current_timestamp())
    return commit_version(batch if current is None else upsert(current, batch, key, ()), base)


def refresh(df: DataFrame, base: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """K4: recompute a materialised result and swap it in (partition the gold
    table by its day column so that period queries prune)."""
    return commit_version(df, base, partition_by)


def verify_count(df: DataFrame) -> int:
    """K9: row count after a build."""
    return df.count()


def register_all(spark: SparkSession, views: Mapping[str, DataFrame]) -> None:
    """Register views by name (``v_fiscal_lancamentos`` over the
    materialised ledger is a plain alias)."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def key_bucket(key: str, buckets: int = 256) -> Column:
    """Default partition of a keyed table: a hash bucket of the key."""
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets))


def note_month(key: str) -> Column:
    """Partition for 44-digit tax-note keys: digits 3-6 are the issue YYMM, so
    a day's batch touches one or two partitions."""
    return F.substring(F.col(key), 3, 4)


def upsert_partitioned(updates: DataFrame, path: str, key: str, partition: Column, order,
                       stamp: str | None = "extracted_at", part_col: str = "part") -> DataFrame:
    """K1 at scale: rewrite only the partitions a batch touches.

    The table at ``path`` is partitioned by ``part_col`` = ``partition``, an
    expression of the key alone (so a key never moves). The batch is
    de-duplicated (K2; not if ``order`` is empty) and computed once, as a
    reliable ``checkpoint()`` under ``spark.checkpoint.dir``. The touched
    partitions of the table are read (static partition pruning on a list
    bounded by the number of partitions), merged, cut from their lineage in the
    same way (the write then no longer reads the files it replaces) and written
    back with dynamic partition overwrite. A failed job leaves the old
    partitions in place; re-running the batch gives the same table."""
    spark = updates.sparkSession
    from tidewater.session import checkpoint_dir
    checkpoint_dir(spark)  # the shared folder must exist; fails clearly when unset
    batch = dedupe_last(updates, key, order) if order else updates
    if stamp:
        batch = batch.withColumn(stamp, F.current_timestamp())
    batch = batch.withColumn(part_col, partition).checkpoint(eager=True)
    fs, p = _fs(spark, path)
    exists = fs.exists(p) and any(st.getPath().getName().startswith(f"{part_col}=") for st in fs.listStatus(p))
    # explicit schema: partition values stay text (no '0101' -> 101 inference)
    read = lambda: spark.read.schema(batch.schema).parquet(path)
    if not exists:
        by_partition(batch, [part_col]).write.mode("overwrite").partitionBy(part_col).parquet(path)
        return read()
    touched = [r[0] for r in batch.select(part_col).distinct().collect()]  # at most #partitions values
    current = read().filter(F.col(part_col).isin(touched))
    merged = upsert(current, batch, key, ()).checkpoint(eager=True)
    (by_partition(merged, [part_col]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy(part_col).parquet(path))
    return read()
