"""The queries of the training-data operators, and their DuckDB SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import (bpe, crf, decontamination, filter_audit, langid, line_dedup, merkle, paragraph_dedup, quality_rules, rans,
                           sharding, simhash, warc)
from tidewater.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def vocabulary_file(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good")


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.encode(F.array_join("items", ","), "UTF-8"), 256).alias("items_sha256"), "contaminated")


ORACLE["op2_decontamination"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
p AS (SELECT DISTINCT item_id, least(13, len(w)) AS m, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS s
      FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
x AS (SELECT r, m, i, array_to_string(w[i:i + m - 1], ' ') AS s
      FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM p) WHERE len(w) >= m)),
hit AS (SELECT r, x.i, x.m, p.item_id FROM x JOIN p ON x.s = p.s AND x.m = p.m),
words AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + m)) AS k FROM hit) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT r, item_id::varchar AS item FROM hit) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)"""


@query
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


ORACLE["op3_line_dedup"] = line_dedup.oracle()


@query
def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode(table(spark, sf_dir, "documents"), vocabulary_file("word_bpe_49k.json"))
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


@query
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return crf.scores(docs, crf.train(docs, table(spark, sf_dir, "labels")))


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents"), vocabulary_file("piece_bpe_32k.model")
    return langid.identify(docs, langid.train(langid.labelled_rows(docs), path), path)


@query
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = sharding.regular_tree(regions=3, racks=2, shards=4)
    return sharding.shard(table(spark, sf_dir, "documents"), tree, sharding.with_new_region(tree, 24))


@query
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraph_dedup.dedup_text(table(spark, sf_dir, "documents"))


@query
def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = rans.token_folder(table(spark, sf_dir, "documents"), vocabulary_file("word_bpe_49k.json"), end_id=2)
    return rans.read(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.archive_folder(table(spark, sf_dir, "pages"))
    return warc.pages(warc.records(spark, folder, payload=False))


ORACLE["op11_warc"] = """
WITH d AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS x FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY x) AS top FROM d)
SELECT page_id, n AS payload_bytes, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + ((('0x' || substr(x, 1 + 10 * (i // 8)::int, 10))::bigint >> (35 - 5 * (i % 8))) & 31), 1)), '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM g"""


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    hit = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 2 == 0
    return merkle.audit(docs, F.when(hit, F.translate("text", "\n", "")).otherwise(F.col("text")))


ORACLE["op12_merkle_manifest"] = merkle.oracle()


@query
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE["op13_filter_audit"] = filter_audit.oracle()
