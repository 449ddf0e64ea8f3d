"""File-stream ingest: availableNow drains the folder, the checkpoint skips
files already read, the upsert makes a re-run harmless."""

import json
import os
import uuid


def as_json(v):
    """VARIANT (bronze) or JSON text -> Python value."""
    return json.loads(v.toJson() if hasattr(v, "toJson") else v)

from tidewater.sinks import note_month
from tidewater.sources import parse_sectioned_json
from tidewater.streaming import ingest_stream


def write(path, name, keys):
    doc = [[{"Store Number": "ST1"}], [{}], [{"Invoice Data Info 8": k, "Sub Total 1": i} for i, k in enumerate(keys)], [{}]]
    with open(os.path.join(path, name), "w") as f:
        json.dump(doc, f)


def test_stream_ingest_upserts(spark, tmp):
    land = os.path.join(tmp, "land")
    os.makedirs(land)
    table = os.path.join(tmp, "bronze_pos")
    name = f"pos_test_{uuid.uuid4().hex}"
    parse = lambda df: parse_sectioned_json(df, {"ST1": "SITE1"}).select("key", "data", "arrival")
    write(land, "pos_2026-01-01.json", ["a" * 44, "b" * 44])
    ingest_stream(spark, land, parse, table, "key", name, note_month("key"))
    assert spark.read.parquet(table).count() == 2
    write(land, "pos_2026-01-02.json", ["b" * 44, "c" * 44])
    ingest_stream(spark, land, parse, table, "key", name, note_month("key"))
    cur = {r.key: as_json(r.data) for r in spark.read.parquet(table).collect()}
    assert sorted(cur) == ["a" * 44, "b" * 44, "c" * 44]
    assert cur["b" * 44]["Sub Total 1"] == 0 and cur["b" * 44]["source_file"] == "pos_2026-01-02.json"


def test_stream_ingest_partitioned(spark, tmp):
    land = os.path.join(tmp, "land2")
    os.makedirs(land)
    table = os.path.join(tmp, "bronze_pos_p")
    parse = lambda df: parse_sectioned_json(df, {"ST1": "SITE1"}).select("key", "data", "arrival")
    k = lambda ym, n: "23" + ym + str(n).zfill(38)
    write(land, "pos_a.json", [k("2601", 1), k("2602", 2)])
    ingest_stream(spark, land, parse, table, "key", f"pos_p_{uuid.uuid4().hex}", note_month("key"))
    from pyspark.sql import functions as F
    got = spark.read.schema("key string, data string, extracted_at timestamp, part string").parquet(table)
    assert sorted(r.part for r in got.select("part").distinct().collect()) == ["2601", "2602"]
    assert got.count() == 2


def test_lookback_and_backfill_by_file_day(spark, tmp):
    from tidewater.streaming import ingest_days, ingest_lookback
    land = os.path.join(tmp, "land3")
    os.makedirs(land)
    parse = lambda df: parse_sectioned_json(df, {"ST1": "SITE1"}).select("key", "data", "arrival")
    for day, k in (("2026-02-10", "a"), ("2026-02-12", "b"), ("2026-02-13", "c")):
        write(land, f"pos_{day}.json", [k * 44])
    got = ingest_lookback(spark, land, "2026-02-13", 1, parse, os.path.join(tmp, "t_lb"), "key", note_month("key"))
    assert sorted(r.key[0] for r in got.collect()) == ["b", "c"]                 # 12th and 13th only
    got = ingest_days(spark, land, "2026-02-01", "2026-02-10", parse, os.path.join(tmp, "t_bf"), "key", note_month("key"))
    assert [r.key[0] for r in got.collect()] == ["a"]


def test_the_later_day_wins_in_one_batch(spark, tmp):
    from tidewater.streaming import ingest_days
    land, table = os.path.join(tmp, "land4"), os.path.join(tmp, "t_late")
    os.makedirs(land)
    parse = lambda df: parse_sectioned_json(df, {}).select("key", "data", "arrival")
    for day, value in (("2026-03-02", 10.0), ("2026-03-01", 90.0)):          # the older file is written last
        with open(os.path.join(land, f"pos_{day}.json"), "w") as f:
            json.dump([[{"Store Number": "S"}], [{}], [{"Invoice Data Info 8": "k" * 44, "Sub Total 1": value}], [{}]], f)
    (row,) = ingest_days(spark, land, "2026-03-01", "2026-03-05", parse, table, "key", note_month("key")).collect()
    assert as_json(row.data)["Sub Total 1"] == 10.0


def test_backfill_goes_on_after_a_chunk_that_fails(spark, tmp):
    from pyspark.sql import functions as F
    from tidewater.streaming import ingest_chunks, ledger
    land, table, book = (os.path.join(tmp, x) for x in ("land", "bronze", "ledger"))
    os.makedirs(land)

    def parse(df):
        rows = parse_sectioned_json(df, {}).select("key", "data", "arrival")
        poison = F.raise_error(F.lit("no such store"))
        return rows.withColumn("key", F.when(F.try_variant_get("data", "$.hotel", "string") == "BAD", poison).otherwise(F.col("key")))

    def put(day, key, store="OK"):
        with open(f"{land}/pos_{day}.json", "w") as f:
            json.dump([[{"Store Number": store}], [{}], [{"Invoice Data Info 8": key * 44}], [{}]], f)

    run = lambda: ingest_chunks(spark, land, "2026-01-01", "2026-03-05", parse, table, "key", note_month("key"), book, "pos")
    put("2026-01-10", "a"), put("2026-02-10", "b", "BAD"), put("2026-03-03", "c")
    got = run()
    assert [len(got[k]) for k in ("done", "failed", "skipped")] == [2, 1, 0]
    assert sorted(r.key[0] for r in spark.read.parquet(table).collect()) == ["a", "c"]
    (bad,) = ledger(spark, book).where("state = 'failed'").collect()
    assert (str(bad.start), str(bad.end)) == ("2026-01-31", "2026-03-01") and "no such store" in bad.error
    put("2026-02-10", "b")
    put("2026-01-11", "x")                                        # in a chunk that is done: not read again
    got = run()
    assert [len(got[k]) for k in ("done", "failed", "skipped")] == [1, 0, 2]
    assert sorted(r.key[0] for r in spark.read.parquet(table).collect()) == ["a", "b", "c"]
    assert [len(run()[k]) for k in ("done", "failed", "skipped")] == [0, 0, 3]
    assert ledger(spark, book).where("state = 'done' and error is null").count() == 3
