"""Arrays that are read in splits give the rows that a parse of the whole file gives."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tidewater.sources import (
    landed, parse_json_array, parse_nested_array_json, parse_sectioned_json, scan_arrays, scan_json_array, scan_nested_array_json,
    scan_sectioned_json,
)
from tidewater.sources.arrays import Summary, cut

NASTY = ['"', "\\", "}", "{", "[", "]", '"}', '{"a": [', "],[", "\\\"", "é", "日本", "\n", "}{", "\t", "x" * 40, '\\"}', "WARC"]


@pytest.fixture()
def splits(spark):
    """Splits of 3,000 bytes and groups of some 150, so that nearly all records cross a border."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield 150
    for k, v in before.items():
        spark.conf.set(k, v)


def value(rnd, depth=0):
    kind = rnd.random()
    if kind < 0.5 or depth > 2:
        return "".join(rnd.choice(NASTY) for _ in range(rnd.randint(0, 6)))
    if kind < 0.65:
        return rnd.choice([None, True, 1.5, -3, 10 ** 12])
    if kind < 0.8:
        return [value(rnd, depth + 1) for _ in range(rnd.randint(0, 3))]
    return {rnd.choice("abcde") + rnd.choice(NASTY): value(rnd, depth + 1) for _ in range(rnd.randint(0, 3))}


def record(rnd, **fields):
    r = {f"k{i}": value(rnd) for i in range(rnd.randint(0, 4))} | fields
    items = list(r.items())
    rnd.shuffle(items)
    return dict(items)


def write(folder, name, data, rnd):
    os.makedirs(folder, exist_ok=True)
    text = data if isinstance(data, str) else json.dumps(data, ensure_ascii=rnd.random() < 0.5, indent=rnd.choice([None, None, 1]))
    with open(f"{folder}/{name}", "w", encoding="utf-8") as f:
        f.write(rnd.choice(["", "\n", " "]) + text + rnd.choice(["", "\n"]))


def rows(df, *cols):
    out = []
    for r in df.collect():
        data = r["data"].toJson() if r["data"] is not None else None
        out.append(tuple(r[c] for c in cols) + (json.dumps(json.loads(data), sort_keys=True) if data else None,))
    return sorted(out, key=str)


def in_order(df):
    """Keys per file in the order of arrival."""
    got = df.where("key is not null").orderBy("arrival").select("file_name", "key").collect()
    by = {}
    for r in got:
        by.setdefault(r.file_name, []).append(r.key)
    return by


@pytest.mark.parametrize("seed", [1])
def test_flat_arrays(spark, splits, tmp, seed):
    rnd = random.Random(seed)
    for i in range(4):
        data = [record(rnd, IDLANCAMENTOICMSBASE=i * 1000 + j) if rnd.random() < 0.8 else rnd.choice(["noise}", 7, None, [1, {"x": 2}]]) for j in range(40)]
        write(tmp, f"l{i}_2026-03-0{i + 1}.json", data, rnd)
    for name, data in (("empty", []), ("none", [1, "}"]), ("object", {"a": [1]}), ("cut", '[{"a": 1}, {"b": "x'), ("string", '[{"a": 1}, {"b": "x]'),
                       ("bad", '[{"a": 1}, {"b": nope}]'), ("nokey", [{"a": 1}])):
        write(tmp, f"{name}.json", data, rnd)
    whole, parts = parse_json_array(landed(spark, tmp), errors=True), scan_json_array(spark, tmp, errors=True, group_bytes=splits)
    cols = ("key", "file_name")
    one = lambda df: rows(df.where("error is null and data is not null"), *cols)
    assert one(parts) == one(whole) and len(one(parts)) > 100
    errors = lambda df: sorted({(r.file_name, r.error) for r in df.where("error is not null").collect()})
    assert errors(parts) == errors(whole) == [("bad.json", "not JSON"), ("cut.json", "not JSON"), ("object.json", "no array at $"),
                                              ("string.json", "not JSON")]
    assert {r.file_name for r in parts.select("file_name").collect()} == set(os.listdir(tmp))
    assert in_order(parts) == in_order(whole)
    assert one(scan_json_array(spark, tmp, group_bytes=splits).withColumn("error", F.lit(None))) == one(whole)


@pytest.mark.parametrize("seed", [3])
def test_sectioned_and_nested_arrays(spark, splits, tmp, seed):
    rnd = random.Random(seed)
    for i in range(3):
        recs = [record(rnd, **{"Invoice Data Info 8": rnd.choice([f" n{i}-{j} ", "  ", f"m{j}"])}) if rnd.random() < 0.8 else "junk" for j in range(30)]
        write(f"{tmp}/pos", f"p{i}.json", [[{"Store Number": f"S{i}", "x": '"}]['}], [{}], recs, [{"Invoice Data Info 8": "not here"}]], rnd)
        items = [record(rnd, guestCheckLineItemID=rnd.choice([0, j + 1, "", None]), locationRef=rnd.choice(["L", "M"])) for j in range(30)]
        write(f"{tmp}/items", f"i{i}.json", [items, [{"guestCheckLineItemID": 99}]], rnd)
    write(f"{tmp}/pos", "short.json", [[{"Store Number": "S"}]], rnd)
    write(f"{tmp}/pos", "nohead.json", [[], [{}], [{"Invoice Data Info 8": "h"}]], rnd)
    write(f"{tmp}/pos", "cut.json", '[[{"Store Number": "S"}],[{}],[{"Invoice Data Info 8": "lost"}', rnd)
    codes = {"S1": "SITE1", "L": "SITE2"}
    a = parse_sectioned_json(landed(spark, f"{tmp}/pos"), codes)
    b = scan_sectioned_json(spark, f"{tmp}/pos", codes, group_bytes=splits)
    cols = ("key", "hotel", "source_file")
    assert rows(b, *cols) == rows(a, *cols) and len(rows(b, *cols)) > 40
    bad = scan_sectioned_json(spark, f"{tmp}/pos", codes, errors=True, group_bytes=splits).where("error is not null").collect()
    assert [(r.file_name, r.error) for r in bad] == [("cut.json", "not JSON")]
    a = parse_nested_array_json(landed(spark, f"{tmp}/items"), codes)
    b = scan_nested_array_json(spark, f"{tmp}/items", codes, group_bytes=splits)
    assert rows(b, *cols) == rows(a, *cols) and len(rows(b, *cols)) > 10


def test_a_second_value_is_an_error(spark, tmp):
    """Spark's own parse ignores what follows the first value."""
    write(tmp, "two.json", '[{"a": 1}] [{"b": 2}]', random.Random(1))
    assert [(r.error, r.data) for r in scan_json_array(spark, tmp, errors=True).collect()] == [("not JSON", None)]


def test_one_file_is_read_by_many_tasks(spark, splits, tmp):
    rnd = random.Random(9)
    write(tmp, "big.json", [record(rnd, IDLANCAMENTOICMSBASE=j, text="x" * 300) for j in range(200)], rnd)
    from tidewater.sources.arrays import grouped
    assert grouped(spark, tmp).rdd.getNumPartitions() > 20
    records, files = scan_arrays(spark, tmp, 1, group_bytes=splits)
    assert records.count() == 200 and files.select("error").collect()[0].error is None


def test_summaries_hold_for_both_cases():
    """A text cut anywhere after a brace: state before a part + its summary = state after it."""
    rnd = random.Random(5)
    for _ in range(30):
        text = json.dumps([record(rnd) for _ in range(6)], ensure_ascii=False).encode()
        cuts = sorted(rnd.sample([i for i, c in enumerate(text) if c == ord("}")], 3))
        parts = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]
        inside = level = 0
        off, last, found = 0, None, {}
        for part in parts:
            s = Summary()
            s.add(part, 0)
            for section, at, piece, whole, data in cut(part, off, inside, level, 0, last, 1):
                found.setdefault(at, []).append(data)
            opened = s.opened[inside].get(1 - level)
            last = off + opened[2] if opened else last
            level += s.depth[inside]
            inside = (inside + s.quotes) % 2
            off += len(part)
        assert (inside, level) == (0, 0)
        assert [json.loads(b"".join(x)) for x in found.values()] == json.loads(text)
