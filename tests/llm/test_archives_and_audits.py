"""Operators 11 to 13: WARC archives, Merkle manifests, filter audits."""

import base64
import glob
import hashlib
import random
import zlib
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SCHEMA, same
from tidewater.llm import filter_audit, merkle, warc

PAGES = "page_id long, url string, html string"
#: What makes a reader of records stumble: the format's own marks and whole records within payloads.
FRAGMENTS = ["\r\n", "\r\n\r\n", "\r", "\n", "WARC/1.", "WARC/1.1\r\n", "WWARC/1.", "WAR", "\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\nhello",
             "\r\n\r\nWARC/1.1\r\nContent-Length: 40000\r\n\r\n", "\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nPage-Id: 999\r\nContent-Length: 0\r\n\r\n",
             "\r\n\r\nWARC/1.1\r\n\r\n", "é日本", "x", "x" * 100, "x" * 1000]
URLS = ["http://a/b", "http://x/WARC/1.1/spec", "http://WARC/1.0\r\nContent-Length: 4", None, ""]


@pytest.fixture()
def splits(spark):
    """Splits of 20,000 bytes, so that many records cross a border."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def hostile(seed, n=80):
    rnd, rows = random.Random(seed), []
    for i in range(n):
        body = "".join(rnd.choice(FRAGMENTS) for _ in range(rnd.randint(0, 25)))
        body = body * 20 if i % 30 == 0 else rows[rnd.randrange(len(rows))][2] if i % 6 == 5 else body
        rows.append((i, rnd.choice(URLS), body))
    return [*rows, (None, None, None), (1000, "u", None), (1001, "u", "")]


def expected(rows, least=0):
    out, ids = [], {}
    for i, _, html in rows:
        ids.setdefault(html or "", []).append(i)
    for i, _, html in rows:
        data = (html or "").encode()
        top = max((x for x in ids[html or ""] if x is not None), default=None)
        full = i == top or len(data) < least
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if full else "revisit", None if full else top))
    return out


@pytest.mark.parametrize("payload", [False, True])
def test_warc_round_trip_across_splits(spark, splits, tmp, payload):
    rows = hostile(3)
    warc.write(spark.createDataFrame(rows, PAGES).coalesce(2), f"{tmp}/a")
    got = warc.records(spark, f"{tmp}/a", payload=payload).cache()
    assert same(warc.pages(got).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect(), expected(rows))
    if payload:
        text = {i: (html or "").encode() for i, _, html in rows}
        full = got.where(warc.field("WARC-Type") == "response").select(warc.field("Page-Id").cast("long").alias("id"), "payload").collect()
        assert full and all(bytes(r["payload"]) == text[r["id"]] for r in full)
    else:
        assert got.where("payload is not null").count() == 0
    got.unpersist()


def read_one_by_one(path):
    """(offset, length) of the records of a file, from its start."""
    data, at, out = open(path, "rb").read(), 0, []
    while at < len(data):
        end = data.index(b"\r\n\r\n", at) + 4
        n = end - at + warc.length_in(data[at:end].decode()) + 4
        out.append((at, n))
        at += n
    return out


def test_warc_records_are_those_read_one_by_one(spark, splits, tmp):
    warc.write(spark.createDataFrame(hostile(5), PAGES).coalesce(2), f"{tmp}/a")
    got = warc.records(spark, f"{tmp}/a", payload=False).select(F.element_at(F.split("file", "/"), -1), "off", "length").collect()
    files = glob.glob(f"{tmp}/a/part-*")
    assert same(got, [(f.rsplit("/", 1)[1], a, n) for f in files for a, n in read_one_by_one(f)])
    candidates = warc.placed(warc.pieces(spark, f"{tmp}/a", False)).where("next is not null").count()
    assert candidates > len(got)  # the payloads do hold what looks like records


def test_warc_small_payloads_are_no_revisits(spark, tmp):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")]
    warc.write(spark.createDataFrame(rows, PAGES), f"{tmp}/a", min_revisit_bytes=3)
    assert same(warc.pages(warc.records(spark, f"{tmp}/a")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect(),
                expected(rows, 3))


def test_warc_damage_is_reported(spark, splits, tmp):
    warc.write(spark.createDataFrame(hostile(7), PAGES).coalesce(1), f"{tmp}/a")
    path = glob.glob(f"{tmp}/a/part-*")[0]
    whole, data = read_one_by_one(path), open(path, "rb").read()
    at, n = whole[len(whole) // 2]
    glob_crc = glob.glob(f"{tmp}/a/.part-*.crc")
    with open(path, "wb") as f:  # a record loses its last 30 bytes
        f.write(data[:at + n - 30] + data[at + n:])
    for crc in glob_crc:
        open(crc, "wb").close()
    spark.conf.set("spark.sql.files.ignoreCorruptFiles", "false")
    import os
    import shutil
    os.makedirs(f"{tmp}/b")
    shutil.copy(path, f"{tmp}/b/one.warc")
    with pytest.raises(warc.Damaged):
        warc.records(spark, f"{tmp}/b")
    archive = warc.Archive(spark, f"{tmp}/b", False)
    broken = archive.damage.collect()
    assert len(broken) == 1 and broken[0]["off"] >= at
    kept = {(r["off"], r["length"]) for r in archive.records.collect()}
    assert {x for x in whole if x[0] < at} <= kept


def test_warc_defined_cases(spark, edges, clashing, empty, tmp):
    kinds = {"id_col": "doc_id", "url_col": "source", "payload_col": "text"}
    for k, df in enumerate((edges, clashing)):
        warc.write(df, f"{tmp}/{k}", **kinds)
        got = warc.pages(warc.records(spark, f"{tmp}/{k}", payload=False)).collect()
        rows = [(r["doc_id"], None, r["text"]) for r in edges.collect()]
        assert same(got, [(a, b, c, d, e) for a, b, c, d, e in expected(rows)])
    warc.write(empty, f"{tmp}/none", **kinds)
    assert warc.pages(warc.records(spark, f"{tmp}/none")).count() == 0


def h(x):
    return hashlib.sha256(x.encode()).hexdigest()


def tree(nodes):
    """(root, per leaf the siblings level by level as (before, after))."""
    paths, level, at = [[] for _ in nodes], list(nodes), list(range(len(nodes)))
    while len(level) > 1:
        for leaf, i in enumerate(at):
            run = i // 3 * 3
            paths[leaf].append(("".join(level[run:i]), "".join(level[i + 1:run + 3])))
        level, at = [h("".join(level[i:i + 3])) for i in range(0, len(level), 3)], [i // 3 for i in at]
    return level[0], paths


def brute_manifest(rows):
    """Sorted result rows of op12 over (doc_id, text, lang, source, n_chars)."""
    def leaf(doc_id, text, lang, source, n):
        return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n, text)))

    sources = sorted({r[3] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    groups = {s: sorted((r for r in rows if r[3] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r))) for s in sources}
    trees = {s: tree([leaf(*r) for r in g]) for s, g in groups.items()}
    root, above = tree([trees[s][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for r, path in zip(groups[s], trees[s][1]):
            path = path + above[k]
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[1] is not None
            node = leaf(r[0], r[1].replace("\n", "") if hit else r[1], *r[2:])
            for a, b in path:
                node = h(a + node + b)
            out.append((r[0], leaf(*r), trees[s][0], root, h("".join(a + b for a, b in path)), node, node == root))
    return out


def op12(df, **kinds):
    hit = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 2 == 0
    return merkle.audit(df, F.when(hit, F.translate("text", "\n", "")).otherwise(F.col("text")), **kinds)


@pytest.mark.parametrize("levels", [1, 2, merkle.LEVELS])
def test_manifest_is_that_of_the_whole_tree(spark, levels):
    sizes = {"a": 1, "b": 2, "c": 3, "d": 4, "e": 9, "f": 10, "g": 28, None: 82, "": 5, "é": 27}
    rows = [(k * 1000 + i * 7 % 83, f"line {i % 5}\nend", "en", s, i) for k, (s, n) in enumerate(sizes.items()) for i in range(n)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = op12(df, levels=levels).collect()
    assert same(got, brute_manifest(rows))
    assert {r["verified"] for r in got} == {True, False}


def test_append_extends_witnesses_as_siblings_complete():
    for n in (1, 2, 3, 4, 9, 10, 26, 27):
        leaves = [h(str(i)) for i in range(n)]
        root, found = merkle.append(iter(leaves), merkle.height(n))
        want, paths = tree(leaves)
        assert root == want
        assert [[tuple(x.split(merkle.HOLE)) for x in w] for w in found] == paths


def test_manifest_defined_cases(spark, edges, clashing, empty):
    rows = [tuple(r) for r in edges.collect()]
    assert same(op12(edges).collect(), brute_manifest(rows))
    assert same(op12(clashing).collect(), brute_manifest(rows))
    assert op12(empty).collect() == []


def brute_audit(docs, labels):
    def fails(text):
        words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text) if w]
        upper = sum("A" <= c <= "Z" for c in text)
        return {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * upper > 10 * len(text),
                "D": any(c in "#$%&*|" for c in text)}

    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    rows = [(part or "", {**fails(text or ""), "E": i is not None and i > least[text or ""]},
             any(q == 1 for j, q, _ in labels if j == i and i is not None), any(t == 1 for j, _, t in labels if j == i and i is not None))
            for i, text, part in docs]
    out = []
    for part in {r[0] for r in rows}:
        mine, sums = [r for r in rows if r[0] == part], dict.fromkeys("ABCDE", 0)
        got = []
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [r for r in left if r[1][f]]
                left = [r for r in left if not r[1][f]]
                sums[f] += len(gone)
                got.append(("".join(order), step, len(left), len(gone), sum(r[1][f] for r in mine) - len(gone),
                            sum(r[1][f] and sum(r[1].values()) == 1 for r in mine), sum(r[2] for r in gone), sum(r[3] for r in gone)))
        out += [(part, *r, sums[r[0][r[1] - 1]]) for r in got]
    return out


def test_audit_is_what_running_every_order_gives(spark, docs):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()]
    marks = [(r["doc_id"], r["quality"], r["toxic"]) for r in labels.collect()]
    assert same(filter_audit.audit(docs, labels).collect(), brute_audit(rows, marks))


def test_audit_defined_cases(spark, edges, clashing, empty):
    marks = [(1, 1, 0), (1, 0, 1), (5, 1, 1), (None, 1, 1), (6, None, None), (99, 1, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in edges.collect()]
    want = brute_audit(rows, marks)
    assert same(filter_audit.audit(edges, labels).collect(), want)
    assert same(filter_audit.audit(clashing, labels.withColumn("text", F.lit("x"))).collect(), want)
    assert filter_audit.audit(empty, labels).collect() == []
    assert len(filter_audit.audit(edges, labels.where("doc_id = -1")).collect()) == len(want)


def test_shapley_by_potential_is_the_mean_over_orders():
    rnd = random.Random(4)
    for _ in range(20):
        count = [rnd.randint(0, 9) for _ in range(32)]
        worth = [sum(n for mask, n in enumerate(count) if mask & s) for s in range(32)]
        sums = [0] * 5
        for order in permutations(range(5)):
            s = 0
            for i in order:
                sums[i] += worth[s | 1 << i] - worth[s]
                s |= 1 << i
        assert filter_audit.shapley_sums(worth) == sums
