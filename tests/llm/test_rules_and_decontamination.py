"""Operators 1 and 2 against brute force."""

import hashlib
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from tests.llm.conftest import EDGES, SF
from tidewater.llm import decontamination as D
from tidewater.llm import quality_rules as Q
from tidewater.llm.queries import ORACLE, QUERIES
from tidewater.testing import compare


def base(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    n = Counter(windows)
    inside = {i + k for i, x in enumerate(windows) if n[x] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside),
            len(w) < 10 or 100 * len(inside) > 20 * len(w))


COLS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_base_columns(spark, rows):
    got = QUERIES["op1_quality_rules"](spark, SF).collect()
    assert len(got) == len(rows)
    assert {r["doc_id"]: tuple(r[c] for c in COLS) for r in got} == {i: base(x) for i, x in rows}
    assert not any(r["kept"] and r["base_failed"] for r in got)


def test_rules_agree_with_labels(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = Q.quality(d).join(labels, "doc_id").select("kept", "base_failed", "quality").collect()
    assert not [r for r in got if r["kept"] and r["quality"] == 0]
    good = [r for r in got if r["quality"] == 1 and not r["base_failed"]]
    assert np.mean([r["kept"] for r in good]) > 0.98


def test_em_is_the_textbook_one(spark):
    rng = np.random.default_rng(0)
    y = rng.random(400) < 0.8
    v = np.array([[rng.choice([-1, 0, 1], p=[.02, .2, .78] if g else [.6, .2, .2]) for _ in range(4)] for g in y])
    df = spark.createDataFrame([tuple(map(int, r)) for r in v], ", ".join(f"v_r{j} int" for j in range(4)))
    prior, good, bad = Q.estimate(df, [f"r{j}" for j in range(4)], rounds=6)
    p0, g, b = 0.8, np.array([Q.START_GOOD] * 4), np.array([Q.START_BAD] * 4)
    for _ in range(6):
        score = np.log(p0 / (1 - p0)) + sum(np.log(g[j, v[:, j] + 1] / b[j, v[:, j] + 1]) for j in range(4))
        p = 1 / (1 + np.exp(-score))
        g, b = (np.array([[max(Q.FLOOR, (w[v[:, j] == k].sum() + 1) / (w.sum() + 3)) for k in (-1, 0, 1)] for j in range(4)])
                for w in (p, 1 - p))
        p0 = min(.95, max(.05, p.mean()))
    assert prior == pytest.approx(p0) and np.allclose(good, g) and np.allclose(bad, b)
    assert ((p > .5) == y).mean() > 0.95


def test_rules_edge_rows(clashing, empty):
    got = Q.quality(clashing).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_repeat_words"]) for r in got) == sorted(
        (str(r[0]), base(r[1])[0], base(r[1])[4]) for r in EDGES)
    assert Q.quality(empty).count() == 0


def test_rules_run_no_python(spark):
    plan = Q.voted(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# ------------------------------------------------------------------ decontamination

def brute(text, items, window=13):
    w = D.words_of(text)
    hit, found = set(), set()
    for item, p in items:
        b = D.words_of(p)
        m = min(window, len(b))
        shapes = {tuple(b[i:i + m]) for i in range(len(b) - m + 1)} if m else set()
        for i in range(len(w) - m + 1 if m else 0):
            if tuple(w[i:i + m]) in shapes:
                hit |= set(range(i, i + m))
                found.add(item)
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), \
        len(hit) > 0 and 20 * len(hit) >= len(w)


def test_words():
    assert D.words_of("Ab1-É_x [ü] {z}\x7f") == ["ab1".encode(), "É".encode(), b"x", "ü".encode(), b"z"]
    assert D.words_of(None) == []


def test_decontamination_matches_brute_force_and_sql(spark, rows):
    items = [(str(r[0]), r[1]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    got = QUERIES["op2_decontamination"](spark, SF)
    assert {r["doc_id"]: tuple(r[c] for c in got.columns[1:]) for r in got.collect()} == {i: brute(x, items) for i, x in rows}
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    assert compare(got, con, ORACLE["op2_decontamination"]) is None


@pytest.mark.parametrize("block_mb", [16, 0.0001])
def test_overlapping_short_and_repeated_patterns(spark, block_mb):
    items = [("10", "a b a b a b a b a b a b a b a b"), ("9", "one two"), ("9", "three"), ("2", "!"), ("x", None), ("7", "a b a"),
             ("11", " ".join(f"w{i}" for i in range(30))), (None, "null id")]
    texts = ["a b " * 20 + "one two three", "three", "w0 w1 " + " ".join(f"w{i}" for i in range(2, 20)) + " end", "null id a b a",
             None, "", "one three two", "x " * 500 + "one two", "A. B; A!"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id string, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"])
           for r in D.contamination(docs, bench, block_mb=block_mb).collect()}
    known = [(i or "", t) for i, t in items if t]
    assert got == {i: (b := brute(t, known))[:3] + b[4:] for i, t in enumerate(texts)}


def test_decontamination_edge_rows(spark, clashing, edges, empty):
    bench = spark.createDataFrame([("a", "same line of text"), ("b", "word word word")], "item_id string, text string")
    got = D.contamination(clashing, bench).collect()
    assert sorted((str(r["doc_id"]), r["n_hit"]) for r in got) == sorted(
        (str(r[0]), brute(r[1], [("a", "same line of text"), ("b", "word word word")])[1]) for r in EDGES)
    assert D.decontaminate(clashing, bench).columns == clashing.columns
    assert D.decontaminate(edges, bench).count() == len(EDGES) - 3
    assert D.contamination(empty, bench).count() == 0
    assert D.contamination(edges, bench.where("item_id = 'none'")).where("n_hit > 0").count() == 0


def test_repeated_benchmark_rows_share_a_block(spark):
    from tidewater.llm.decontamination import benchmark_blocks
    rows = [("same", "word " * 300)] * 6 + [(f"item{i}", f"text {i} " * 100) for i in range(4)]
    bench = spark.createDataFrame(rows, "item_id string, text string")
    blocks = list(benchmark_blocks(bench, "item_id", "text", 0.001))
    assert sorted(x for b in blocks for x in b) == sorted(set(rows))
