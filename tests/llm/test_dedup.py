"""Operators 3, 8 and 10, links and components, against SQL and brute force."""

import itertools
import random
import re

import duckdb
import numpy as np
import pytest
import xxhash

from tests.llm.conftest import EDGES, SF, same
from tidewater.llm import line_dedup as L
from tidewater.llm import paragraph_dedup as P
from tidewater.llm import simhash as S
from tidewater.llm.components import components
from tidewater.llm.decontamination import words_of
from tidewater.llm.links import spanning_links
from tidewater.llm.queries import ORACLE, QUERIES
from tidewater.testing import compare


def groups_of(pairs, members):
    up = {x: x for x in members}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in pairs:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {x: root(x) for x in members}


# ------------------------------------------------------------------ line dedup

def test_line_dedup_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = QUERIES["op3_line_dedup"](spark, SF)
    assert compare(got, con, ORACLE["op3_line_dedup"]) is None
    assert got.where("n_dropped > 0").count() > 0


def test_line_dedup_generalises_variable_fields(spark):
    rest = "a plain sentence that stands in this document only, number"
    long = "one two three four five six seven eight nine ten eleven twelve thirteen {}"
    rows = [(i, f"Visit {i * 17} of page 99{i}\n{rest} {'abcdefgh'[i]}\n{long.format('xyzuvwst'[i])}") for i in range(5)]
    got = {r["doc_id"]: r["text"].split("\n") for r in L.line_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got[0]) == 3  # the first keeps what recurs
    # digits are variable everywhere, and one part of a long line may differ
    assert all(len(got[i]) == 1 and got[i][0].startswith("a plain") for i in range(1, 5))


NAMES = "Anna Bob Carla Dario Elena Farid Greta Hugo".split()


def kept_of(spark, lines):
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    return [i for i, x in sorted((r["doc_id"], r["text"]) for r in L.line_report(df).collect()) if x]


def test_short_lines_and_two_variable_words_share_a_template(spark):
    assert kept_of(spark, [f"Posted in the section Travel by {x}" for x in NAMES]) == [0]
    long = "all of the readers like {} who came here to see the old town and {} too"
    assert len(long.split()) == 17
    assert kept_of(spark, [long.format(x, y) for x, y in zip(NAMES, NAMES[::-1])]) == [0]
    # fewer documents than a loose template asks for, or too little that is fixed: nothing goes
    assert kept_of(spark, [f"Posted in the section Travel by {x}" for x in NAMES[:5]]) == [0, 1, 2, 3, 4]
    assert kept_of(spark, [f"Written there by {x}" for x in NAMES]) == list(range(8))
    assert kept_of(spark, [f"one two three {x} five {y}" for x, y in zip(NAMES, NAMES[::-1])]) == list(range(8))


def test_loose_templates_match_sql(spark, tmp):
    rng = random.Random(5)
    texts = ["\n".join(" ".join(["so it is", *rng.choices("u v w".split(), weights=[8, 1, 1], k=rng.randrange(0, 18))])
                       for _ in range(5)) for _ in range(60)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp}/loose")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp}/loose/*.parquet'")
    got = L.line_report(spark.read.parquet(f"{tmp}/loose"))
    assert compare(got, con, L.oracle()) is None
    assert got.where("n_dropped > 0").count() > 20


def test_line_dedup_edge_rows(clashing, edges, empty):
    out = L.dedup_lines(clashing, min_docs=2)
    assert out.columns == clashing.columns
    assert same(L.dedup_lines(edges, min_docs=2).collect(), EDGES)  # equal rows count as one document
    three = edges.where("doc_id = 1").withColumn("doc_id", edges["doc_id"] + 1).unionByName(edges)
    kept = {(r["doc_id"], r["text"], r["n_chars"]) for r in L.dedup_lines(three, min_docs=2).collect()}
    assert (2, "", 0) in kept and (1, EDGES[0][1], 40) in kept
    assert L.dedup_lines(empty).count() == 0 and L.line_report(empty).count() == 0


def test_line_dedup_runs_no_python(docs):
    assert not re.search("Python|Pandas|Arrow", L.line_report(docs)._jdf.queryExecution().toString())


# ------------------------------------------------------------------ components and links

@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    pairs = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(40)] + [(7, 7)]
    rng.shuffle(pairs)
    want = groups_of(pairs, {x for p in pairs for x in p})
    assert {r["v"]: r["c"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()} == want


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("block", [4, 1000])
def test_spanning_links_lose_no_connection(spark, block):
    rng = np.random.default_rng(1)
    rows = [(k, int(x)) for k in range(5) for x in rng.choice(400, 30 if k else 90, replace=False)]
    n = {k: sum(1 for a, _ in rows if a == k) for k, _ in rows}
    df = spark.createDataFrame([(k, x, n[k]) for k, x in rows], "k long, x long, n long")
    near = lambda some: (lambda x: lambda i: np.abs(x[i + 1:] - x[i]) <= 3)(some["x"].to_numpy())
    got = [(r["a"], r["b"]) for r in spanning_links(df, len(rows), "k", "x", near, block).collect()]
    want = [(a, b) for (k, a), (j, b) in itertools.combinations(rows, 2) if k == j and abs(a - b) <= 3]
    members = {x for _, x in rows}
    assert groups_of(got, members) == groups_of(want, members)
    assert all(abs(a - b) <= 3 for a, b in got)


# ------------------------------------------------------------------ simhash

def slow_fingerprint(text, size=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(w[i:i + size]) for i in range(len(w) - size + 1)] if len(w) >= size else [" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(fps):
    """fps: (doc_id, fingerprint) -> smallest doc_id that links reach, by row."""
    pairs = [(i, j) for i, j in itertools.combinations(range(len(fps)), 2) if (fps[i][1] ^ fps[j][1]).bit_count() <= 4]
    group, least = groups_of(pairs, range(len(fps))), {}
    for i, g in group.items():
        if fps[i][0] is not None:
            least[g] = min(least.get(g, fps[i][0]), fps[i][0])
    return [(fps[i][0], f"{fps[i][1]:016x}", least.get(group[i])) for i in range(len(fps))]


def test_simhash_matches_brute_force(spark, rows):
    got = QUERIES["op10_simhash"](spark, SF).collect()
    assert same(got, slow_components([(i, slow_fingerprint(x)) for i, x in rows]))


@pytest.mark.parametrize("small", [64, 2])
def test_every_near_fingerprint_links(spark, monkeypatch, small):
    monkeypatch.setattr(S, "SMALL", small)
    rng = random.Random(small)
    fps = {rng.getrandbits(64) for _ in range(150)} | {0, 2 ** 64 - 1}
    for x in list(fps)[:40]:
        for _ in range(6):
            for b in rng.sample(range(64), rng.randrange(1, 7)):
                x ^= 1 << b
            fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(P.signed(x),) for x in fps], "fp long")
    got = [(r["a"] % 2 ** 64, r["b"] % 2 ** 64) for r in S.fingerprint_links(df).collect()]
    want = [(a, b) for a, b in itertools.combinations(fps, 2) if (a ^ b).bit_count() <= 4]
    assert groups_of(got, fps) == groups_of(want, fps)
    assert all((a ^ b).bit_count() <= 4 for a, b in got)


def test_embedding_distance_is_a_lower_bound(spark):
    rng = random.Random(3)
    xs = [rng.getrandbits(64) for _ in range(50)]
    df = spark.createDataFrame([(P.signed(x),) for x in xs], "fp long")
    e = [r[0] % 2 ** 64 for r in df.select(S.embedding(df["fp"])).collect()]
    counts = lambda x: [(x >> 2 * s & 3).bit_count() for s in range(32)]
    for (x, ex), (y, ey) in itertools.combinations(zip(xs, e), 2):
        manhattan = sum(abs(a - b) for a, b in zip(counts(x), counts(y)))
        assert (ex ^ ey).bit_count() == manhattan <= (x ^ y).bit_count()


@pytest.mark.parametrize("n", [1, 10 ** 5, 10 ** 9])
def test_grid_covers_every_distance(n):
    masks, choices = S.grid(n, 4)
    assert sum(masks) == 2 ** 64 - 1
    assert all(len(masks) - len(c) == 4 for c in choices)


def test_simhash_edge_rows(clashing, edges, empty):
    got = S.near_duplicates(clashing).collect()
    assert same(got, slow_components([(r[0], slow_fingerprint(r[1])) for r in EDGES]))
    kept = S.drop_near_duplicates(clashing)
    assert kept.columns == clashing.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "5", "6", "7", "8", "None"]
    assert S.near_duplicates(empty).count() == 0 and S.drop_near_duplicates(empty).count() == 0


# ------------------------------------------------------------------ paragraphs

def slow_removals(rows, min_words=20):
    """(row, line) of the paragraphs that go, by all pairs."""
    places = {}
    for i, (doc_id, text) in enumerate(rows):
        for line, w in P.paragraphs(text, min_words):
            places.setdefault(b" ".join(w), []).append((doc_id is None, doc_id or 0, i, line))
    sets = {p: set(P.shingle_hashes(p.split()).tolist()) for p in places}
    by_shingle = {}
    for p, s in sets.items():
        for x in s:
            by_shingle.setdefault(x, []).append(p)
    pairs = {(a, b) for ps in by_shingle.values() for a, b in itertools.combinations(sorted(ps), 2)}
    near = [(a, b) for a, b in pairs if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    group, classes = groups_of(near, sets), {}
    for p, at in places.items():
        classes.setdefault(group[p], []).extend(at)
    return {at[2:] for c in classes.values() for at in sorted(c)[1:]}


def test_paragraph_dedup_matches_all_pairs(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("length(text) < 6000").limit(400)
    rows = sorted((r["doc_id"], r["text"]) for r in d.collect())
    df = spark.createDataFrame(rows, "doc_id long, text string")
    gone = slow_removals(rows)
    want = {i: "\n".join(x for k, x in enumerate(t.split("\n")) if (n, k) not in gone) for n, (i, t) in enumerate(rows)}
    got = {r["doc_id"]: r for r in P.dedup_passages(df).collect()}
    assert gone and {i: r["text"] for i, r in got.items()} == want
    assert sum(r["n_removed"] for r in got.values()) == len(gone)


def test_near_copies_of_a_passage(spark):
    rng = random.Random(5)
    words = [f"w{rng.randrange(900)}" for _ in range(60)]
    other = lambda n: " ".join(f"u{rng.randrange(10 ** 6)}" for _ in range(n))
    rows = [(i, other(30) + "\n" + " ".join(words[:i % 60] + [f"changed{i}"] * (i > 0) + words[i % 60 + 1:]) + "\n" + other(25))
            for i in range(8)]
    got = P.dedup_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_paragraphs"], r["n_removed"], r["kept_in"]) for r in got} == {
        i: (3, 1, [0]) if i else (3, 0, []) for i in range(8)}


def test_tuned_bands():
    bands, rows = P.tune(0.8)
    assert 1 - (1 - 0.8 ** rows) ** bands >= 0.9995
    assert 1 - (1 - 0.3 ** rows) ** bands <= 0.15


def test_minhash_bands_collide_as_their_formula_says():
    rng = np.random.default_rng(2)
    bands, rows = P.tune(0.8)
    m, hits = P.MinHash(bands, rows), 0
    for _ in range(300):
        both, a, b = (rng.integers(0, 2 ** 63, n, dtype=np.uint64) for n in (80, 10, 10))
        k = m.band_keys([np.concatenate([both, a]), np.concatenate([both, b])])
        hits += bool((k[0] == k[1]).any())
    assert hits >= 298


def test_paragraph_edge_rows(clashing, empty):
    got = P.dedup_passages(clashing).collect()
    want = {(str(r[0]), r[1]) for r in EDGES}
    assert {(str(r["doc_id"]), r["text"]) for r in got} == want and len(got) == len(EDGES)
    assert P.dedup_passages(empty).count() == 0
    assert words_of(None) == []


# ------------------------------------------------------------------ verbatim passages

def test_verbatim_passages_whatever_their_lines(spark):
    rng = random.Random(6)
    passage = [f"w{rng.randrange(900)}" for _ in range(60)]
    other = lambda n: " ".join(f"u{rng.randrange(10 ** 6)}" for _ in range(n))
    wrap = lambda n: "\n".join(" ".join(passage[i:i + n]) for i in range(0, 60, n))
    around = [(other(30), other(30)) for _ in range(5)]
    texts = [wrap(8), wrap(8), wrap(11), " ".join(passage), wrap(8)]
    joins = ["\n", "\n", "\n", " ", " "]  # in lines of their own, and embedded in longer ones
    rows = [(i, f"{a}{j}{t}{j}{b}") for i, ((a, b), t, j) in enumerate(zip(around, texts, joins))]
    got = {r["doc_id"]: r for r in P.dedup_text(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0]["text"] == rows[0][1] and got[0]["n_removed"] == 0
    for i in range(1, 5):
        assert got[i]["text"] == f"{around[i][0]}{joins[i]}{around[i][1]}"
        assert (got[i]["n_removed"], got[i]["kept_in"]) == (1, [0])


def test_no_window_stands_in_two_documents(spark):
    left = {}
    for r in QUERIES["op8_substring_dedup"](spark, "/root/testdata/sf0.01").collect():
        w = words_of(r["text"])
        for i in range(len(w) - 49):
            left.setdefault(b" ".join(w[i:i + 50]), set()).add(r["doc_id"])
    assert left and not [x for x, ids in left.items() if len(ids) > 1]


def test_verbatim_edge_rows(clashing, empty):
    got = P.dedup_text(clashing).collect()
    want = {(str(r[0]), r[1]) for r in EDGES}
    assert {(str(r["doc_id"]), r["text"]) for r in got} == want and len(got) == len(EDGES)
    assert P.dedup_text(empty).count() == 0
