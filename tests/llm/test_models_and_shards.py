"""Operators 5, 6 and 7."""

import itertools
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import EDGES, SF
from tidewater.llm import crf, langid, sharding
from tidewater.llm.queries import QUERIES, vocabulary_file

BIG = "/root/testdata/sf0.01"


# ------------------------------------------------------------------ CRF

def test_marginals_by_enumeration():
    rng = np.random.default_rng(0)
    docs = [rng.integers(0, crf.BINS, (n, crf.K)).astype(np.int8) for n in (3, 1, 5, 2)]
    w, pairs = rng.normal(0, .3, 3 * crf.K * crf.BINS), rng.normal(0, 1, (2, 2))
    chains = crf.Chains(docs)
    p, both, logz = chains.marginals(w, pairs)
    unary = np.append(w, 0)[chains.features].sum(axis=1)
    total, want_both = 0.0, np.zeros((2, 2))
    for k, n in enumerate(chains.sizes):
        u = unary[chains.start[k]:chains.start[k] + n]
        paths = list(itertools.product((0, 1), repeat=int(n)))
        weight = np.exp([sum(u[t] * y[t] for t in range(n)) + sum(pairs[a, b] for a, b in zip(y, y[1:])) for y in paths])
        total += np.log(weight.sum())
        weight /= weight.sum()
        for t in range(n):
            assert p[chains.start[k] + t] == pytest.approx(sum(x for x, y in zip(weight, paths) if y[t]))
        for x, y in zip(weight, paths):
            for a, b in zip(y, y[1:]):
                want_both[a, b] += x
    assert logz == pytest.approx(total) and np.allclose(both, want_both)


def test_neighbours_are_features():
    a, b = (np.full((1, crf.K), x, dtype=np.int8) for x in (1, 2))
    f = crf.Chains([np.vstack([a, b, a])]).features
    assert (f[0, crf.K:2 * crf.K] == -1).all() and (f[2, 2 * crf.K:] == -1).all()
    assert (f[1, crf.K:2 * crf.K] == np.arange(crf.K) * crf.BINS + 1 + crf.K * crf.BINS).all()


def test_classifier_on_held_out_labels(spark):
    got = QUERIES["op5_quality_classifier"](spark, BIG).collect()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{BIG}/labels.parquet").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    held = [(r["predicted"], labels[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in labels]
    assert len(held) > 50 and np.mean([a == b for a, b in held]) > 0.97


def test_classifier_edge_rows(spark, clashing, empty):
    labels = spark.createDataFrame([(1, 1), (5, 0), (8, 0), (None, 1), (7, None), (1, 0)], "doc_id long, quality int")
    got = crf.scores(clashing, crf.train(clashing, labels)).collect()
    assert len(got) == len(EDGES) and all(r["score"] is not None for r in got)
    none = crf.train(empty, labels)
    assert {r["score"] for r in crf.scores(clashing, none).collect()} == {0.5}
    assert crf.scores(empty, none).count() == 0


def test_training_rows_and_lines_are_bounded(spark, monkeypatch):
    read = []
    monkeypatch.setattr(crf.Model, "fit", lambda self, bins, lengths, labels: read.append([len(b) for b in bins]) or self)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5]
    one = [(ids[0], "a text with some words in it")] * 5000
    few = spark.createDataFrame(one, "doc_id long, text string")
    crf.train(few, labels.where(f"doc_id = {ids[0]}"), max_docs=10)  # equal rows
    many = spark.createDataFrame([(ids[0], f"text number {i}") for i in range(3000)], "doc_id long, text string")
    crf.train(many, labels.where(f"doc_id = {ids[0]}"), max_docs=10)  # an id of many texts
    long = spark.createDataFrame([(i, "a line\n" * (9 if k else 5000)) for k, i in enumerate(ids)], "doc_id long, text string")
    crf.train(long, labels, max_docs=1000)
    assert len(read[0]) == 1 and len(read[1]) < 30 and len(read[2]) == len(ids) - 1 and max(read[2]) < 20


# ------------------------------------------------------------------ language ID

def test_forward_sums_all_segmentations():
    v = langid.Vocabulary([langid.START, "a", "b", "ab", "ba", langid.START + "a", "aba"])
    rng = np.random.default_rng(0)
    chances = langid.normalised(rng.random((len(v.pieces) + 1, 2)))
    index = {p: i for i, p in enumerate(v.pieces)}

    def slow(word, lang):
        if not word:
            return 1.0
        out = 0.0
        for n in range(1, len(word) + 1):
            i = index.get(word[:n], v.unknown if n == 1 else None)
            if i is not None:
                out += chances[i, lang] * slow(word[n:], lang)
        return out
    words = ["a", "abab", "bcab", "c", "ababa"]
    got = langid.word_scores(v, chances, words)
    assert np.allclose(np.exp(got), [[slow(langid.START + w, k) for k in (0, 1)] for w in words])
    # expected counts: each word's pieces cover its characters exactly
    counts = langid.expected_counts(v, chances, ["abab"], np.array([[1.0, 3.0]]))
    sizes = np.array([len(p) for p in v.pieces] + [1])
    assert np.allclose((counts * sizes[:, None]).sum(axis=0), [5, 15])


def test_long_words_do_not_underflow():
    v = langid.Vocabulary([langid.START, "a"])
    chances = langid.normalised(np.ones((3, 2)))
    assert np.isfinite(langid.word_scores(v, chances, ["a" * 40_000, "ж" * 1000])).all()


def uncut(v, chances, word):
    """Log of the forward sum over a whole word, in log space."""
    index, logs = {p: i for i, p in enumerate(v.pieces)}, np.log(chances[:-1])
    a = [np.zeros(chances.shape[1])]
    for i in range(1, len(word) + 1):
        terms = []
        for size in range(1, min(v.longest, i) + 1):
            k = index.get(word[i - size:i], v.unknown if size == 1 else None)
            if k is not None:
                terms.append(a[i - size] + logs[k])
        a.append(np.logaddexp.reduce(terms))
    return a[-1]


@pytest.mark.parametrize("size", [31, 32, 40, 63, 64, 65, 80, 500, 5000])
def test_scores_of_long_runs_are_uncut(size):
    rng = np.random.default_rng(size)
    v = langid.Vocabulary([langid.START, "a", "b", "ab", "ba", "aba", "abbabbabbabbabbabbab", langid.START + "a", "日本", "本"])
    chances = langid.normalised(rng.random((len(v.pieces) + 1, 3)) ** 6)
    words = ["".join(rng.choice(list("ab日本x"), size - d)) for d in (0, 1, 7)] + ["abb" * (size // 3), "a"]
    assert np.allclose(langid.word_scores(v, chances, words), [uncut(v, chances, langid.START + w) for w in words], rtol=1e-9)


def test_expected_counts_of_long_runs(monkeypatch):
    rng = np.random.default_rng(1)
    v = langid.Vocabulary([langid.START, "a", "b", "ab", "ba", "aba"])
    chances = langid.normalised(rng.random((len(v.pieces) + 1, 2)))
    word = "".join(rng.choice(list("abx"), 700))
    got = langid.expected_counts(v, chances, [word, "ab"], np.array([[1.0, 0.0], [0.0, 2.0]]))
    sizes = np.array([len(p) for p in v.pieces] + [1])
    assert np.allclose((got * sizes[:, None]).sum(axis=0), [701, 6])
    # the gradient of the log score with respect to the log chance of a piece is its expected count
    for k in range(len(v.pieces) + 1):
        more = chances.copy()
        more[k] *= np.exp(1e-5)
        slope = (uncut(v, more, langid.START + word) - uncut(v, chances, langid.START + word))[0] / 1e-5
        assert abs(slope - got[k, 0]) < 1e-2


def test_words_follow_current_letters():
    import re
    import sys
    import unicodedata
    old = re.compile(r"[^\W\d_]+")
    known = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c) not in ("Cn", "Cs"))
    assert langid.WORDS.findall(known) == old.findall(known)
    assert langid.words("\u1c89\ua7cb")


def test_language_on_held_out_rows(spark):
    got = QUERIES["op6_language_id"](spark, BIG).collect()
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{BIG}/documents.parquet").select("doc_id", "lang").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r["held_out"]]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_edge_rows(spark, docs, clashing, edges, empty):
    path = vocabulary_file("piece_bpe_32k.model")
    model = langid.train(langid.labelled_rows(docs), path)
    got = {(str(r["doc_id"]), r["lang_pred"]) for r in langid.identify(clashing, model, path).collect()}
    assert {i for i, x in got if x == "und"} == {"2", "None", "3", "4", "8"} and ("None", "en") in got
    kept = langid.keep_known(clashing, model, path)
    assert kept.columns == clashing.columns and {r["doc_id"] for r in kept.collect()} <= {1, None, 5, 6, 7}
    nothing = langid.train(langid.labelled_rows(empty), path)
    assert {r["lang_pred"] for r in langid.identify(edges, nothing, path).collect()} == {"und"}
    assert langid.identify(empty, model, path).count() == 0


# ------------------------------------------------------------------ sharding

def test_sharding_query(spark, rows):
    got = QUERIES["op7_sharding"](spark, SF).collect()
    text = dict(rows)
    assert len(got) == len(rows) and {r["law"] for r in got} == {"key"}
    for r in got:
        b = (text[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(b) + 8, zlib.crc32(b))
        assert 0 <= r["shard"] < 24 and r["grown_shard"] in (r["shard"], 24)
    for s, n in Counter(r["shard"] for r in got).items():
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(n))


def moved(spark, before, after, n=20_000):
    key = spark.range(n).select(sharding.F.col("id").cast("string").alias("k"))
    return [tuple(r) for r in key.select(sharding.descend(key["k"], before), sharding.descend(key["k"], after)).collect()]


def test_shares_follow_weights_and_moves_stay_in_changed_subtrees(spark):
    tree = {"r0": {"k0": {"a": (0, 1.0), "b": (1, 3.0)}, "k1": {"c": (2, 2.0)}}, "r1": {"k0": {"d": (3, 2.0)}, "k1": {"e": (4, 4.0), "f": (5, 0.0)}}}
    grown = {**tree, "r1": {"k0": {"d": (3, 5.0)}, "k1": tree["r1"]["k1"]}}
    got = moved(spark, tree, grown)
    n = Counter(a for a, _ in got)
    assert all(abs(n[s] / len(got) - w / 12) < 0.015 for s, w in ((0, 1), (1, 3), (2, 2), (3, 2), (4, 4), (5, 0)))
    # nothing moves within r0, nor from r1/k0 or into r1/k1 from it
    assert all(b in (a, 3, 4) for a, b in got) and not [1 for a, b in got if a == 3 and b != 3]


def test_a_new_region_takes_rows_only_into_itself(spark):
    tree = sharding.regular_tree(3, 2, 4)
    got = moved(spark, tree, sharding.with_new_region(tree, 24))
    assert all(b in (a, 24) for a, b in got)
    assert abs(sum(b == 24 for _, b in got) / len(got) - 1 / 25) < 0.01


def test_sharding_edge_rows(clashing, empty):
    tree = sharding.regular_tree(3, 2, 4)
    got = sharding.shard(clashing, tree).collect()
    assert len(got) == len(EDGES) and {r["grown_shard"] for r in got} == {None}
    for s, n in Counter(r["shard"] for r in got).items():
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(n))
    assert len({r["shard"] for r in got if r["doc_id"] == 1}) == len({r["shard"] for r in got if r["doc_id"] is None}) == 1
    assert sharding.shard(empty, tree).count() == 0


def test_slots_over_many_buckets(spark):
    rows = spark.range(5000).selectExpr("1L as doc_id", "id as uid", "cast(id % 3 as int) as shard")
    got = sharding.slots(rows, bucket_rows=100).collect()
    for s in range(3):
        mine = sorted(r["slot"] for r in got if r["shard"] == s)
        assert mine == list(range(len(mine)))


def test_sharding_runs_no_python(spark):
    plan = QUERIES["op7_sharding"](spark, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_copies_of_a_text_do_not_steer_the_language_sample(spark):
    path = vocabulary_file("piece_bpe_32k.model")
    rows = [("a text of very many copies", "aa")] * 3000 + [("another one, that stands once", "aa"), ("ein Satz", "bb")]
    df = spark.createDataFrame(rows, "text string, lang string")
    model = langid.train(df, path, max_docs=20, rounds=1)
    once = langid.train(df.distinct(), path, max_docs=20, rounds=1)
    assert model.langs == once.langs and np.allclose(model.chances, once.chances)
    assert model.chances[:-1, 0].max() > 2 * model.chances[:-1, 0].min()  # not flat
