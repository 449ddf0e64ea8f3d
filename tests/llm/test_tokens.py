"""Operators 4 and 9 against the tokenizers library, and exact round trips."""

import hashlib
import os
import random
import unicodedata
import zlib

import numpy as np
import pytest

from tests.llm.conftest import EDGES, SF
from tidewater.llm import bpe, rans
from tidewater.llm.queries import QUERIES, vocabulary_file

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(vocabulary_file("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def automaton():
    return bpe.load(vocabulary_file("word_bpe_49k.json"))


def le(ids):
    return np.array(ids, dtype="<u4").tobytes()


def test_automaton_on_a_small_vocabulary():
    merges = [("a", "a"), ("a", "b"), ("aa", "ab"), ("b", "</w>"), ("aa", "aa")]
    letters = [*bpe.byte_symbols(), *(s + "</w>" for s in bpe.byte_symbols())]
    merges = [(u, v) for u, v in merges if v != "</w>"] + [("a", "b</w>"), ("aa", "ab</w>")]
    vocab = {t: i for i, t in enumerate([*letters, *(u + v for u, v in merges)])}
    a = bpe.Automaton(vocab, merges, {})
    rank = {m: k for k, m in enumerate(merges)}

    def slow(word):
        t = [*word[:-1], word[-1] + "</w>"]
        while True:
            best = min((rank.get((x, y), 99), i) for i, (x, y) in enumerate([*zip(t, t[1:]), ("", "")]))
            if best[0] == 99:
                return [vocab[x] for x in t]
            i = best[1]
            t[i:i + 2] = [t[i] + t[i + 1]]
    rng = random.Random(0)
    for n in range(1, 14):
        for _ in range(60):
            w = "".join(rng.choice("aab") for _ in range(n))
            assert a.encode_word(w.encode()) == slow(w), w


def test_words_like_the_library(automaton, library):
    rng = random.Random(1)
    known = [c for c in map(chr, [*range(32, 0x3000), *range(0x4E00, 0x9FFF), *range(0x1F300, 0x1F600)])
             if unicodedata.category(c) != "Cn" and unicodedata.category(c) != "Cs"]
    texts = ["".join(rng.choice(known if rng.random() < .3 else known[:95]) for _ in range(rng.randrange(1, 120))) for _ in range(400)]
    texts += [r[1] or "" for r in EDGES] + ["ΣΑΣ Σ", "İı ß ẞ ŉ", "it's we'll I'M 'sabc '' ''s", "é café", "\x1c\x1d\x85a\xa0b",
                                            "<|startoftext|>a b<|endoftext|><|endoftext|", "½ⅧⅷⅦa²b"]
    encode = automaton.encoder()
    for x in texts:
        want = library.encode(x, add_special_tokens=False).ids
        got = encode(x)
        assert got == le(want), x
        assert automaton.decode(got) == library.decode(want, skip_special_tokens=False)


def test_library_pieces_like_whole_texts(library):
    with open(vocabulary_file("word_bpe_49k.json"), encoding="utf-8") as f:
        encode = rans.library_encoder(f.read())
    for x in [r[1] for r in EDGES] + ["ΣΑΣ İ ½ é <|endoftext|> 日本 it's"]:
        assert encode(x) == le(library.encode(x or "", add_special_tokens=False).ids)


def test_every_character_is_split_as_by_the_library(automaton, library):
    """Planes 0 to 3 and 14, in words and alone, with marks and white space beside them."""
    with open(vocabulary_file("word_bpe_49k.json"), encoding="utf-8") as f:
        encoders = [automaton.encoder(), rans.library_encoder(f.read())]
    codes = [c for c in [*range(0x40000), *range(0xE0000, 0xE0200)] if not 0xD800 <= c < 0xE000]
    texts = [f"ab{chr(c)}cd {chr(c)}{chr(c)}'s, 1{chr(c)}" for c in codes]
    for start in range(0, len(texts), 20_000):
        some = texts[start:start + 20_000]
        for x, want in zip(some, library.encode_batch(some, add_special_tokens=False)):
            for encode in encoders:
                assert encode(x) == le(want.ids), ascii(x)


def test_bpe_query(spark, rows, library):
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op4_bpe"](spark, SF).collect()}
    want = {}
    for i, x in rows:
        ids = library.encode(x or "", add_special_tokens=False).ids
        want[i] = (len(ids), hashlib.sha256(le(ids)).hexdigest(),
                   hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    assert got == want


def test_bpe_edge_rows(clashing, empty, library):
    path = vocabulary_file("word_bpe_49k.json")
    got = bpe.encode(clashing, path).collect()
    assert sorted((str(r["doc_id"]), bytes(r["ids"])) for r in got) == sorted(
        (str(r[0]), le(library.encode(r[1] or "", add_special_tokens=False).ids)) for r in EDGES)
    assert bpe.encode(empty, path).count() == 0


def test_other_files_are_refused():
    with pytest.raises((ValueError, KeyError, TypeError)):
        bpe.load(vocabulary_file("byte_bpe_50k.json"))


def test_word_cache_is_bounded():
    c = bpe.WordCache(lambda w: w.upper(), size=10, longest=5)
    assert [c[w] for w in ["a", "a", "toolong"]] == ["A", "A", "TOOLONG"]
    for i in range(500):
        assert c[str(i)] == str(i)
        assert len(c) <= 10 and len(c.old) <= 10 and "toolong" not in c


# ------------------------------------------------------------------ rANS

@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 40_000, 100_001])
def test_block_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.2, n), 49_000)
    coder = rans.Coder(*rans.frequencies({int(k): int(v) for k, v in zip(*np.unique(ids, return_counts=True))} or {5: 1}))
    coded = coder.encode(ids)
    assert (coder.decode(coded) == ids).all()
    step = rans.LANES * rans.STEPS
    for k in range(-(-n // step)):  # from any checkpoint
        assert (coder.decode(coded, range(k, k + 1)) == ids[k * step:(k + 1) * step]).all()
    if n == 100_001:
        p = np.unique(ids, return_counts=True)[1] / n
        assert len(coded) * 8 / n < -(p * np.log2(p)).sum() + 2
        with pytest.raises(ValueError):
            coder.decode(coded[:-9] + bytes(9))


def test_frequencies_sum_to_a_power_of_two():
    bits, ids, freqs = rans.frequencies({i: 1 + (i == 3) * 10 ** 9 for i in range(49_000)})
    assert freqs.sum() == 1 << bits and freqs.min() >= 1 and list(ids) == list(range(49_000))


def test_an_unknown_id_is_refused():
    with pytest.raises(ValueError):
        rans.Coder(*rans.frequencies({1: 5, 9: 2})).encode(np.array([1, 4]))


def expected(rows, library, end=2):
    start, out = 0, []
    for i, x in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library.encode(x or "", add_special_tokens=False).ids + [end]
        out.append((i, start, len(ids), zlib.crc32(le(ids))))
        start += len(ids)
    return out


def test_token_query(spark, rows, library):
    got = QUERIES["op9_token_output"](spark, SF).collect()
    assert sorted(map(tuple, got)) == expected(rows, library)


def test_token_edge_rows(spark, clashing, empty, tmp, library):
    path = vocabulary_file("word_bpe_49k.json")
    rans.write(rans.tokens(clashing, path, 2), f"{tmp}/a")
    got = sorted((r["start"], str(r["doc_id"]), r["n_tokens"]) for r in rans.read(spark, f"{tmp}/a").collect())
    ends = [s + n for s, _, n in got]
    assert [s for s, _, _ in got] == [0, *ends[:-1]] and [i for _, i, _ in got][:2] == ["None", "None"]
    assert sorted((i, n) for _, i, n in got) == sorted((str(i), n) for i, _, n, _ in expected([r[:2] for r in EDGES], library))
    rans.write(rans.tokens(empty, path, 2), f"{tmp}/b")
    assert rans.read(spark, f"{tmp}/b").count() == 0
