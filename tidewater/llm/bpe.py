"""BPE encoding and decoding (operator 4): a tokenization automaton.

The merges of a public vocabulary are compiled, in their order, into one
deterministic automaton whose arcs are tokens. It starts as a single state that
any base symbol loops on. The gadget of a merge (u, v) -> w forbids v right
behind u and lets w stand wherever u could: the state behind u is split, so
that u alone leads to a copy of it without the arc v (for u = v also without w,
for runs pair up from the left), and every state with an arc u gets an arc w,
to where v led. A word's only accepted path is then its tokenization. Tables:
the state behind each token, and one bit for each (token, state) arc.

Encoding follows arcs through a pre-split word, longest token first, and marks
the places that led nowhere; a prefix of a word has one accepted path too, so
no place is tried twice. Decoding emits the arcs' labels, joined by spaces, as
a vocabulary without a decoder asks for.

Texts are normalised and split as the vocabulary file prescribes: its special
tokens are cut out first; then NFC, lower case, and the runs that its pattern
finds, as UTF-8 bytes with an end mark. Python does this, but for texts with
characters that its Unicode tables do not know yet: those go through the
library's normaliser and pattern. ``load`` refuses files of another make.

The automaton is compiled once on the driver from a file of fixed size, and
broadcast; its size depends on the vocabulary alone. Words found in a task are
remembered in a cache of bounded size.

Defined cases: a NULL text has no tokens, like an empty or blank one; words of
any length are encoded; repeated rows get equal results; other columns never
matter; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tidewater.llm.common import id_text, python_tasks

# The pattern, white space and end mark of the vocabulary files read here.
WHITE = r"\t-\r \x85\xa0  -     　"
SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
END = "</w>"

# The same runs, alternatives ordered for speed. In RUNS a run of letters may hold numbers
# that are no digits (such as a half); ``exact_runs`` cuts it where it does.
ASCII_RUNS = re.compile(r"[a-z]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\t-\r a-z0-9]+")
RUNS = re.compile(r"[^\W\d_]+|\d|'(?:s|t|re|ve|m|ll|d)|(?:[^\w" + WHITE + r"]|_)+")
exact_runs = regex.compile(r"\p{L}+|\p{N}").findall
MARKS = '.,;:!?"()#$%&*<>|'  # what often ends a word; any of them together are one piece
CACHED = 400_000  # words in a task's cache


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself if printable, else one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


class WordCache(dict):
    """word -> value, by ``make``; keeps the ``size`` words met last at least, twice that at most."""

    def __init__(self, make, size: int = CACHED, longest: int = 64):
        super().__init__()
        self.make, self.size, self.longest, self.old = make, size, longest, {}

    def __missing__(self, word):
        value = self.old.get(word)
        if value is None:
            value = self.make(word)
            if len(word) > self.longest:
                return value
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[word] = value
        return value


def lower(text: str) -> str:
    """Character by character: no final sigma."""
    return text.replace("Σ", "σ").lower()


def runs(text: str) -> list[str]:
    """The pieces of a normalised text without special tokens."""
    return ASCII_RUNS.findall(text) if text.isascii() else RUNS.findall(text)


def normal(text: str) -> str:
    return text.lower() if text.isascii() else lower(unicodedata.normalize("NFC", text))


class Newer(Exception):
    """A word has a character that Python's Unicode tables do not know; the library's are newer."""


#: White space for ``str.split`` that is none for the vocabulary's pattern.
FALSE_WHITE = ("\x1c", "\x1d", "\x1e", "\x1f")


class TextEncoder:
    """text -> ids as little-endian unsigned 32-bit integers, from the ids of its pieces.

    No piece holds white space, so what stands between two spaces is looked up
    as one in a cache of bounded size, and only new ones are cut into pieces,
    which are looked up there too. ``file`` is the vocabulary file without its
    model: a text with characters newer than Python's tables is normalised and
    cut by the library itself."""

    def __init__(self, special: dict[str, int], file: str, piece, cached: int = CACHED):
        self.special, self.file, self.piece = special, file, piece
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.words = WordCache(self.word, cached)
        self.library = None

    def word(self, word: str) -> bytes:
        if word.isalpha():  # letters alone are one piece
            return self.piece(word)
        stem = word.rstrip(MARKS)
        if stem.isalpha():  # and one run of marks
            found = self.words.get(stem)  # a rare one takes one place in the cache, not two
            return (self.piece(stem) if found is None else found) + self.words[word[len(stem):]]
        if not word.isascii() and any(unicodedata.category(c) == "Cn" for c in word):  # normalising has left it as it was
            raise Newer
        found = runs(word)
        if len(found) > 1:
            return b"".join(map(self.words.__getitem__, found))
        # one run, in which numbers that are no digits (such as a half) are pieces of their own
        parts = exact_runs(word) if word[0].isalnum() and not word.isascii() else found
        return b"".join(map(self.piece, parts))

    def by_library(self, text: str) -> bytes:
        if self.library is None:
            from tokenizers import Tokenizer
            self.library = Tokenizer.from_str(self.file)
            self.byte_of = {s: b for b, s in enumerate(byte_symbols())}
        found = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return b"".join([self.piece(bytes(map(self.byte_of.__getitem__, p)).decode()) for p, _ in found])

    def segment(self, text: str) -> bytes:
        plain = normal(text)
        try:
            return b"".join(map(self.words.__getitem__, runs(plain) if any(c in plain for c in FALSE_WHITE) else plain.split()))
        except Newer:
            return self.by_library(text)

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.cut is None or not any(s in text for s in self.special):
            return self.segment(text)
        return b"".join([self.special[x].to_bytes(4, "little") if x in self.special else self.segment(x) for x in self.cut.split(text)])


class Automaton:
    """The compiled tables. Token ids are the vocabulary's; bytes stand for themselves, a space for the end mark."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], special: dict[str, int], file: str = ""):
        of_symbol = {s: bytes([b]) for b, s in enumerate(byte_symbols())}

        def raw(token: str) -> bytes:
            stem, final = (token[:-len(END)], True) if token.endswith(END) and token != END else (token, False)
            return b"".join(of_symbol[x] for x in stem) + b" " * final

        space = byte_symbols()[32]
        self.ids = {raw(t): i for t, i in vocab.items() if space not in t}  # no piece holds a space
        self.labels = {i: t for t, i in vocab.items()} | {i: t for t, i in special.items()}
        self.special, self.file, size = special, file, max(vocab.values()) + 1
        made = {u + v for u, v in merges}
        row = {t: k for k, t in enumerate([*(t for t in vocab if t not in made), *dict.fromkeys(u + v for u, v in merges)])}
        behind = np.full(size, -1, dtype=np.int64)  # the state behind a token; -1: the word ends
        base = [i for t, i in vocab.items() if t not in made]
        behind[[i for t, i in vocab.items() if t not in made and not t.endswith(END)]] = 0
        # the number of states first, to lay out the table
        plan, users, states = [], {0: int((behind == 0).sum())}, 1
        for u, v in merges:
            a, b, w = vocab[u], vocab[v], vocab[u + v]
            state = int(behind[a])
            behind[w] = behind[b]
            if behind[w] >= 0:
                users[int(behind[w])] = users.get(int(behind[w]), 0) + 1
            split = state == 0 or users[state] > 1
            if split:
                users[state] -= 1
                behind[a], users[states], states = states, 1, states + 1
            plan.append((state, int(behind[a])))
        self.width = (states + 7) // 8
        arcs = np.zeros((len(row), self.width), dtype=np.uint8)  # rows in the order in which tokens come up
        arcs[:len(base), 0] = 1
        for (u, v), (state, copy) in zip(merges, plan):
            a, b, w = row[u], row[v], row[u + v]
            if arcs[b, state >> 3] >> (state & 7) & 1:
                arcs[w] |= arcs[a]
            if copy != state:
                arcs[:w + 1, copy >> 3] |= (arcs[:w + 1, state >> 3] >> (state & 7) & 1) << (copy & 7)
            for gone in {b, w} if a == b else {b}:
                arcs[gone, copy >> 3] &= ~np.uint8(1 << (copy & 7))
        by_id = np.zeros((size, self.width), dtype=np.uint8)
        by_id[[vocab[t] for t in row]] = arcs
        self.arcs, self.behind = by_id.tobytes(), behind.tolist()
        # which sizes tokens have that start with these bytes, largest first
        sizes: dict[bytes, set] = {}
        for t in self.ids:
            sizes.setdefault(t[:4], set()).add(len(t))
        for p in list(sizes):
            sizes[p] |= {n for n in range(1, len(p)) if p[:n] in self.ids}
        self.sizes = {p: tuple(sorted(x, reverse=True)) for p, x in sizes.items()}

    def sizes_at(self, s: bytes, at: int) -> tuple:
        return next((x for n in (4, 3, 2, 1) if (x := self.sizes.get(s[at:at + n]))), ())

    def encode_word(self, word: bytes) -> list[int]:
        """Ids of one pre-split word."""
        s, ids, arcs, width, behind, sizes = word + b" ", self.ids, self.arcs, self.width, self.behind, self.sizes
        n, path, dead, at, state = len(word) + 1, [], set(), 0, 0
        left = iter(sizes.get(s[:4]) or self.sizes_at(s, 0))  # sizes still to try here
        while True:
            for size in left:
                t = ids.get(s[at:at + size])
                if t is not None and arcs[t * width + (state >> 3)] >> (state & 7) & 1 and at + size not in dead:
                    path.append((at, state, left, t))
                    at, state = at + size, behind[t]
                    break
            else:  # nothing led to the end from here
                dead.add(at)
                if not path:
                    raise ValueError(f"no path for {word!r}")
                at, state, left, _ = path.pop()
                continue
            if at == n:
                return [x[3] for x in path]
            left = iter(sizes.get(s[at:at + 4]) or self.sizes_at(s, at)) if state >= 0 else iter(())

    def encoder(self) -> TextEncoder:
        """text -> ids, with caches of its own."""
        return TextEncoder(self.special, self.file, lambda p: np.array(self.encode_word(p.encode("utf-8", "surrogatepass")), dtype="<u4").tobytes())

    def decode(self, ids: bytes) -> str:
        """The arcs' labels."""
        return " ".join(map(self.labels.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


def parse(text: str) -> tuple[dict[str, int], list[tuple[str, str]], dict[str, int], str]:
    """(vocabulary, merges, special tokens, the file without them) of a file of the make that this module handles."""
    file = json.loads(text)
    model, steps = file["model"], file["normalizer"]["normalizers"]
    made = (model["type"], model["end_of_word_suffix"], [x["type"] for x in steps],
            file["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"], file["decoder"], file["post_processor"])
    if made != ("BPE", END, ["NFC", "Replace", "Lowercase"], SPLIT, None, None):
        raise ValueError(f"a tokenizer of another make: {made}")
    rest = {**file, "added_tokens": [], "model": {**model, "vocab": {}, "merges": []}}
    return model["vocab"], [tuple(x) for x in model["merges"]], {x["content"]: x["id"] for x in file["added_tokens"]}, json.dumps(rest)


@functools.lru_cache(maxsize=2)
def load(path: str) -> Automaton:
    with open(path, encoding="utf-8") as f:
        return Automaton(*parse(f.read()))


def encode(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, ids (little-endian unsigned 32-bit integers) and the decoded text."""
    spark = docs.sparkSession
    python_tasks(spark)
    tables = spark.sparkContext.broadcast(load(path))

    def tasks(batches):
        encode_text = tables.value.encoder()
        for batch in batches:
            ids = [encode_text(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary()),
                                              pa.array([tables.value.decode(x) for x in ids], pa.string())],
                                             names=["doc_id", "ids", "decoded"])

    df = id_text(docs, id_col, text_col)
    kind = df.schema["doc_id"].dataType.simpleString()
    return df.mapInArrow(tasks, f"doc_id {kind}, ids binary, decoded string")
