"""Language ID (operator 6): segmentation-marginalised unigrams.

The vocabulary is fixed and public: the pieces of a sentencepiece file, plus
every single character (unknown ones share one probability). A language is a
unigram distribution over pieces. The probability of a word is the sum over all
its segmentations into pieces, by the forward algorithm; a text's score in a
language is the product over its words, and its prediction the language of the
largest posterior under equal priors.

Training is expectation-maximisation with the forward-backward algorithm over
word counts of labelled texts: the expected number of times that each piece is
used becomes its probability. It reads at most about ``max_docs`` documents of
each language, taken by a hash of the row (a bound that is a parameter, since a
unigram model of a fixed vocabulary gains nothing from more); their word counts
and the expected counts are gathered by Spark, and only the (language, piece)
table, whose size the vocabulary bounds, comes to the driver.

A word is a run of letters, lower-cased, with the vocabulary's start mark,
however long. Its forward pass goes ``STEP`` characters at a time, with the sums
of the last few places carried on and rescaled, so that memory is bounded by
the batch and nothing underflows. Words are scored in batches, all languages at
once. Only learning takes runs in parts of ``LEARN`` characters.

Defined cases: a text that is NULL or has no letter is ``und`` with score 0;
without any labelled text every text is ``und``; ties go to the language that
sorts first; repeated rows get equal results; other columns never matter; an
empty table gives an empty result.
"""

from __future__ import annotations

import functools
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.bpe import WordCache
from tidewater.llm.common import col, cut, id_text, positional, python_tasks

STEP, EVERY, LEARN = 32, 16, 4096
ROUNDS, UND = 3, "und"
START = "▁"
ASCII_WORDS = re.compile("[a-z]+")
WORDS = regex.compile(r"[\p{L}\p{Nl}\p{No}]+")
LETTERS = regex.compile(r"\p{L}+").findall


def words(text: str | None) -> list[str]:
    if not text:
        return []
    low = text.lower()
    return ASCII_WORDS.findall(low) if low.isascii() else WORDS.findall(low)


def has_letter(found: list[str]) -> bool:
    """Some word has a letter (WORDS also finds numbers that are no digits)."""
    return any(w.isascii() or LETTERS(w) for w in found)


class Vocabulary:
    """Pieces by a hash of their characters, looked up for whole batches."""

    SIZE = 1 << 20

    def __init__(self, pieces: list[str]):
        self.pieces = list(dict.fromkeys(p for p in pieces if p))
        self.unknown = len(self.pieces)
        self.longest = max(map(len, self.pieces), default=1)
        self.base = np.uint64(0x9E3779B97F4A7C15)
        self.slot_hash, self.slot_id, self.probes = np.zeros(self.SIZE, np.uint64), np.full(self.SIZE, -1, np.int32), 1
        for i, p in enumerate(self.pieces):
            h = self.hash_of(p)
            for k in range(self.SIZE):
                at = int(self.slot(h)) + k & self.SIZE - 1
                if self.slot_id[at] < 0:
                    self.slot_hash[at], self.slot_id[at], self.probes = h, i, max(self.probes, k + 1)
                    break

    def hash_of(self, p: str) -> np.uint64:
        h = 0
        for c in p:
            h = (h * int(self.base) + ord(c) + 1) & (1 << 64) - 1
        return np.uint64(h)

    def slot(self, h: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(44)).astype(np.int64)  # 20 bits

    def lookup(self, h: np.ndarray) -> np.ndarray:
        """Piece ids, -1 where there is none (linear probing; the table is nearly empty)."""
        at = self.slot(h)
        out = np.where(self.slot_hash[at] == h, self.slot_id[at], np.int32(-1))
        open_ = np.nonzero((out < 0) & (self.slot_id[at] >= 0))
        for k in range(1, self.probes):
            j = at[open_] + k & self.SIZE - 1
            out[open_] = np.where((self.slot_hash[j] == h[open_]) & (out[open_] < 0), self.slot_id[j], out[open_])
        return out

    def lattice(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(sizes, arcs): arcs[l-1, i] are the piece ids that end before character i+1 and are l long, by word; -1: none."""
        sizes = np.array([len(w) for w in batch])
        wide = int(sizes.max())
        codes = np.zeros((len(batch), wide), dtype=np.uint64)
        flat = np.frombuffer("".join(batch).encode("utf-32-le", "surrogatepass"), "<u4")
        codes[np.arange(wide) < sizes[:, None]] = flat.astype(np.uint64) + np.uint64(1)
        prefix = np.zeros((wide + 1, len(batch)), dtype=np.uint64)
        power = [np.uint64(1)]
        with np.errstate(over="ignore"):
            for i in range(wide):
                prefix[i + 1] = prefix[i] * self.base + codes[:, i]
                power.append(power[-1] * self.base)
            arcs = np.full((self.longest, wide, len(batch)), -1, dtype=np.int32)
            for size in range(1, min(self.longest, wide) + 1):
                h = prefix[size:] - prefix[:wide + 1 - size] * power[size]
                arcs[size - 1, size - 1:] = self.lookup(h)
        inside = np.arange(wide)[:, None] < sizes[None, :]
        arcs[0] = np.where(arcs[0] < 0, self.unknown, arcs[0])  # any character is a piece
        arcs = np.where(inside[None], arcs, -1)
        return sizes, arcs


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    import sentencepiece
    p = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [p.id_to_piece(i) for i in range(p.get_piece_size()) if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i))]
    return Vocabulary([x for x in pieces if re.fullmatch(START + r"?[^\W\d_]*", x) and x == x.lower()])  # no other can occur in a word


def by_size(items: list[str]) -> list[list[int]]:
    """Numbers of the items, grouped by like size."""
    groups: dict[int, list[int]] = {}
    for i, w in enumerate(items):
        groups.setdefault(-(-len(w) // 4) if len(w) <= 2 * STEP else -len(w).bit_length(), []).append(i)
    return list(groups.values())


def forward(arcs: np.ndarray, chances: np.ndarray, before: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(alpha, logs) by place, word and language: alpha * exp(logs) is the summed
    probability of all segmentations up to a place. The first ``longest`` places
    are ``before``, on the scale ``scale``. ``chances`` has a last row of zeros, for -1."""
    most, wide, n = arcs.shape
    alpha, logs = np.zeros((most + wide, n, chances.shape[1])), np.zeros((most + wide, n, chances.shape[1]))
    alpha[:most], logs[:most] = before, scale
    there = (arcs >= 0).any(axis=2)
    for i in range(wide):
        k = np.nonzero(there[:, i])[0]
        alpha[most + i] = np.einsum("knl,knl->nl", alpha[most + i - 1 - k], chances[arcs[k, i]])
        if i % EVERY == EVERY - 1:
            last = alpha[i + 1:most + i + 1]
            top = last.max(axis=0)
            top[top <= 0] = 1  # words that have ended
            last /= top
            scale = scale + np.log(top)
            logs[i + 1:most + i + 1] = scale
        else:
            logs[most + i] = scale
    return alpha, logs


def first_place(vocab: Vocabulary, n: int, langs: int) -> tuple[np.ndarray, np.ndarray]:
    before = np.zeros((vocab.longest, n, langs))
    before[-1] = 1
    return before, np.zeros((n, langs))


def word_scores(vocab: Vocabulary, chances: np.ndarray, batch: list[str]) -> np.ndarray:
    """Log-probability of each word, by language."""
    items, most = [START + w for w in batch], vocab.longest
    sizes, out = np.array([len(w) for w in items]), np.zeros((len(batch), chances.shape[1]))
    for group in by_size(items):
        for start in range(0, len(group), 4096):
            some, at = np.array(group[start:start + 4096]), 0
            before, scale = first_place(vocab, len(some), chances.shape[1])
            while len(some):
                behind = min(at, most)
                _, arcs = vocab.lattice([items[i][at - behind:at + STEP] for i in some])
                alpha, logs = forward(arcs[:, behind:], chances, before, scale)
                ends = sizes[some] <= at + STEP
                done, place = some[ends], most - 1 + sizes[some[ends]] - at
                out[done] = np.log(alpha[place, np.nonzero(ends)[0]]) + logs[place, np.nonzero(ends)[0]]
                some, before, scale, at = some[~ends], alpha[-most:, ~ends], logs[-1, ~ends], at + STEP
    return out


def expected_counts(vocab: Vocabulary, chances: np.ndarray, batch: list[str], weight: np.ndarray) -> np.ndarray:
    """Expected uses of each piece, by language, of words that occur ``weight`` (word, language) times."""
    out, most = np.zeros((len(vocab.pieces) + 2, chances.shape[1])), vocab.longest
    equal: dict[int, list[tuple[str, int]]] = {}
    for k, w in enumerate(batch):
        marked = START + w
        for i in range(0, len(marked), LEARN):
            part = marked[i:i + LEARN]
            equal.setdefault(len(part), []).append((part, k))
    for wide, group in equal.items():
        n = max(1, (1 << 16) // wide)
        for at in range(0, len(group), n):
            some = group[at:at + n]
            _, arcs = vocab.lattice([w for w, _ in some])
            w = weight[[k for _, k in some]]
            back = np.full_like(arcs, -1)  # the same pieces, read from the end
            for size in range(1, min(most, wide) + 1):
                back[size - 1, size - 1:] = arcs[size - 1, size - 1:][::-1]
            alpha, up = forward(arcs, chances, *first_place(vocab, len(some), out.shape[1]))
            beta, down = forward(back, chances, *first_place(vocab, len(some), out.shape[1]))
            whole = np.log(alpha[-1]) + up[-1]
            for size in range(1, min(most, wide) + 1):
                ids, places = arcs[size - 1, size - 1:], slice(most - 1, most + wide - size)
                if not (ids >= 0).any():
                    continue
                used = alpha[places] * chances[ids] * beta[places][::-1] * np.exp(up[places] + down[places][::-1] - whole) * w
                for lang in range(out.shape[1]):
                    out[:, lang] += np.bincount(ids.ravel() + 1, used[:, :, lang].ravel(), out.shape[0])
    return out[1:]


class Model:
    def __init__(self, langs: list[str], chances: np.ndarray):
        self.langs, self.chances = langs, chances


def normalised(counts: np.ndarray) -> np.ndarray:
    """Probabilities by language, smoothed; a row of zeros is added for "no piece"."""
    p = counts + 0.1
    return np.vstack([p / p.sum(axis=0), np.zeros(p.shape[1])])


def train(labelled: DataFrame, path: str, max_docs: int = 2000, rounds: int = ROUNDS) -> Model:
    """``labelled`` has text and lang; rows with a NULL in either teach nothing."""
    spark = labelled.sparkSession
    python_tasks(spark)
    vocab = vocabulary(path)
    rows = labelled.select("text", "lang", F.xxhash64("text", "lang").alias("h")).where("text is not null and lang is not null")
    # equal texts count once: a text of many copies neither thins out the sample of its language nor fills it
    found = {r["lang"]: r["n"] for r in rows.select("lang", "h").distinct().groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(found)
    if not langs:
        return Model([], np.zeros((len(vocab.pieces) + 2, 0)))
    taken = F.lit(False)
    for lang, n in found.items():  # an even share of the hash range
        bound = min(1.0, max_docs / n)
        taken = taken | ((F.col("lang") == lang) & (F.shiftrightunsigned("h", 11) < int(bound * (1 << 53)) + (bound == 1.0)))

    def count(batches):
        total: dict = {}
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for w in words(text):
                    total[lang, w] = total.get((lang, w), 0) + 1
        keys = list(total)
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
                                          pa.array([total[k] for k in keys], pa.int64())], names=["lang", "word", "n"])

    each = rows.where(taken).dropDuplicates(["lang", "h"]).select("text", "lang").mapInArrow(count, "lang string, word string, n long")
    by_word = cut(each.groupBy("word").agg(*[F.sum(F.when(F.col("lang") == x, F.col("n")).otherwise(0)).alias(f"n{k}")
                                             for k, x in enumerate(langs)]))
    chances = normalised(np.ones((len(vocab.pieces) + 1, len(langs))))
    python_tasks(spark, rows=20_000)
    pieces = spark.sparkContext.broadcast(vocab)
    for _ in range(rounds):
        now = spark.sparkContext.broadcast(chances)

        def expect(batches, now=now):
            v, total = pieces.value, 0
            for batch in batches:
                weight = np.stack([batch.column(1 + k).to_numpy(zero_copy_only=False) for k in range(len(langs))], axis=1).astype(float)
                total = total + expected_counts(v, now.value, batch.column(0).to_pylist(), weight)
            if isinstance(total, np.ndarray):
                i, k = np.nonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(i, pa.int64()), pa.array(k, pa.int64()), pa.array(total[i, k])],
                                                 names=["piece", "lang", "n"])

        got = by_word.mapInArrow(expect, "piece long, lang long, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n")).collect()
        counts = np.zeros((len(vocab.pieces) + 1, len(langs)))
        for r in got:
            counts[r["piece"], r["lang"]] = r["n"]
        chances = normalised(counts)
    python_tasks(spark)
    return Model(langs, chances)


def predict(df: DataFrame, at: int, model: Model, path: str) -> DataFrame:
    """``df`` (columns by position) with ``lang_pred`` and ``score``, of its column number ``at``."""
    spark = df.sparkSession
    python_tasks(spark)
    fitted, pieces = spark.sparkContext.broadcast(model), spark.sparkContext.broadcast(vocabulary(path))

    def tasks(batches):
        vocab, m = pieces.value, fitted.value
        scores = np.zeros((1 << 12, len(m.langs)))
        place: dict = {}
        for batch in batches:
            texts = [words(x.as_py()) for x in batch.column(at)]
            if len(place) > 400_000:
                place.clear()
            new = list({w for x in texts for w in x if w not in place})
            if new and m.langs:
                while len(place) + len(new) > len(scores):
                    scores = np.vstack([scores, np.zeros_like(scores)])
                scores[len(place):len(place) + len(new)] = word_scores(vocab, m.chances, new)
                place.update(zip(new, range(len(place), len(place) + len(new))))
            pred, conf = [], []
            for x in texts:
                if not m.langs or not has_letter(x):
                    pred.append(UND)
                    conf.append(0.0)
                    continue
                s = scores[[place[w] for w in x]].sum(axis=0)
                best = int(np.argmax(s))
                pred.append(m.langs[best])
                conf.append(float(1 / np.exp(s - s[best]).sum()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pred, pa.string()), pa.array(conf, pa.float64())],
                                             names=[*batch.schema.names, "lang_pred", "score"])

    return df.mapInArrow(tasks, df.select("*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema)


def held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def labelled_rows(docs: DataFrame) -> DataFrame:
    return docs.select(col(docs, "doc_id").alias("doc_id"), col(docs, "text").alias("text"), col(docs, "lang").alias("lang")).where(
        ~F.coalesce(held_out(), F.lit(False)))


def identify(docs: DataFrame, model: Model, path: str) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    found = predict(positional(id_text(docs)), 1, model, path)
    return found.withColumn("doc_id", F.col("c0")).select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")


def keep_known(docs: DataFrame, model: Model, path: str, least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, columns as they are, whose language is told with a score of at least ``least``."""
    found = predict(positional(docs), docs.columns.index("text"), model, path)
    return found.where((F.col("lang_pred") != UND) & (F.col("score") >= least)).select(
        *[f"c{i}" for i in range(len(docs.columns))]).toDF(*docs.columns)
