"""Benchmark decontamination (operator 2): Wu-Manber search over words.

Texts are sequences of words. Every run of ``window`` words of a benchmark item
is a pattern; an item with fewer words is one pattern. Patterns of one length
form one search: a shift table over blocks of ``BLOCK`` words says how far the
search may jump from a position whose block stands nowhere late in a pattern;
where the shift is 0, the block picks a bucket of patterns by its suffix, and
each is compared directly. Most positions of clean text are never looked at.

The benchmark is read in blocks of at most ``block_mb`` of text: each is
compiled once, broadcast, and passes over all documents. Its size is measured
before anything is collected.

Defined cases: a NULL or empty text has no words, no hits, and is clean; NULL
items and items without a word match nothing; items that share an id count
once; a repeated document row is judged like the first; other columns of the
documents never matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import col, cut, id_text, positional, python_tasks

BLOCK = 3  # words in a block of the shift table

#: A-Z to lower case; bytes 0-9, a-z and 0x80-0xFF stay; the rest separates.
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
                   for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split() if text else []


class WuManber:
    """Search for patterns of ``m`` words each: tuple of words -> item ids."""

    def __init__(self, patterns: dict[tuple, set], m: int):
        self.m, self.b = m, min(BLOCK, m)
        self.jump = m - self.b + 1
        self.shift: dict[tuple, int] = {}
        self.buckets: dict[tuple, list[tuple]] = {}
        self.items = patterns
        for p in patterns:
            for end in range(self.b, m + 1):
                block = p[end - self.b:end]
                self.shift[block] = min(m - end, self.shift.get(block, self.jump))
            self.buckets.setdefault(p[m - self.b:], []).append(p)

    def search(self, words: list[bytes]) -> Iterator[tuple[int, tuple]]:
        """(first word, pattern) of every occurrence."""
        m, b, n, jump, shift = self.m, self.b, len(words), self.jump, self.shift.get
        at = m
        while at <= n:
            block = tuple(words[at - b:at])
            step = shift(block, jump)
            if step:
                at += step
                continue
            here = tuple(words[at - m:at])
            for p in self.buckets[block]:
                if p == here:
                    yield at - m, p
            at += 1


def compile_searches(items: list[tuple[str, str]], window: int) -> list[WuManber]:
    by_length: dict[int, dict[tuple, set]] = {}
    for item, text in items:
        w = words_of(text)
        m = min(window, len(w))
        for i in range(len(w) - m + 1 if m else 0):
            by_length.setdefault(m, {}).setdefault(tuple(w[i:i + m]), set()).add(item)
    return [WuManber(p, m) for m, p in sorted(by_length.items())]


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def benchmark_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_mb: float) -> Iterator[list]:
    """The items, as lists of (id, text) of about ``block_mb`` each (one item more at most)."""
    items = benchmark.select(F.coalesce(col(benchmark, id_col).cast("string"), F.lit("")).alias("item"),
                             col(benchmark, text_col).alias("text")).where("text is not null")
    items = cut(items.distinct())  # equal rows share every hash block: without this no n could part them
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(size / (block_mb * 2 ** 20)))
    while n > 1:  # hash blocks are uneven: measure, and cut finer while one is too large
        per = items.groupBy(F.pmod(F.xxhash64("item", "text"), F.lit(n)).alias("b")).agg(
            F.sum(F.octet_length("text")).alias("s"), F.max(F.octet_length("text")).alias("most"))
        if per.where((F.col("s") > 2 * block_mb * 2 ** 20) & (F.col("s") > 2 * F.col("most"))).isEmpty():
            break
        n *= 2
    for b in range(n):
        rows = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == b) if n > 1 else items
        yield [tuple(r) for r in rows.collect()]


def find(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id",
         item_text_col: str = "text", window: int = 13, block_mb: float = 16) -> DataFrame:
    """``docs`` with columns by position (c0, c1, ...) and ``n_words``, ``spans``
    (flat list of first and next word of merged hit runs) and ``items`` (sorted
    ids of items with an occurring window)."""
    spark = docs.sparkSession
    python_tasks(spark)
    at = docs.columns.index(text_col)
    df = positional(docs).withColumns({"n_words": F.lit(0).cast("long"), "spans": F.array().cast("array<int>"),
                                       "items": F.array().cast("array<string>")})
    for k, block in enumerate(benchmark_blocks(benchmark, item_col, item_text_col, block_mb)):
        if k and k % 4 == 0:
            df = cut(df)  # so few chained Python stages hold their tables at once
        tables = spark.sparkContext.broadcast(compile_searches(block, window))

        def scan(batches, tables=tables):
            for batch in batches:
                n_words, spans, items = [], [], []
                for text, old_spans, old_items in zip(batch.column(at), batch.column("spans").to_pylist(),
                                                      batch.column("items").to_pylist()):
                    words = words_of(text.as_py())
                    hits, found = list(zip(old_spans[::2], old_spans[1::2])), set(old_items)
                    for s in tables.value:
                        for first, p in s.search(words):
                            if hits and hits[-1][0] <= first <= hits[-1][1]:
                                hits[-1] = (hits[-1][0], max(hits[-1][1], first + s.m))
                            else:
                                hits.append((first, first + s.m))
                            found |= s.items[p]
                    n_words.append(len(words))
                    spans.append([x for lo_hi in merge(hits) for x in lo_hi])
                    items.append(sorted(found))
                kept = batch.columns[:-3]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(n_words, pa.int64()), pa.array(spans, pa.list_(pa.int32())),
                     pa.array(items, pa.list_(pa.string()))], names=batch.schema.names)

        df = df.mapInArrow(scan, df.schema)
    return df


def n_hit():
    """Words inside the spans: ends less starts."""
    return F.aggregate(F.transform("spans", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)),
                       F.lit(0).cast("long"), lambda s, x: s + x)


def judged(found: DataFrame) -> DataFrame:
    """Adds n_hit, n_items and contaminated (a hit, and at least a twentieth of the words)."""
    return (found.withColumn("n_hit", n_hit()).withColumn("n_items", F.size("items").cast("long"))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))))


def contamination(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items, spans, contaminated."""
    found = judged(find(id_text(docs), benchmark, **how))
    return found.select(F.col("c0").alias("doc_id"), "n_words", "n_hit", "n_items", "items", "spans", "contaminated")


def decontaminate(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, columns as they are."""
    clean = judged(find(docs, benchmark, **how)).where(~F.col("contaminated"))
    return clean.select(*[f"c{i}" for i in range(len(docs.columns))]).toDF(*docs.columns)
