"""Substring dedup (operator 8): paragraph MinHash banding.

A paragraph is a line of at least ``min_words`` words; shorter lines (headings,
formulas) are left alone. Its words are the runs of digits, letters a-z
(A-Z lower-cased) and non-ASCII characters; its features the set of its 5-word
shingles.

1. One pass over the texts hashes every paragraph and its bands; equal
   paragraphs become one. ``tune`` picks the bands: the fewest hashes that find
   a pair of the wanted similarity with high probability and seldom join
   unlike ones.
2. Paragraphs that agree in a band are tied to the band's smallest one (an
   aggregation with partial minima, so a hot band costs no more than others);
   components of these ties are the candidate groups.
3. The shingles of the candidates alone are fetched, once per paragraph. Within
   a group exact Jaccard similarity is verified, by chunks of bounded size when
   it is large, keeping the links that connect it (see ``links``).
4. Components of the verified links are classes. Of a class's occurrences in
   all documents the first stays (smallest doc_id, NULL last; then text hash,
   line); the others are cut from their texts.
5. ``dedup_text`` then cuts verbatim passages that stand in other lines: wrapped,
   embedded, or with moved line breaks (see ``passages``).

Defined cases: NULL and empty texts stay as they are; rows equal in doc_id and
text count as one document and get the same result; a paragraph repeated within
a text is removed like one repeated elsewhere; other columns never matter; an
empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import SMALL_SIDE, cut, id_text, python_tasks, row_key, small, staged
from tidewater.llm.components import components
from tidewater.llm.decontamination import words_of
from tidewater.llm.links import spanning_links
from tidewater.llm.passages import cut_windows, repeated_windows

SHINGLE, SIMILARITY, MIN_WORDS = 5, 0.8, 20


def tune(similarity: float, recall: float = 0.9995, unlike: float = 0.3, most: float = 0.15) -> tuple[int, int]:
    """(bands, rows): the fewest hashes that join a pair of ``similarity`` with
    probability ``recall``, and one of ``unlike`` with probability ``most`` at most."""
    found = []
    for rows in range(1, 17):
        bands = max(1, math.ceil(math.log(1 - recall) / math.log(1 - similarity ** rows)))
        if 1 - (1 - unlike ** rows) ** bands <= most:
            found.append((bands * rows, bands, rows))
    return min(found)[1:]


def shingle_hashes(words: list[bytes], size: int = SHINGLE) -> np.ndarray:
    joined, n = b" ".join(words), len(words)
    if n <= size:
        return np.array([xxhash.xxh64_intdigest(joined)], dtype=np.uint64)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=n) + 1
    ends = np.cumsum(sizes) - 1
    starts = ends - sizes + 1
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[s:e]) for s, e in zip(starts[:n - size + 1].tolist(), ends[size - 1:].tolist())),
                       dtype=np.uint64, count=n - size + 1)


def paragraphs(text: str | None, min_words: int) -> list[tuple[int, list[bytes]]]:
    """(line number, words) of the lines that are long enough."""
    found = [(i, words_of(line)) for i, line in enumerate((text or "").split("\n"))]
    return [(i, w) for i, w in found if len(w) >= min_words]


def signed(h: int) -> int:
    return h - (1 << 64) if h >= 1 << 63 else h


class MinHash:
    def __init__(self, bands: int, rows: int, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.bands, self.rows, n = bands, rows, bands * rows
        self.a = rng.integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        self.mix = rng.integers(1, 1 << 63, (bands, rows), dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def band_keys(self, hashes: list[np.ndarray]) -> np.ndarray:
        """(sets, bands): a key for each band of each set of shingle hashes."""
        flat = np.concatenate(hashes)
        starts = np.cumsum([0, *map(len, hashes[:-1])])
        keys = np.empty((len(hashes), self.bands), dtype=np.uint64)
        for band in range(self.bands):
            key = np.full(len(hashes), band + 1, dtype=np.uint64)
            for r in range(self.rows):
                k = band * self.rows + r
                least = np.minimum.reduceat((flat * self.a[k] + self.b[k]) >> np.uint64(32), starts)
                key = (key ^ least) * self.mix[band, r]
                key ^= key >> np.uint64(29)
            keys[:, band] = key
        return keys


def paragraph_table(docs: DataFrame, minhash: MinHash, min_words: int) -> DataFrame:
    """(a, b, doc_id, line, par, k0, k1, ...): every paragraph, its hash and band keys; a, b stand for the row."""
    keyed = docs.withColumn("row", row_key(F.col("doc_id"), F.col("text"))).select(
        F.col("row.a").alias("a"), F.col("row.b").alias("b"), "doc_id", "text")
    bands = [f"k{i}" for i in range(minhash.bands)]

    def tasks(batches):
        for batch in batches:
            rows, lines, pars, hashes = [], [], [], []
            for r, text in enumerate(batch.column(3)):
                for line, words in paragraphs(text.as_py(), min_words):
                    rows.append(r)
                    lines.append(line)
                    pars.append(signed(xxhash.xxh64_intdigest(b" ".join(words))))
                    hashes.append(shingle_hashes(words))
            if rows:
                keys = minhash.band_keys(hashes).view(np.int64)
                at = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(i).take(at) for i in range(3)], pa.array(lines, pa.int32()), pa.array(pars, pa.int64()),
                     *[pa.array(keys[:, i]) for i in range(minhash.bands)]], names=["a", "b", "doc_id", "line", "par", *bands])

    kind = keyed.schema["doc_id"].dataType.simpleString()
    return keyed.mapInArrow(tasks, f"a long, b long, doc_id {kind}, line int, par long, " + ", ".join(f"{k} long" for k in bands))


def candidate_groups(pars: DataFrame, bands: int) -> DataFrame:
    """(v, c): paragraphs that share a band with another, and their group."""
    names = [f"k{i}" for i in range(bands)]
    distinct = pars.groupBy("par").agg(*[F.first(k).alias(k) for k in names])  # equal paragraphs have equal bands
    keys = distinct.select("par", F.explode(F.array(*names)).alias("key"))
    hubs = cut(keys.groupBy("key").agg(F.min("par").alias("hub"), F.count("*").alias("n")).where("n > 1").drop("n"))
    ties = keys.join(small(hubs), "key").where("par <> hub").select(F.col("hub").alias("a"), F.col("par").alias("b")).distinct()
    return components(ties)


def verified_links(docs: DataFrame, pars: DataFrame, groups: DataFrame, min_words: int, similarity: float) -> DataFrame:
    """(a, b): links of at least ``similarity`` that connect the paragraphs of a group as all such links do."""
    groups = cut(groups)
    place = pars.select("par", "a", "b", "line").join(small(groups), F.col("par") == F.col("v")).groupBy("par").agg(
        F.min(F.struct("a", "b", "line")).alias("at"), F.first("c").alias("c"))
    wanted = cut(place.groupBy("at.a", "at.b").agg(F.collect_list(F.struct("at.line", "par", "c")).alias("lines")))
    key = row_key(F.col("doc_id"), F.col("text"))
    texts = docs.select(key["a"].alias("a"), key["b"].alias("b"), "text").join(small(wanted, SMALL_SIDE // 8), ["a", "b"])

    def tasks(batches):
        for batch in batches:
            out = []
            for text, lines in zip(batch.column(0), batch.column(1)):
                found = dict(paragraphs(text.as_py(), min_words))
                out += [(x["par"], x["c"], np.unique(shingle_hashes(found[x["line"]])).tobytes()) for x in lines.as_py()]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.binary()))],
                                             names=["par", "c", "shingles"])

    sets = cut(texts.select("text", "lines").mapInArrow(tasks, "par long, c long, shingles binary").dropDuplicates(["par"]))
    sizes = cut(sets.groupBy("c").agg(F.count("*").alias("n")))

    def jaccard(rows):
        each = [np.frombuffer(x, np.uint64) for x in rows["shingles"]]
        n = np.array([len(x) for x in each])
        flat, start = np.concatenate(each), np.cumsum(n) - n

        def near(i):
            mine, rest = each[i], flat[start[i + 1]:]
            hit = mine[np.minimum(np.searchsorted(mine, rest), len(mine) - 1)] == rest
            both = np.add.reduceat(hit, start[i + 1:] - start[i + 1], dtype=np.int64)
            return both >= similarity * (n[i] + n[i + 1:] - both)

        return near

    return spanning_links(sets.join(sizes, "c"), sets.count(), "c", "par", jaccard)


def removals(docs: DataFrame, min_words: int = MIN_WORDS, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """((a, b, n_paragraphs) of each text, (a, b, drop, kept_in) of the texts that lose paragraphs)."""
    python_tasks(docs.sparkSession)
    bands, rows = tune(similarity)
    pars = staged(paragraph_table(docs, MinHash(bands, rows), min_words), "paragraphs")
    classes = cut(components(verified_links(docs, pars, candidate_groups(pars, bands), min_words, similarity)))
    each = pars.select("a", "b", "doc_id", "line", "par").join(small(classes), F.col("par") == F.col("v"), "left").select(
        "a", "b", "doc_id", "line", F.coalesce("c", "par").alias("class")).distinct()
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "a", "b", "line")).alias("first")
    repeated = cut(each.groupBy("class").agg(first, F.count("*").alias("n")).where("n > 1").select(
        "class", F.col("first.doc_id").alias("kept"), F.col("first.a").alias("fa"), F.col("first.b").alias("fb"), F.col("first.line").alias("fl")))
    lost = each.join(small(repeated, SMALL_SIDE // 2), "class").where("a <> fa or b <> fb or line <> fl")
    drops = cut(lost.groupBy("a", "b").agg(F.sort_array(F.collect_set("line")).alias("drop"),
                                           F.sort_array(F.collect_set("kept")).alias("kept_in")))
    return each.groupBy("a", "b").agg(F.count("*").alias("n_paragraphs")), drops


def without_paragraphs(df: DataFrame, min_words: int, similarity: float) -> DataFrame:
    """(a, b, doc_id, n_paragraphs, n_removed, kept_in, text) of every row of ``df`` (doc_id, text)."""
    sizes, drops = removals(df, min_words, similarity)
    key = row_key(F.col("doc_id"), F.col("text"))
    kept = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains("drop", i)), "\n")
    keyed = df.withColumns({"a": key["a"], "b": key["b"]}).join(small(drops, SMALL_SIDE // 8), ["a", "b"], "left").select(
        "a", "b", "doc_id", F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("kept_in", F.array().cast(drops.schema["kept_in"].dataType)).alias("kept_in"),
        F.when(F.col("drop").isNull(), F.col("text")).otherwise(kept).alias("text"))
    return keyed.join(small(cut(sizes), SMALL_SIDE // 2), ["a", "b"], "left").select(
        "a", "b", "doc_id", F.coalesce("n_paragraphs", F.lit(0)).cast("long").alias("n_paragraphs"), "n_removed", "kept_in", "text")


def dedup_passages(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                   similarity: float = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, n_paragraphs, n_removed, kept_in (doc_ids that
    keep what it lost) and the text without the removed paragraphs."""
    return without_paragraphs(id_text(docs, id_col, text_col), min_words, similarity).drop("a", "b")


def dedup_text(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
               similarity: float = SIMILARITY) -> DataFrame:
    """The whole operator: ``dedup_passages``, then the verbatim passages that its
    lines do not show (see ``passages``). Columns as there; runs of words that go
    count in n_removed, and the documents that hold them are in kept_in."""
    left = staged(without_paragraphs(id_text(docs, id_col, text_col), min_words, similarity), "left")
    out = cut_windows(left, repeated_windows(left))
    return out.select("doc_id", "n_paragraphs", (F.col("n_removed") + F.col("n_cut")).alias("n_removed"),
                      F.array_sort(F.array_union("kept_in", "held_in")).alias("kept_in"), "text")
