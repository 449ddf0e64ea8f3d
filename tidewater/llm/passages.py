"""Verbatim passages, the second step of operator 8: runs of ``WINDOW`` words or
more that stand elsewhere too, whatever lines they stand in.

Words are those of ``paragraph_dedup``; line breaks, punctuation and case do not
count, so that wrapped, embedded and newly wrapped copies are all found.

1. Winnowing: of the hashes of all runs of ``GRAM`` words that a window of
   ``WINDOW`` words holds, the smallest is an anchor. Equal windows have equal
   anchors, so no repeat is missed; about one word in 13 is one. Anchors that
   stand in one place only are dropped by partial minima and maxima.
2. Around the others every window is hashed. Of equal windows the first stays
   (smallest doc_id, NULL last; then text hash, word); the words of the others
   are cut from their texts.

Every word that goes stands, with the words around it, in a place that stays or
in an earlier one. Within one document a window that overlaps an equal one (a
word repeated over and over) is no second passage. Two windows count as equal by
a 64-bit hash.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import SMALL_SIDE, cut, small, staged
from tidewater.llm.decontamination import WORD_BYTES, words_of

WINDOW, GRAM = 50, 25
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def run_hashes(words: list[bytes], size: int) -> np.ndarray:
    """A hash of each run of ``size`` words: polynomial sums of the words' hashes, mixed."""
    n = len(words)
    if n < size:
        return np.zeros(0, np.uint64)
    each = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, n)
    power = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, BASE, np.uint64)], dtype=np.uint64)
    back = np.cumprod(np.r_[np.uint64(1), np.full(n - size, INVERSE, np.uint64)], dtype=np.uint64)
    total = np.r_[np.uint64(0), np.cumsum(each * power, dtype=np.uint64)]
    h = (total[size:] - total[:n - size + 1]) * back
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def anchors(words: list[bytes], window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(place, hash) of the anchors."""
    h = run_hashes(words, gram)
    if len(words) < window:
        return np.zeros(0, np.int64), h[:0]
    at = np.unique(sliding_window_view(h, window - gram + 1).argmin(axis=1) + np.arange(len(words) - window + 1))
    return at, h[at]


def windows_at(words: list[bytes], wanted: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, hash, whether an equal one overlaps it) of the windows that hold a wanted anchor."""
    at, h = anchors(words, window, gram)
    near = np.zeros(len(words) + 1, np.int64)
    for p in at[np.isin(h, wanted)].tolist():
        near[max(0, p - window + gram)] += 1
        near[p + 1] -= 1
    first = np.flatnonzero(np.cumsum(near)[:max(0, len(words) - window + 1)])
    w = run_hashes(words, window)[first]
    order = np.lexsort((first, w))
    close = (w[order][1:] == w[order][:-1]) & (np.diff(first[order]) < window)
    return first, w, np.isin(w, w[order][1:][close])


def without_words(text: str, starts: list[int], window: int = WINDOW) -> tuple[str, int]:
    """``text`` without the words of the windows at ``starts``, and the number of runs that went."""
    raw = text.encode("utf-8", "surrogatepass")
    spans = [m.span() for m in re.finditer(rb"[^ ]+", raw.translate(WORD_BYTES))]
    runs: list[list[int]] = []
    for s in sorted(starts):
        if runs and s <= runs[-1][1]:
            runs[-1][1] = s + window
        else:
            runs.append([s, s + window])
    out, done = [], 0
    for lo, hi in runs:
        out.append(raw[done:spans[lo][0]])
        done = spans[hi - 1][1]
        between = raw[done:spans[hi][0] if hi < len(spans) else len(raw)]
        done += len(between) - len(re.split(rb"[\x20\x09-\x0D]", between)[-1])  # what opens the next word stays
    return b"".join([*out, raw[done:]]).decode("utf-8", "surrogatepass"), len(runs)


def repeated_windows(docs: DataFrame) -> DataFrame:
    """(a, b, starts, held_in): the windows that go from each text that loses any.
    ``docs`` has a, b (which stand for the row), doc_id and text."""

    def find(batches):
        for batch in batches:
            rows, hashes, more = [], [], []
            for r, text in enumerate(batch.column(2)):
                h, n = np.unique(anchors(words_of(text.as_py()))[1], return_counts=True)
                rows.append(np.full(len(h), r))
                hashes.append(h)
                more.append(n > 1)
            if rows:
                at = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(np.concatenate(hashes).view(np.int64)),
                                                  pa.array(np.concatenate(more))], names=["a", "b", "h", "more"])

    found = staged(docs.select("a", "b", "text").mapInArrow(find, "a long, b long, h long, more boolean"), "anchors")
    row = F.xxhash64("a", "b")
    often = cut(found.groupBy("h").agg(F.min(row).alias("lo"), F.max(row).alias("hi"), F.max("more").alias("more")).where(
        "lo <> hi or more").select("h"))
    wanted = cut(found.join(small(often), "h").groupBy("a", "b").agg(F.collect_set("h").alias("hs")))
    some = docs.select("a", "b", "doc_id", "text").join(small(wanted, SMALL_SIDE // 8), ["a", "b"])

    def hashed(batches):
        for batch in batches:
            rows, parts = [], []
            for r, (text, hs) in enumerate(zip(batch.column(3), batch.column(4))):
                parts.append(windows_at(words_of(text.as_py()), hs.values.to_numpy().view(np.uint64)))
                rows.append(np.full(len(parts[-1][0]), r))
            if rows:
                at, (first, w, own) = pa.array(np.concatenate(rows)), map(np.concatenate, zip(*parts))
                yield pa.RecordBatch.from_arrays([*[batch.column(i).take(at) for i in range(3)], pa.array(first.astype(np.int32)),
                                                  pa.array(w.view(np.int64)), pa.array(own)], names=["a", "b", "doc_id", "pos", "w", "own"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    windows = staged(some.select("a", "b", "doc_id", "text", "hs").mapInArrow(
        hashed, f"a long, b long, doc_id {kind}, pos int, w long, own boolean"), "windows")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "a", "b", "pos")).alias("first")
    repeated = cut(windows.groupBy("w").agg(first, F.count("*").alias("n")).where("n > 1").select(
        "w", F.col("first.doc_id").alias("held"), F.col("first.a").alias("fa"), F.col("first.b").alias("fb"), F.col("first.pos").alias("fp")))
    lost = windows.join(small(repeated, SMALL_SIDE // 2), "w").where("a <> fa or b <> fb or (pos <> fp and not own)")
    return cut(lost.groupBy("a", "b").agg(F.collect_set("pos").alias("starts"), F.collect_set("held").alias("held_in")))


def cut_windows(docs: DataFrame, drops: DataFrame) -> DataFrame:
    """``docs`` (with a, b and text) without the windows of ``drops``, with ``n_cut`` and ``held_in``."""
    small_drops, kind = small(drops, SMALL_SIDE // 8), drops.schema["held_in"].dataType
    hit = docs.join(small_drops, ["a", "b"])
    at, rest = hit.columns.index("text"), [c for c in hit.columns if c not in ("text", "starts")]

    def tasks(batches):
        for batch in batches:
            done = [without_words(t.as_py(), s.as_py()) for t, s in zip(batch.column(at), batch.column("starts"))]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest], pa.array([x[0] for x in done], pa.string()),
                                              pa.array([x[1] for x in done], pa.int64())], names=[*rest, "text", "n_cut"])

    shape = hit.select(*rest, "text", F.lit(0).cast("long").alias("n_cut")).schema
    clean = docs.join(small_drops, ["a", "b"], "left_anti").withColumns({"n_cut": F.lit(0).cast("long"), "held_in": F.array().cast(kind)})
    return hit.mapInArrow(tasks, shape).unionByName(clean)
