"""SimHash near-dedup (operator 10): segment-popcount embedding and a grid join.

Fingerprints: words of the whole text (A-Z lower-cased), ``shingle``-word
shingles with repeats, XXH64 with seed 42 of each; a bit is 1 if it is set in
more than half of the hashes. Two fingerprints link at ``max_bits`` differing
bits or fewer.

Embedding: a fingerprint is cut into 32 segments of 2 bits, each mapped to its
bit count 0, 1 or 2. The Manhattan distance of two such vectors never exceeds
the Hamming distance. Counts are written as 00, 01, 11, so the Manhattan
distance is the bit count of the XOR of two embeddings.

Grid: the segments are dealt into g groups, coordinates of a coarse grid. A
distance of at most ``max_bits`` leaves at least g - max_bits groups with equal
counts, so each vector goes to one cell for every choice of g - max_bits groups,
and vectors that can link meet in a cell. g follows from the number of
fingerprints, so that a cell holds few chance neighbours at any size; the result
is the same for every g. Within a cell the Manhattan distance discards, then the
Hamming distance decides, and a pair counts only in the first cell they share.
Cells that are large (groups of near copies) go by chunks, see ``links``.

Only distinct fingerprints are joined; documents follow by their fingerprint.

Defined cases: NULL, empty and blank texts have fingerprint zero and link with
each other like any other; fewer words than a shingle are one shingle; NULL
doc_ids never name a component unless all its rows have one; repeated rows are
members like others; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import cut, id_text, positional, python_tasks, staged
from tidewater.llm.components import components
from tidewater.llm.links import large_cells, spanning_links

SHINGLE, MAX_BITS, SEED = 4, 4, 42
SMALL = 64  # members of a cell that are joined pairwise
LOW = 0x5555555555555555
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """As a signed 64-bit number."""
    words = text.encode("utf-8", "surrogatepass").translate(LOWER).split() if text else []
    n = len(words)
    if not n:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if n <= shingle:
        h = np.array([digest(joined, SEED)], dtype=np.uint64)
    else:
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=n) + 1
        ends = np.cumsum(sizes) - 1
        starts = ends - sizes + 1
        h = np.fromiter((digest(joined[s:e], SEED) for s, e in
                         zip(starts[:n - shingle + 1].tolist(), ends[shingle - 1:].tolist())), dtype=np.uint64,
                        count=n - shingle + 1)
    ones = np.zeros(64, dtype=np.int64)
    for part in np.array_split(h, len(h) // 4096 + 1):
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(h), bitorder="little")
    return int(bits.view(np.int64)[0])


def with_fingerprint(df: DataFrame, at: int, shingle: int = SHINGLE, keep_text: bool = True) -> DataFrame:
    """``df`` (columns by position) with ``fp``, of its column number ``at``."""
    python_tasks(df.sparkSession)
    kept = [i for i in range(len(df.columns)) if keep_text or i != at]

    def tasks(batches):
        for batch in batches:
            fp = pa.array([fingerprint(x.as_py(), shingle) for x in batch.column(at)], pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in kept], fp], names=[*[f"c{i}" for i in kept], "fp"])

    return df.mapInArrow(tasks, df.select(*[f"c{i}" for i in kept], F.lit(0).cast("long").alias("fp")).schema)


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def embedding(fp: Column) -> Column:
    """32 counts of 2 bits each, 0, 1, 2 written as 00, 01, 11."""
    high = F.shiftrightunsigned(fp, 1)
    return fp.bitwiseOR(high).bitwiseAND(F.lit(LOW)).bitwiseOR(
        F.shiftleft(fp.bitwiseAND(high).bitwiseAND(F.lit(LOW)), 1))


def grid(n: int, max_bits: int) -> tuple[list[int], list[tuple[int, ...]]]:
    """(masks of the groups of segments, choices of groups that make a cell) for
    ``n`` vectors: the g that costs least in cell rows, which are shuffled, and
    chance neighbours, of which about 75 cost as much as a row to compare."""
    def cost(g: int) -> float:
        equal = g - max_bits
        return math.comb(g, equal) * (1 + n / 75 / 2 ** (0.6 * 64 * equal / g))

    g = min(range(max_bits + 1, max_bits + 8), key=cost)
    masks = [sum(3 << 2 * s for s in range(32) if s * g // 32 == j) for j in range(g)]
    return masks, list(itertools.combinations(range(g), g - max_bits))


def first_choice(a: str, b: str, masks: list[int], choices: list[tuple[int, ...]]) -> Column:
    """Number of the first cell choice in which embeddings ``a`` and ``b`` agree."""
    diff = F.col(a).bitwiseXOR(F.col(b))
    out = F.lit(None).cast("int")
    for k, groups in reversed(list(enumerate(choices))):
        out = F.when(diff.bitwiseAND(F.lit(signed(sum(masks[j] for j in groups)))) == 0, F.lit(k)).otherwise(out)
    return out


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): links that connect the distinct fingerprints ``fp`` as all links do."""
    masks, choices = grid(max(1, fps.count()), max_bits)
    vectors = fps.select("fp", embedding(F.col("fp")).alias("e"))
    cells = vectors.select("fp", "e", F.explode(F.array(*[
        F.struct(F.lit(k).alias("k"), F.col("e").bitwiseAND(F.lit(signed(sum(masks[j] for j in c)))).alias("at"))
        for k, c in enumerate(choices)])).alias("cell")).select("fp", "e", "cell.k", "cell.at",
                                                               F.xxhash64("cell.k", "cell.at").alias("key"))
    large = cut(large_cells(cells, "key", SMALL))
    few = cells.join(large, "key", "left_anti")
    x, y = few.select("key", "k", F.col("fp").alias("a"), F.col("e").alias("ea")), \
        few.select("key", F.col("fp").alias("b"), F.col("e").alias("eb"))
    xor = lambda p, q: F.bit_count(F.col(p).bitwiseXOR(F.col(q)))
    near = (F.col("a") < F.col("b")) & (xor("ea", "eb") <= max_bits) & (xor("a", "b") <= max_bits) \
        & (first_choice("ea", "eb", masks, choices) == F.col("k"))
    pairs = x.withColumnRenamed("key", "kx").join(y, (F.col("kx") == F.col("key")) & near).select("a", "b")

    def hamming(rows):
        fp = rows["fp"].to_numpy()
        return lambda i: np.bitwise_count((fp[i + 1:] ^ fp[i]).view(np.uint64)) <= max_bits

    total = large.agg(F.sum("n")).first()[0] or 0
    return pairs.unionByName(spanning_links(cells.join(large, "key"), total, "key", "fp", hamming))


def fingerprint_classes(rows: DataFrame, first: Column, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, first): the least ``first`` of the component of each fingerprint in ``rows``."""
    fps = cut(rows.groupBy("fp").agg(F.min(first).alias("first")))
    joined = fps.join(components(fingerprint_links(fps, max_bits)), F.col("fp") == F.col("v"), "left")
    classes = cut(joined.select("fp", "first", F.coalesce("c", "fp").alias("c")))
    least = classes.groupBy("c").agg(F.min("first").alias("least"))
    return classes.join(least, "c").select("fp", F.col("least").alias("first"))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (the
    smallest doc_id that links reach)."""
    rows = cut(with_fingerprint(positional(id_text(docs, id_col, text_col)), 1, shingle, keep_text=False))
    classes = fingerprint_classes(rows, F.col("c0"), max_bits)
    return rows.join(classes, "fp").select(F.col("c0").alias("doc_id"),
                                           F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                                           F.col("first").alias("component_id"))


def drop_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                         max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs``, columns as they are, one of each component: the one
    with the smallest doc_id (NULL last), of equal ids one row."""
    i, t = docs.columns.index(id_col), docs.columns.index(text_col)
    rows = staged(with_fingerprint(positional(docs), t, shingle).withColumn("uid", F.monotonically_increasing_id()), "simhash")
    light = rows.select("fp", "uid", F.col(f"c{i}").alias("id"))
    first = F.struct(F.col("id").isNull(), F.col("id"), F.col("uid"))
    kept = fingerprint_classes(light, first, max_bits).select(F.col("first.uid").alias("uid")).distinct()
    return rows.join(kept, "uid", "left_semi").select(*[f"c{j}" for j in range(len(docs.columns))]).toDF(*docs.columns)
