"""Quality classifier (operator 5): a linear-chain conditional random field.

Every line of a text gets a hidden label, good or bad. A line's evidence are
its own features and those of the lines before and behind it (counts and shares
of characters and words, put into bins); neighbouring labels are coupled. The
forward-backward algorithm gives each line's marginal probability of being
good; their mean, weighted by the lines' lengths, is the document's quality,
and a logistic fit turns that into the score.

Training: the lines of a labelled document carry its label. The weights
maximise the conditional likelihood (Adam, with a small L2 term). It reads at
most about ``max_docs`` labelled documents, taken by a hash of doc_id, and then
of text where ids have several; equal rows teach once, and texts of more than
``max_lines`` lines teach nothing. Both bounds are parameters. Spark extracts the
features; the driver fits on them.

Long documents are scored whole. Documents of a batch are worked on side by
side, line by line, so the cost does not depend on how long a document is.

Defined cases: a NULL or empty text has one empty line and is scored like any
other; without labels every score is 0.5; if a doc_id has several labels, the
smallest counts; repeated rows get equal scores; language, source, ids and
other columns are never inputs; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import col, id_text, python_tasks

CUTS = (0.0, 0.005, 0.02, 0.05, 0.1, 0.2, 0.4, 0.6, 0.8)  # bins of a share: 0, up to 0.005, ..., over 0.8
BINS = len(CUTS) + 1
SYMBOLS, UPPER, DIGITS = b"#*$%&|<>", bytes(range(65, 91)), b"0123456789"
PUNCT, SHOUT = b".,;:'\"()-", b"!?"
NAMES = ("symbols", "upper", "digits", "punctuation", "shouts", "non_ascii", "spaces", "repeated", "length", "ended", "same")
K = len(NAMES)


def bins(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(lines, K) bins and the lines' lengths in characters."""
    shares, lengths, before = [], [], None
    for line in (text or "").split("\n"):
        b = line.encode("utf-8", "surrogatepass")
        n, w = max(1, len(b)), b.split()
        count = lambda chars: (len(b) - len(b.translate(None, chars))) / n
        shares.append((count(SYMBOLS), count(UPPER), count(DIGITS), count(PUNCT), count(SHOUT), 2 * (len(b) - len(line)) / n,
                       count(b" \t"), 1 - len(set(w)) / max(1, len(w)), min(1.0, math.log1p(len(w)) / 7),
                       float(b.rstrip()[-1:] in (b".", b"!", b"?", b":", b'"')), float(line == before)))
        lengths.append(len(line))
        before = line
    return np.searchsorted(CUTS, np.array(shares), side="left").astype(np.int8), np.array(lengths, dtype=np.int64)


class Chains:
    """Documents side by side: lines of the longest first, so that step t works on a leading block."""

    def __init__(self, docs: list[np.ndarray]):
        sizes = np.array([len(x) for x in docs])
        self.order = np.argsort(-sizes, kind="stable")
        self.sizes = sizes[self.order]
        self.docs, self.steps = len(docs), int(sizes.max()) if len(docs) else 0
        self.active = [int((self.sizes > t).sum()) for t in range(self.steps)]
        x = [docs[i].astype(np.int64) + np.arange(K) * BINS for i in self.order]
        absent = np.full((1, K), -1)
        near = [np.hstack([d, np.where((p := np.vstack([absent, d[:-1]])) < 0, p, p + K * BINS),
                           np.where((q := np.vstack([d[1:], absent])) < 0, q, q + 2 * K * BINS)]) for d in x]
        self.features = np.vstack(near) if near else np.zeros((0, 3 * K), np.int64)  # -1: no such line
        self.start = np.cumsum(self.sizes) - self.sizes

    def rows(self, t: int) -> np.ndarray:
        return self.start[:self.active[t]] + t

    def marginals(self, weights: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """(P(good) of each line, expected label pairs, log-partition). Label 1 is good;
        ``weights`` score good lines, ``pairs`` neighbouring labels."""
        padded = np.append(weights, 0.0)
        unary = np.zeros((len(self.features), 2))
        unary[:, 1] = padded[self.features].sum(axis=1)
        peak = unary.max(axis=1, keepdims=True)
        e, link = np.exp(unary - peak), np.exp(pairs)
        alpha, beta = np.zeros_like(e), np.ones_like(e)
        logz = float(peak.sum())
        for t in range(self.steps):
            r = self.rows(t)
            a = e[r] if t == 0 else e[r] * (alpha[r - 1] @ link)
            s = a.sum(axis=1, keepdims=True)
            logz += float(np.log(s).sum())
            alpha[r] = a / s
        both = np.zeros((2, 2))
        for t in range(self.steps - 1, 0, -1):
            r = self.rows(t)
            right = e[r] * beta[r]
            back = right @ link.T
            beta[r - 1] = back / back.sum(axis=1, keepdims=True)
            joint = alpha[r - 1][:, :, None] * link * right[:, None, :]
            both += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        p = alpha * beta
        return p[:, 1] / p.sum(axis=1), both, logz


class Model:
    def __init__(self):
        self.weights, self.pairs, self.slope, self.shift = np.zeros(3 * K * BINS), np.zeros((2, 2)), 0.0, 0.0

    def fit(self, docs: list[np.ndarray], lengths: list[np.ndarray], labels: np.ndarray, rounds: int = 150,
            longest: int = 64, decay: float = 1e-4) -> Model:
        """Long training documents are cut into chains of ``longest`` lines (all of them are used)."""
        cut = [(d[i:i + longest], y) for d, y in zip(docs, labels) for i in range(0, len(d), longest)]
        chains = Chains([d for d, _ in cut])
        y = np.repeat(np.array([y for _, y in cut])[chains.order], chains.sizes).astype(float)
        n, inside = max(1, len(y)), chains.features >= 0
        flat, lines = chains.features[inside], np.repeat(np.arange(len(y)), inside.sum(axis=1))
        same = np.zeros((2, 2))
        for d, label in cut:
            same[label, label] += len(d) - 1
        theta = [self.weights, self.pairs]
        first, second = [np.zeros_like(x) for x in theta], [np.zeros_like(x) for x in theta]
        for k in range(1, rounds + 1):
            p, both, _ = chains.marginals(*theta)
            grads = [np.bincount(flat, (p - y)[lines], len(self.weights)) / n + decay * theta[0], (both - same) / n + decay * theta[1]]
            for i, g in enumerate(grads):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.99 * second[i] + 0.01 * g * g
                theta[i] = theta[i] - 0.1 * (first[i] / (1 - 0.9 ** k)) / (np.sqrt(second[i] / (1 - 0.99 ** k)) + 1e-8)
        self.weights, self.pairs = theta
        self.calibrate(self.quality(docs, lengths), np.asarray(labels, dtype=float))
        return self

    def calibrate(self, q: np.ndarray, y: np.ndarray) -> None:
        """Logistic regression of the labels on the quality, by Newton steps with a small ridge."""
        x, w = np.stack([q, np.ones_like(q)], axis=1), np.zeros(2)
        for _ in range(25):
            p = 1 / (1 + np.exp(-(x @ w)))
            hess = (x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(2)
            w = w + np.linalg.solve(hess, x.T @ (y - p) - 0.05 * w)
        self.slope, self.shift = map(float, w)

    def quality(self, docs: list[np.ndarray], lengths: list[np.ndarray]) -> np.ndarray:
        """Length-weighted mean marginal of the lines of each document."""
        if not docs:
            return np.zeros(0)
        chains = Chains(docs)
        p, _, _ = chains.marginals(self.weights, self.pairs)
        w = np.concatenate([lengths[i] for i in chains.order]) + 1.0
        out = np.zeros(len(docs))
        out[chains.order] = np.add.reduceat(p * w, chains.start) / np.add.reduceat(w, chains.start)
        return out

    def score(self, docs: list[np.ndarray], lengths: list[np.ndarray]) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * self.quality(docs, lengths) + self.shift)))


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_docs: int = 3000, max_lines: int = 2000) -> Model:
    """Fit on the labelled rows of ``docs`` that are not held out, at most about ``max_docs`` of at most ``max_lines`` lines."""
    python_tasks(docs.sparkSession)
    known = labels.select(col(labels, "doc_id").alias("doc_id"), col(labels, "quality").alias("quality")).where(
        "doc_id is not null and quality is not null").where(~held_out()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    n = known.count()
    def share(h, n):
        return F.shiftrightunsigned(h, 11) <= int(min(1.0, max_docs / max(1, n)) * (1 << 53))

    found = id_text(docs).join(known.where(share(F.xxhash64("doc_id"), n)), "doc_id").where(
        F.coalesce(F.size(F.split("text", "\n")), F.lit(1)) <= max_lines).withColumn("h", F.xxhash64("text", "doc_id"))
    ids = found.agg(F.count_distinct("doc_id").alias("ids"), F.count_distinct("doc_id", "h").alias("rows")).first()
    if ids["rows"] > ids["ids"]:  # ids with several texts
        found = found.where(share("h", ids["rows"]))
    rows = found.dropDuplicates(["doc_id", "h"]).select("text", "quality")

    def features(batches):
        for batch in batches:
            got = [bins(x.as_py()) for x in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x, _ in got], pa.binary()),
                                              pa.array([n.tolist() for _, n in got], pa.list_(pa.int64())), batch.column(1).cast(pa.int32())],
                                             names=["bins", "lengths", "quality"])

    got = rows.mapInArrow(features, "bins binary, lengths array<bigint>, quality int").collect()
    got.sort(key=lambda r: (r["bins"], r["quality"]))  # the order of tasks must not matter
    if not got:
        return Model()
    return Model().fit([np.frombuffer(r["bins"], np.int8).reshape(-1, K) for r in got],
                       [np.array(r["lengths"], dtype=np.int64) for r in got], np.array([int(r["quality"] > 0) for r in got]))


def scores(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", least: float = 0.3) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted (1 if score >= least)."""
    spark = docs.sparkSession
    python_tasks(spark)
    fitted = spark.sparkContext.broadcast(model)

    def tasks(batches):
        for batch in batches:
            got = [bins(x.as_py()) for x in batch.column(1)]
            s = fitted.value.score([x for x, _ in got], [n for _, n in got])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64())], names=["doc_id", "score"])

    df = id_text(docs, id_col, text_col)
    out = df.mapInArrow(tasks, f"doc_id {df.schema['doc_id'].dataType.simpleString()}, score double")
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"))
