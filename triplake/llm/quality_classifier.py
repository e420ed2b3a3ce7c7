"""Operator 8, quality classifier: histogram gradient-boosted trees over document statistics.

Statistics come from the text alone. Training takes a bounded sample of labelled rows (``SAMPLE`` documents with
the smallest hash of their id, a documented limit of the fit only), bins every statistic at its quantiles and
grows trees of fixed depth on gradient histograms. The trees are flattened into arrays (statistic, threshold,
leaf value by heap position), and a batch of documents walks all trees at once by numpy indexing. Scoring
covers every row.

Defined results: null or empty text is a vector of zeros and is scored like any other; labels with a null id or
quality are left out, a document labelled several times counts by its mean label; without labels of both kinds
the score is the smoothed share of label 1 for every document; null ids are never held out; equal rows get equal
scores; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_batches, remainder

SAMPLE = 20_000
FOLDS = 5
THRESHOLD = 0.3
TREES, DEPTH, BINS, RATE, RIDGE = 60, 4, 48, 0.2, 2.0
STATISTICS = ("n_words", "mean_word", "unique_share", "adjacent_equal", "repeat_window", "upper", "digits", "symbols",
              "pipes", "marks", "stops", "other_punct", "non_ascii", "lines", "dup_lines", "mean_line", "top_word")
_SYMBOLS, _MARKS = b"#*$%&<>^~=_\\", b"!?"


def statistics(text: str | None) -> list[float]:
    if not text:
        return [0.0] * len(STATISTICS)
    data = text.encode()
    hist = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    body = max(1, int(hist[33:].sum()))
    words = data.split()
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    ids: dict[bytes, int] = {}
    seq = np.array([ids.setdefault(w, len(ids)) for w in words], np.uint64)
    repeat = 0.0
    if n >= 6:
        mul = np.uint64(0x9E3779B97F4A7C15)
        h = seq[:-2] * mul * mul + seq[1:-1] * mul + seq[2:]
        repeat = 1 - len(np.unique(h)) / len(h)
    lines = [x for x in data.split(b"\n") if x]
    share = lambda chars: float(hist[list(chars)].sum()) / body
    return [np.log1p(n), body / n, len(ids) / n ** 0.85, sum(map(eq, words, words[1:])) / n, repeat,
            float(hist[65:91].sum()) / body, float(hist[48:58].sum()) / body, share(_SYMBOLS), share(b"|"),
            share(_MARKS), share(b".,;:"), share(b"'\"()[]{}/-+@`"), float(hist[128:].sum()) / body,
            np.log1p(len(lines)), 1 - len(set(lines)) / max(1, len(lines)), np.log1p(n / max(1, len(lines))),
            float(np.bincount(seq.astype(np.int64)).max()) / n]


def _matrix(texts: list[str | None]) -> np.ndarray:
    return np.array([statistics(t) for t in texts], np.float64).reshape(-1, len(STATISTICS))


class Trees:
    """Trees as arrays by heap position: ``stat`` and ``cut`` of the inner nodes, ``leaf`` values."""

    def __init__(self, bias: float, stat: np.ndarray, cut: np.ndarray, leaf: np.ndarray):
        self.bias, self.stat, self.cut, self.leaf = bias, stat, cut, leaf

    def score(self, x: np.ndarray) -> np.ndarray:
        trees, inner = self.stat.shape
        if not trees or not len(x):
            return np.full(len(x), 1 / (1 + np.exp(-self.bias)))
        at = np.zeros((len(x), trees), np.int64)
        rows, cols = np.arange(len(x))[:, None], np.arange(trees)[None, :]
        while at[0, 0] < inner:
            at = 2 * at + 1 + (x[rows, self.stat[cols, at]] > self.cut[cols, at])
        return 1 / (1 + np.exp(-(self.bias + self.leaf[cols, at - inner].sum(axis=1))))


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Gradient-boosted trees for logistic loss."""
    n, d = x.shape
    bias = float(np.log((y.sum() + 1) / (n - y.sum() + 1)))
    inner = 2 ** DEPTH - 1
    if n == 0 or y.min() == y.max():
        return Trees(bias, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(d)]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    stat, cut = np.zeros((TREES, inner), np.int64), np.full((TREES, inner), np.inf)
    leaf = np.zeros((TREES, inner + 1))
    margin = np.full(n, bias)
    for t in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(n, np.int64)
        for level in range(DEPTH):
            first, size = 2 ** level - 1, 2 ** level
            key = (node - first) * BINS
            best = np.zeros(size)
            total_g, total_h = np.bincount(node - first, g, size), np.bincount(node - first, h, size)
            base = total_g ** 2 / (total_h + RIDGE)
            for j in range(d):
                gl = np.bincount(key + binned[:, j], g, size * BINS).reshape(size, BINS).cumsum(1)[:, :-1]
                hl = np.bincount(key + binned[:, j], h, size * BINS).reshape(size, BINS).cumsum(1)[:, :-1]
                gr, hr = total_g[:, None] - gl, total_h[:, None] - hl
                gain = gl ** 2 / (hl + RIDGE) + gr ** 2 / (hr + RIDGE) - base[:, None]
                gain[:, len(cuts[j]):] = 0
                gain[(hl < 1) | (hr < 1)] = 0
                k = gain.argmax(1)
                top = gain[np.arange(size), k]
                for q in np.flatnonzero(top > best + 1e-9):
                    best[q], stat[t, first + q], cut[t, first + q] = top[q], j, cuts[j][k[q]]
            node = 2 * node + 1 + (x[np.arange(n), stat[t, node]] > cut[t, node])
        at = node - inner
        leaf[t] = -RATE * np.bincount(at, g, inner + 1) / (np.bincount(at, h, inner + 1) + RIDGE)
        margin += leaf[t, at]
    return Trees(bias, stat, cut, leaf)


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(x, y) of the sampled labelled documents outside the held-out fold."""
    arrow_batches(docs.sparkSession)
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (
        remainder(F.col("doc_id"), FOLDS) != 0))
    known = known.groupBy("doc_id").agg(F.avg("quality").alias("y"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)

    def run(batches):
        for b in batches:
            x = _matrix(b.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.float64())), b.column(1), b.column(2)],
                                             ["x", "y", "doc_id"])

    # the sample is SAMPLE rows of 16 bytes at most: safe to send to every task
    picked = docs.select("text", "doc_id").join(F.broadcast(sample), "doc_id").select(
        "text", "y", F.col("doc_id").cast("bigint").alias("doc_id"))
    return picked.mapInArrow(run, "x array<double>, y double, doc_id bigint")


def train(docs: DataFrame, labels: DataFrame) -> Trees:
    # at most one row for each sampled id reaches the driver
    rows = training_rows(docs, labels).groupBy("doc_id").agg(F.min(F.struct("x", "y")).alias("r")).select(
        "doc_id", "r.x", "r.y").toArrow().to_pydict()
    order = np.argsort(np.array(rows["doc_id"], np.int64), kind="stable")
    x = np.array(rows["x"], np.float64).reshape(-1, len(STATISTICS))[order]
    return fit(x, (np.array(rows["y"], np.float64)[order] >= 0.5).astype(np.float64))


def score(docs: DataFrame, model: Trees, *keep: str) -> DataFrame:
    """``keep`` columns and ``score``."""
    arrow_batches(docs.sparkSession)
    source = docs.select(*keep, docs["text"].alias("__text"))

    def run(batches):
        for b in batches:
            s = model.score(_matrix(b.column("__text").to_pylist()))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(s, pa.float64())],
                                             [*b.schema.names[:-1], "__score"])

    kept = source.drop("__text").schema.fields
    return source.mapInArrow(run, T.StructType([*kept, T.StructField("__score", T.DoubleType())]))
