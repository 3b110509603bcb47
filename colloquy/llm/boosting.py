"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics come from a byte histogram, the words and the lines of the whole text.  Trees are grown level by level on
quantile bins of a bounded labelled sample, with logistic loss; all have the same depth, so that the ensemble is three
flat arrays, and a batch goes down all trees together by index arithmetic.  score is the ensemble's probability of
label 1; predicted is 1 from `cut` on.

Rules: null and empty texts have all statistics zero and get the score that follows from them; with no labels, or labels
of one kind, every score is that kind's share (1 without labels).  Texts of any length are read whole, about two megabytes of text
or one longer text in memory at a time; an empty table gives an empty one.  Rows stay as they are, repeated ones too; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column, crc_mod, give_back, shared, slices, table, words
from .labelled import sample

MAX_ROWS = 8000
CUT = 0.3
TREES, DEPTH, BINS, RATE = 60, 4, 64, 0.15
SCHEMA = "doc_id long, score double, predicted int"
_CLASSES = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:", b"!?", b"|", b"#*$%&<>", b"\"'()[]{}", b"@=_+-/\\", b"\n", b" ", bytes(range(128, 256))]
_CLASS = np.zeros((256, len(_CLASSES)))
for _k, _bytes in enumerate(_CLASSES):
    _CLASS[list(_bytes), _k] = 1


def statistics(texts: list[str | None]) -> np.ndarray:
    """A row of document statistics per text."""
    histogram = np.zeros((len(texts), 256))
    rest = np.zeros((len(texts), 12))
    for i, text in enumerate(texts):
        if not text:
            continue
        histogram[i] = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
        ws = words(text)
        if not ws:
            continue
        n, kinds = len(ws), set(ws)
        lengths = np.fromiter(map(len, ws), np.int64, n)
        lines = [line for line in text.split("\n") if line.strip()]
        ends = sum(line.rstrip()[-1] in ".!?:;\"'" for line in lines)
        rest[i] = [
            np.log1p(n), lengths.mean(), lengths.std(), lengths.max(), (lengths <= 3).mean(), len(kinds) / n,
            sum(w.istitle() for w in ws) / n, sum(w.isalpha() for w in ws) / n, len(lines), n / max(1, len(lines)),
            1 - len(set(lines)) / max(1, len(lines)), ends / max(1, len(lines)),
        ]
    total = histogram.sum(1, keepdims=True)
    shares = histogram @ _CLASS / np.maximum(total, 1)
    p = histogram / np.maximum(total, 1)
    entropy = -(p * np.log2(np.where(p > 0, p, 1))).sum(1, keepdims=True)
    return np.concatenate([shares, rest, entropy], 1)


@dataclass
class Trees:
    """Complete trees: node k's children are 2k+1 (value up to the threshold) and 2k+2."""

    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray
    leaf: np.ndarray  # trees x leaves
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        if self.feature.size:
            tree = np.arange(len(self.feature))[None, :]
            row = np.arange(len(x))[:, None]
            node = np.zeros((len(x), len(self.feature)), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[row, self.feature[tree, node]] > self.threshold[tree, node])
            out += self.leaf[tree, node - self.feature.shape[1]].sum(1)
        return 1 / (1 + np.exp(-out))


def grow(x: np.ndarray, y: np.ndarray, *, trees: int = TREES, rate: float = RATE, least: float = 2.0) -> Trees:
    """Boost on rows x with labels y (0 or 1); least is the smallest sum of second derivatives in a leaf."""
    n, f = x.shape if len(x) else (0, 0)
    share = (y.sum() + 0.5) / (len(y) + 0.5) if len(y) else 1 - 1e-9
    share = min(max(float(share), 1e-6), 1 - 1e-9)
    start = float(np.log(share / (1 - share)))
    if not n or y.min() == y.max():
        return Trees(np.zeros((0, 0), np.int64), np.zeros((0, 0)), np.zeros((0, 0)), start)
    edges = np.stack([np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1]) for k in range(f)])
    binned = np.stack([np.searchsorted(edges[k], x[:, k], side="left") for k in range(f)], 1)
    inner, leaves = (1 << DEPTH) - 1, 1 << DEPTH
    feature, threshold, leaf = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves))
    z = np.full(n, start)
    place = binned + np.arange(f) * BINS
    for t in range(trees):
        p = 1 / (1 + np.exp(-z))
        g, h = y - p, p * (1 - p)
        node = np.zeros(n, np.int64)
        for depth in range(DEPTH):
            first, width = (1 << depth) - 1, 1 << depth
            at = ((node - first)[:, None] * (f * BINS) + place).ravel()
            shape = (width, f, BINS)
            left_g = np.bincount(at, np.repeat(g, f), width * f * BINS).reshape(shape).cumsum(2)
            left_h = np.bincount(at, np.repeat(h, f), width * f * BINS).reshape(shape).cumsum(2)
            all_g, all_h = left_g[:, :, -1:], left_h[:, :, -1:]
            right_g, right_h = all_g - left_g, all_h - left_h
            gain = left_g**2 / (left_h + 1) + right_g**2 / (right_h + 1) - all_g**2 / (all_h + 1)
            gain[(left_h < least) | (right_h < least)] = 0
            best = gain[:, :, :-1].reshape(width, -1).argmax(1)
            useful = gain[:, :, :-1].reshape(width, -1).max(1) > 1e-9
            k, b = best // (BINS - 1), best % (BINS - 1)
            feature[t, first : first + width] = k
            threshold[t, first : first + width] = np.where(useful, edges[k, b], np.inf)
            own = node - first
            node = 2 * node + 1 + ((binned[np.arange(n), k[own]] > b[own]) & useful[own])
        own = node - inner
        leaf[t] = rate * np.bincount(own, g, leaves) / (np.bincount(own, h, leaves) + 1)
        z += leaf[t, own]
    return Trees(feature, threshold, leaf, start)


def train(docs: DataFrame, labels: DataFrame, fold: Column | None = None, max_rows: int = MAX_ROWS) -> Trees:
    """Learn from about max_rows labelled rows where fold holds."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                x = statistics(column(part, "text"))
                yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index("label")), pa.array(list(x), pa.list_(pa.float64()))], ["label", "x"])

    rows = sorted((tuple(r.x), r.label) for r in sample(docs, labels, "quality", max_rows, fold).mapInArrow(run, "label int, x array<double>").collect())
    x = np.array([r[0] for r in rows]) if rows else np.zeros((0, 0))
    return grow(x, (np.array([r[1] for r in rows]) > 0).astype(float))


def classify(docs: DataFrame, trees: Trees, *, cut: float = CUT) -> DataFrame:
    docs = docs.select("doc_id", "text")
    held = shared(docs.sparkSession, trees)

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                p = held.value.score(statistics(column(part, "text")))
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), pa.array(p), pa.array((p >= cut).astype(np.int32))], ["doc_id", "score", "predicted"])
        give_back()

    return docs.mapInArrow(run, SCHEMA)


def op5_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    trees = train(docs, table(spark, sf_dir, "labels"), crc_mod("doc_id", 5) != 0)
    return classify(docs, trees).select("doc_id", (crc_mod("doc_id", 5) == F.lit(0)).alias("held_out"), "score", "predicted")
