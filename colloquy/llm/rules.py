"""Quality rules: a base filter, and a calibrated logistic regression over hashed word and character n-grams.

Features are the relative frequencies of hashed words, word pairs and four-byte strings (case kept, one space between
words), each family in its own `2**BITS` buckets.  The weights are learned on a bounded sample of rows with `labels.quality`,
then two numbers scale the score to a probability on rows that the weights haven't seen.  A document is kept if it passes
the base rules and its probability of quality 1 is at least KEEP.

Rules: null and empty texts have no words and fail the base rules; with no labels, or labels of one kind only, the
verdict is the base rules' alone (probability 1).  Texts of any length are read whole, about two megabytes of text or one longer
text in memory at a time; an empty table gives an empty one.  Rows stay as they are, repeated ones too; columns beyond doc_id and
text are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import column, give_back, hash_words, mix64, shared, slices, table, words
from .labelled import sample

BITS = 13
FAMILIES = 3
KEEP = 0.3
MAX_ROWS = 3000
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
SYMBOLS = "#*$%&|<>"
SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, p_good double"


def repeat_words(ws: list[str]) -> int:
    """How many words stand in a window of three words that the text has twice or more."""
    if len(ws) < 4:
        return 0
    windows = list(zip(ws, ws[1:], ws[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    _, code = np.unique(pd.factorize(pd.Series(windows, dtype=object))[0], return_inverse=True)
    hit = np.bincount(code)[code] > 1
    covered = np.zeros(len(ws), np.bool_)
    for k in range(3):
        covered[k : k + len(hit)] |= hit
    return int(covered.sum())


def base(text: str | None, ws: list[str]) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    if not ws:
        return 0, 0, sum(map((text or "").count, SYMBOLS)), 0, 0
    lines = [line for line in text.split("\n") if line.strip(" \t\n\x0b\x0c\r")]
    return len(ws), sum(map(len, ws)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeat_words(ws)


def features(split: list[list[str]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each family (bucket, document) of every n-gram of texts given as words; none of them without words."""
    count = np.array([len(ws) for ws in split])
    doc = np.repeat(np.arange(len(split)), count)
    code, unique = pd.factorize(np.array([w for ws in split for w in ws], dtype=object))
    hashed = hash_words(list(unique))[code]
    shift = np.uint64(64 - BITS)
    pair = np.flatnonzero(doc[1:] == doc[:-1])
    pairs = mix64(hashed[pair] * np.uint64(3) + hashed[pair + 1])
    raw = [" ".join(ws).encode("utf-8", "replace") + b"   " for ws in split]
    size = np.array([len(r) for r in raw])
    flat = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint32)
    of = np.repeat(np.arange(len(split)), size)[:-3]
    own = np.flatnonzero(of == np.repeat(np.arange(len(split)), size)[3:])  # those that don't reach into the next text
    gram = flat[:-3] | flat[1:-2] << np.uint32(8) | flat[2:-1] << np.uint32(16) | flat[3:] << np.uint32(24)
    grams = (gram * np.uint32(2654435761)) >> np.uint32(32 - BITS)
    return [((hashed >> shift).astype(np.int64), doc), ((pairs >> shift).astype(np.int64), doc[pair]), (grams[own].astype(np.int64), of[own])]


@dataclass
class Model:
    weights: np.ndarray  # family by family
    bias: float
    slope: float = 1.0
    offset: float = 0.0

    def raw(self, split: list[list[str]]) -> np.ndarray:
        out = np.full(len(split), self.bias)
        for f, (bucket, doc) in enumerate(features(split)):
            n = np.bincount(doc, minlength=len(split))
            w = self.weights[f << BITS : f + 1 << BITS]
            out += np.bincount(doc, w[bucket], minlength=len(split)) / np.maximum(n, 1)
        return out

    def probability(self, split: list[list[str]]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.raw(split) + self.offset, -500, 500)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], label: np.ndarray, *, steps: int = 80, rate: float = 2.0, decay: float = 1e-6) -> Model | None:
    """Learn from sparse rows (bucket, relative frequency); a quarter of them calibrates.  None without both labels."""
    if len(set(label.tolist())) < 2:
        return None
    part = np.arange(len(rows)) % 4 == 3
    if len(set(label[part].tolist())) < 2 or len(set(label[~part].tolist())) < 2:
        part[:] = False
    learn = np.flatnonzero(~part)
    size = np.array([len(rows[i][0]) for i in learn])
    row = np.repeat(np.arange(len(learn)), size)
    bucket = np.concatenate([rows[i][0] for i in learn])
    value = np.concatenate([rows[i][1] for i in learn])
    y = label[learn].astype(float)
    # both labels weigh the same in all, so that a rare one is learned; calibration puts the rates back
    weight = np.where(y > 0, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9)) / len(y)
    w, bias, squares, bias_square = np.zeros(FAMILIES << BITS), 0.0, np.full(FAMILIES << BITS, 1e-12), 1e-12
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, value * w[bucket], len(learn)) + bias, -50, 50)))
        error = weight * (p - y)
        slope = np.bincount(bucket, value * error[row], len(w)) + decay * w
        squares += slope**2
        w -= rate * slope / np.sqrt(squares)
        bias_square += error.sum() ** 2
        bias -= 0.3 * error.sum() / np.sqrt(bias_square)
    model = Model(w, bias)
    check = np.flatnonzero(part) if part.any() else learn
    z = np.array([(rows[i][1] * w[rows[i][0]]).sum() + bias for i in check])
    scale = max(float(z.std()), 1e-9)
    x, y = np.stack([z / scale, np.ones(len(z))], 1), label[check].astype(float)
    n_good, n_bad = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (n_good + 1) / (n_good + 2), 1 / (n_bad + 2))  # Platt's targets
    ab = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ ab, -50, 50)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2), x.T @ (p - target) + 1e-3 * (ab - [1, 0]))
        ab -= np.clip(step, -2, 2)
        if abs(step).max() < 1e-9:
            break
    model.slope, model.offset = float(ab[0] / scale), float(ab[1])
    return model


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model | None:
    def run(batches):
        for batch in batches:
            for part in slices(batch, most=1_000_000):
                pairs = [(ws, y) for t, y in zip(column(part, "text"), column(part, "label"), strict=True) if (ws := words(t))]
                if not pairs:
                    continue
                found: list[list[np.ndarray]] = [[] for _ in pairs]
                for f, (bucket, doc) in enumerate(features([ws for ws, _ in pairs])):
                    key, n = np.unique(doc << BITS | bucket, return_counts=True)
                    at = np.searchsorted(key >> BITS, np.arange(len(pairs) + 1))
                    for d in range(len(pairs)):
                        k, c = key[at[d] : at[d + 1]], n[at[d] : at[d + 1]]
                        found[d] += [((k & (1 << BITS) - 1) + (f << BITS)).astype(np.uint16), (c / max(1, c.sum())).astype(np.float32)]
                buckets = [np.concatenate(x[0::2]).tobytes() for x in found]
                values = [np.concatenate(x[1::2]).tobytes() for x in found]
                yield pa.RecordBatch.from_arrays([pa.array([y for _, y in pairs], pa.int32()), pa.array(buckets, pa.binary()), pa.array(values, pa.binary())], ["label", "bucket", "value"])

    rows = sorted(sample(docs, labels, "quality", max_rows).mapInArrow(run, "label int, bucket binary, value binary").collect(), key=lambda r: (r.bucket, r.value))
    if not rows:
        return None
    sparse = [(np.frombuffer(r.bucket, np.uint16).astype(np.int64), np.frombuffer(r.value, np.float32)) for r in rows]
    return fit(sparse, np.array([r.label for r in rows]) > 0)


def judge(docs: DataFrame, model: Model | None, *, keep: float = KEEP) -> DataFrame:
    """The base counts and the verdict for every whole text of docs (doc_id, text)."""
    docs = docs.select("doc_id", "text")
    held = shared(docs.sparkSession, model)

    def run(batches):
        model = held.value
        for batch in batches:
            for part in slices(batch):
                texts = column(part, "text")
                split = [words(t) for t in texts]
                counts = np.array([base(t, ws) for t, ws in zip(texts, split, strict=True)], np.int64).reshape(-1, 5)
                p = np.where(counts[:, 0] > 0, 1.0, 0.0)
                some = np.flatnonzero(counts[:, 0] > 0)
                if model is not None and len(some):
                    p[some] = model.probability([split[i] for i in some])
                failed = (counts[:, 0] < MIN_WORDS) | (100 * counts[:, 4] > MAX_REPEAT_PERCENT * counts[:, 0])
                names = [c.split()[0] for c in SCHEMA.split(", ")]
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), *(pa.array(counts[:, k]) for k in range(5)), pa.array(failed), pa.array(~failed & (p >= keep)), pa.array(p)], names)
        give_back()

    return docs.mapInArrow(run, SCHEMA)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return judge(docs, train(docs, table(spark, sf_dir, "labels")))
