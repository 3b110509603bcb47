import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from colloquy.llm import maxent
from colloquy.llm.common import crc_mod


def corpus():
    rng = random.Random(8)
    left, right = ["alpha", "beta", "gamma"], ["eins", "zwei", "drei"]
    rows = []
    for i in range(300):
        side = left if i % 2 else right
        rows.append((i, " ".join(rng.choice(side) if rng.random() < 0.8 else f"{side[0][:2]}{rng.randint(0, 500)}" for _ in range(rng.randint(5, 60)))))
    return rows + [(1000, None), (1001, ""), (1002, "Alpha ALPHA never-seen-word É.")]


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + ["\0"]


@pytest.mark.parametrize("head_words", [5, 100_000])
def test_base_score_by_brute_force(spark, documents, head_words):
    rows = corpus()
    out = {r.doc_id: r for r in maxent.score(documents(*rows), crc_mod("doc_id", 5) == 1, head_words=head_words).collect()}
    count = Counter()
    for i, t in rows:
        if zlib.crc32(str(i).encode()) % 5 != 1:
            count.update(tokens(t))
    n, kinds = sum(count.values()), len(count)
    for i, t in rows:
        r, ts = out[i], tokens(t)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (zlib.crc32(str(i).encode()) % 5 == 1, len(ts), sum(count[w] > 0 for w in ts), n)
        assert r.base_score == pytest.approx(sum(math.log10((count[w] + 0.5) / (n + 0.5 * (kinds + 1))) for w in ts))
        assert r.score < 0


def test_held_out_texts_score_better_than_unigrams(documents):
    rows = [r for r in maxent.score(documents(*corpus()[:300]), crc_mod("doc_id", 5) == 1).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows) * 0.97


@pytest.mark.parametrize("n", [30, 2600])
def test_every_training_document_is_learned_from_once(documents, monkeypatch, n):
    learned, made, train, store = [], [], maxent.train, maxent.stored

    def storing(df):
        out = store(df)
        if "piece" in out.columns:
            learned.extend(np.frombuffer(bytes(r.change), np.float64)[0] for r in out.where("piece = -1").collect())
        return out

    def training(docs, head, **kwargs):
        made.append((head, train(docs, head, **kwargs)))
        return made[-1][1]

    monkeypatch.setattr(maxent, "stored", storing)
    monkeypatch.setattr(maxent, "train", training)
    own = min(n, 600)  # words that one document says
    maxent.score(documents(*[(i, f"only{i}" if i < own else "common") for i in range(n)]), F.lit(False))
    (head, weights), known = made[0], maxent.Words(made[0][0])
    assert sum(learned) == 2 * n
    assert {f"only{i}" for i in range(own)} <= set(head)
    _, _, words, _, item, _ = known.look_up([[f"only{i}" for i in range(own)]])
    assert weights.one[1 + item].any(1).all()


@pytest.mark.parametrize("head_words", [1, 3, 1000])
def test_two_texts_of_one_id_and_null_ids(documents, head_words):
    rows = [(None, "x x x"), (None, "y"), (5, "x z z q"), (5, "w " * 3000), (5, "x z z q"), (None, None), (7, "rare1 rare2 rare1"), (7, "")]
    docs = documents(*rows).withColumnRenamed("lang", "train").withColumnRenamed("source", "file").withColumnRenamed("n_chars", "row")
    fold = F.col("doc_id").eqNullSafe(7)
    out = maxent.score(docs, fold, head_words=head_words).collect()
    count = Counter(w for i, t in rows if i != 7 for w in tokens(t))
    n, kinds = sum(count.values()), len(count)
    want = sorted(((i, i == 7, len(ts := tokens(t)), sum(count[w] > 0 for w in ts), n, round(sum(math.log10((count[w] + 0.5) / (n + 0.5 * (kinds + 1))) for w in ts), 4)) for i, t in rows), key=str)
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in out), key=str) == want
    assert len({round(r.score, 6) for r in out}) >= 6 and all(r.score < 0 for r in out)


def test_repeated_rows_and_empty_table(spark, documents):
    docs = documents((1, "a b rare1"), (1, "a b rare1"), (2, "a b c"), (None, "x"))
    out = maxent.score(docs, crc_mod("doc_id", 5) == 1, head_words=2).collect()
    a, b = [r for r in out if r.doc_id == 1]
    assert len(out) == 4 and a == b and a.n_tokens == 4
    assert maxent.score(documents(), crc_mod("doc_id", 5) == 1).count() == 0


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(0)
    w = maxent.Weights(rng.normal(size=(maxent.ROWS1, maxent.SIDE)).astype(np.float32), rng.normal(size=(maxent.ROWS2 + maxent.SIDE, maxent.SIDE)).astype(np.float32))
    _, _, features = maxent._sequence(np.zeros(3, np.int64), np.array([5, 900, 130]), 1)
    everything = np.arange(maxent.ITEMS)
    for f in features:
        p = 10 ** w.log10(everything, np.repeat(f[None, :], maxent.ITEMS, 0))
        assert p.sum() == pytest.approx(1, abs=1e-4)


def test_shapes_are_in_range():
    assert all(0 <= maxent.shape(w) < maxent.SHAPES for w in ["", "a", "été,", "...", "日本", "x" * 1000, "\ud800"])
