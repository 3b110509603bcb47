"""Quality rules and the tree classifier."""

import random
from collections import Counter

import numpy as np

from colloquy.llm import boosting, rules


def prose(rng, n=80):
    return " ".join(rng.choice(["the", "and", "of", "river", "stone", "walks", "light"]) + str(rng.randint(0, 10**6)) + rng.choice(["", ".", ","]) for _ in range(n))


def junk(rng, n=80):
    return " ".join(rng.choice(["###", "buy!!", "$$$", "|"]) + str(rng.randint(0, 10**6)) for _ in range(n))


def corpus():
    rng = random.Random(5)
    rows = [(i, prose(rng) if i % 2 else junk(rng)) for i in range(160)]
    return rows, [(i, i % 2, 0) for i in range(120)]


def slow_counts(text):
    ws = rules.words(text)
    windows = Counter(tuple(ws[i : i + 3]) for i in range(len(ws) - 2))
    hit = {i + k for i in range(len(ws) - 2) if windows[tuple(ws[i : i + 3])] > 1 for k in range(3)}
    lines, seen, duplicates = (text or "").split("\n"), set(), 0
    for line in lines:
        if rules.words(line):
            duplicates += line in seen
            seen.add(line)
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text or ""), duplicates, len(hit)


def test_base_counts():
    rng = random.Random(1)
    texts = [None, "", " \n\t", "a b c a b c", "x\nx\n\n\nx y\nx", "é b c\x0bd # %", "a a a a a"] + ["".join(rng.choice("ab \n#") for _ in range(rng.randint(0, 80))) for _ in range(300)]
    for t in texts:
        assert rules.base(t, rules.words(t)) == slow_counts(t), t


def test_rules_query(spark, folder):
    rows, labels = corpus()
    extra = [(500, None), (501, ""), (502, "short text"), (503, "one two three " * 40), (504, rows[1][1]), (504, rows[1][1])]
    out = {r.doc_id: r for r in rules.op3_quality_rules(spark, folder(rows + extra, labels)).collect()}
    held_out = range(120, 160)
    assert all(out[i].kept == (i % 2 == 1) for i in held_out)
    assert not out[500].kept and out[500].base_failed and out[501].n_words == 0 and out[503].base_failed and out[504].kept


def test_rules_without_labels(spark, folder):
    rows, _ = corpus()
    assert all(r.kept != r.base_failed for r in rules.op3_quality_rules(spark, folder(rows)).collect())


def test_trees_query(spark, folder):
    rows, labels = corpus()
    extra = [(500, None), (501, ""), (502, "x" * 200_000)]
    out = {r.doc_id: r for r in boosting.op5_quality_trees(spark, folder(rows + extra, labels)).collect()}
    assert all(out[i].predicted == i % 2 == int(out[i].score >= 0.3) for i in range(120, 160))
    assert out[500].score == out[501].score and all(0 <= r.score <= 1 for r in out.values())
    assert any(r.held_out for r in out.values()) and not all(r.held_out for r in out.values())


def test_trees_without_or_with_one_label(spark, folder, documents):
    docs = documents((1, "a"), (2, None))
    none = boosting.train(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r.predicted for r in boosting.classify(docs, none).collect()} == {1}
    zero = boosting.train(docs, spark.createDataFrame([(1, 0)], "doc_id long, quality int"))
    assert len(boosting.classify(docs, zero).collect()) == 2


def test_traversal_equals_walking():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 6))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    trees = boosting.grow(x, y, trees=12)
    assert ((trees.score(x) > 0.5) == y).mean() > 0.9
    for row, got in zip(x[:50], trees.score(x[:50]), strict=True):
        z = trees.start
        for t in range(len(trees.feature)):
            node = 0
            for _ in range(boosting.DEPTH):
                node = 2 * node + 1 + (row[trees.feature[t, node]] > trees.threshold[t, node])
            z += trees.leaf[t, node - trees.feature.shape[1]]
        assert np.isclose(got, 1 / (1 + np.exp(-z)))


def test_verdict_by_brute_force(documents, spark):
    """Each text alone, n-grams counted in dictionaries, against texts judged together."""
    from colloquy.llm.common import hash_words, mix64

    rows, labels = corpus()
    docs = documents(*rows)
    model = rules.train(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = {r.doc_id: r for r in rules.judge(docs, model).collect()}
    for i, text in rows[:40]:
        ws = text.split()
        h = [int(x) for x in hash_words(ws)]
        raw = " ".join(ws).encode() + b"   "
        families = [
            [x >> 51 for x in h],
            [int(mix64(np.array([(a * 3 + b) % 2**64], np.uint64))[0]) >> 51 for a, b in zip(h, h[1:], strict=False)],
            [int.from_bytes(raw[k : k + 4], "little") * 2654435761 % 2**32 >> 19 for k in range(len(raw) - 3)],
        ]
        z = model.bias
        for f, grams in enumerate(families):
            for bucket, n in Counter(grams).items():
                z += model.weights[(f << rules.BITS) + bucket] * n / len(grams)
        p = 1 / (1 + np.exp(-(model.slope * z + model.offset)))
        assert np.isclose(got[i].p_good, p) and got[i].kept == (not got[i].base_failed and p >= 0.3)


def test_growing_finds_the_best_splits():
    """The first tree's first two levels against every split tried."""
    rng = np.random.default_rng(4)
    x = rng.integers(0, 12, (120, 4)).astype(float)
    y = ((x[:, 1] > 5) ^ (x[:, 2] > 8)).astype(float)
    trees = boosting.grow(x, y, trees=1, least=0.5)
    share = (y.sum() + 0.5) / (len(y) + 0.5)
    g, h = y - share, np.full(len(y), share * (1 - share))

    def best(rows):
        top = 0.0
        for k in range(4):
            for cut in np.unique(x[:, k]):
                left = rows & (x[:, k] <= cut)
                right = rows & ~left
                if min(h[left].sum(), h[right].sum()) >= 0.5:
                    top = max(top, g[left].sum() ** 2 / (h[left].sum() + 1) + g[right].sum() ** 2 / (h[right].sum() + 1))
        return top

    def own(rows, node):
        left = rows & (x[:, trees.feature[0, node]] <= trees.threshold[0, node])
        right = rows & ~left
        return left, right, g[left].sum() ** 2 / (h[left].sum() + 1) + g[right].sum() ** 2 / (h[right].sum() + 1)

    every = np.ones(len(y), bool)
    left, right, gain = own(every, 0)
    assert np.isclose(gain, best(every))
    for rows, node in ((left, 1), (right, 2)):
        assert np.isclose(own(rows, node)[2], best(rows))


def test_clashing_names_long_texts_and_empty_tables(spark, documents):
    rows, labels = corpus()
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = documents(*rows, (900, "river stone " * 60_000), (900, "another text"), (None, None)).withColumnRenamed("lang", "label").withColumnRenamed("source", "score").withColumnRenamed("n_chars", "quality")
    judged = rules.judge(docs, rules.train(docs, labels)).collect()
    assert len(judged) == len(rows) + 3 and next(r for r in judged if r.n_words == 120_000).base_failed
    classified = boosting.classify(docs, boosting.train(docs, labels)).collect()
    assert len(classified) == len(rows) + 3 and all(0 <= r.score <= 1 for r in classified)
    assert rules.judge(documents(), None).count() == 0 and boosting.classify(documents(), boosting.train(documents(), labels)).count() == 0
