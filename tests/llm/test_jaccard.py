"""The join against brute force, through every path: hubs, short lists, long lists in blocks."""

import random
import re

import numpy as np
import pytest

from colloquy.llm import jaccard


def shingles(text, k):
    ws = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(zip(*(ws[i:] for i in range(k)), strict=False)) if len(ws) >= k else frozenset([tuple(ws)] if ws else [])


def brute(rows, k, percent):
    sets = {}
    for i, t in rows:
        sets.setdefault(i, shingles(t, k))
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i in ids:
        for j in ids:
            both = len(sets[i] & sets[j])
            if i < j and both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i in ids}


def corpus(seed=1):
    """Families of near copies at all distances, shared passages, exact copies, short and empty texts."""
    rng = random.Random(seed)
    word = lambda: "w" + str(rng.randint(0, 3000))
    rows, passage = [], [word() for _ in range(30)]
    for _ in range(8):
        first = [word() for _ in range(rng.choice([25, 60, 120]))]
        for _ in range(rng.choice([2, 6, 25])):
            text = list(first)
            for _ in range(rng.randint(0, 5)):
                text[rng.randrange(len(text))] = word()
            rows.append(" ".join(text))
    for _ in range(30):
        own = [word() for _ in range(rng.choice([3, 10, 40]))]
        at = rng.randrange(len(own))
        rows.append(" ".join(own[:at] + passage + own[at:]))
    rows += ["", None, "a", "A", "a b", "a  b", "a b c", "A B\tC", " ".join(passage), " ".join(passage)]
    return list(enumerate(rows))


@pytest.mark.parametrize(("k", "percent", "small_list", "block"), [(3, 90, 48, 400_000), (3, 90, 2, 300), (5, 80, 3, 500), (2, 60, 1, 200)])
def test_brute_force(spark, documents, k, percent, small_list, block):
    rows = corpus(k)
    got = jaccard.jaccard_groups(documents(*rows), k=k, percent=percent, small_list=small_list, block=block, sketch_bits=10).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows, k, percent) and len(got) == len(rows)


def test_repeated_rows_empty_table_and_clashing_names(spark, documents):
    text = " ".join(f"w{i}" for i in range(40))
    docs = documents((7, text), (7, text), (3, text + " end"), (9, None), (None, text)).withColumnRenamed("lang", "component_id").withColumnRenamed("source", "token")
    docs = docs.withColumnRenamed("n_chars", "key")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_groups(docs).collect()), key=str)
    assert got == [(3, 39, 3), (7, 38, 3), (7, 38, 3), (9, 0, 9), (None, 38, 3)]
    assert jaccard.jaccard_groups(documents()).count() == 0


def test_rows_that_share_an_id_are_documents_of_their_own(documents):
    """By rows: each is a document, whatever its id; null ids too."""
    rng = random.Random(3)
    rows = [(rng.choice([1, 2, 3, 7, 20, None]) if rng.random() < 0.6 else 100 + i, t) for i, (_, t) in enumerate(corpus(5))]
    got = jaccard.jaccard_groups(documents(*rows), small_list=3, block=400, sketch_bits=10).collect()
    want = brute(list(enumerate(t for _, t in rows)), 3, 90)
    least = {}
    for i, (n, c) in want.items():
        if n and rows[i][0] is not None:
            least[c] = min(least.get(c, 1 << 60), rows[i][0])
    expected = sorted(((i, want[k][0], least.get(want[k][1]) if want[k][0] else i) for k, (i, _) in enumerate(rows)), key=str)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == expected
    assert len({r.group for r in got if r.group is not None}) == len({c for n, c in want.values() if n})


def test_many_near_copies_below_the_threshold(documents):
    """Long lists of several groups: families whose members are near each other, and families just not near enough."""
    rng = random.Random(8)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for family in range(6):
        first = [w if rng.random() < 0.88 else f"f{family}_{i}" for i, w in enumerate(base)]
        for _ in range(25):
            text = list(first)
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(60)] = f"x{rng.randint(0, 10**6)}"
            rows.append(" ".join(text))
    rows = list(enumerate(rows))
    for small_list, block in ((4, 500), (4, 10**6), (48, 2000)):
        got = jaccard.jaccard_groups(documents(*rows), k=2, percent=70, small_list=small_list, block=block, sketch_bits=8).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows, 2, 70)


def test_long_texts(documents):
    base = [f"w{i}" for i in range(30_000)]
    got = jaccard.jaccard_groups(documents((1, " ".join(base)), (2, " ".join(["x", *base[1:]])), (3, "solo " * 20_000))).collect()
    assert {r.doc_id: r.component_id for r in got} == {1: 1, 2: 1, 3: 3}


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 200), (200, 300), (150, 300)]
    random.Random(2).shuffle(edges)
    got = {r.node: r.component for r in jaccard.components(spark.createDataFrame(edges, "x long, y long")).collect()}
    assert got == {**dict.fromkeys(range(61), 0), **dict.fromkeys((100, 150, 200, 300), 100)}


def test_prefixes_share_enough():
    """The property that the join rests on, for random sets and any l."""
    rng = random.Random(5)
    sketch = np.array([rng.randint(0, 50) for _ in range(256)])
    for _ in range(300):
        universe = np.array(rng.sample(range(1 << 60), 60), dtype=np.uint64)
        a = np.unique(np.array(rng.sample(list(universe), rng.randint(1, 60)), dtype=np.uint64))
        b = np.unique(np.concatenate([a[: rng.randint(0, len(a))], np.array(rng.sample(list(universe), rng.randint(0, 3)), dtype=np.uint64)])) if rng.random() < 0.8 else a
        if not len(b):
            continue
        both = len(np.intersect1d(a, b))
        if 100 * both >= 80 * len(np.union1d(a, b)):
            (la, pa), (lb, pb) = jaccard.prefixes([(x, (x % np.uint64(7)).astype(np.int64)) for x in (a, b)], sketch, 80)
            shared = len(np.intersect1d(pa, pb))
            assert shared >= min(la, lb) >= 1
            common = -(-80 * (len(a) + len(b)) // 180)
            assert shared >= min(common - -(-80 * len(x) // 100) + ell for x, ell in ((a, la), (b, lb)))


def test_words_are_counted_in_all_documents(documents):
    docs = documents(*((i, f"Often w{i} often") for i in range(4000)), (None, None)).select("doc_id", "text")
    counts = jaccard._sketch(jaccard._first_pass(docs, 3, 10), 10)[1]
    assert counts.sum() == 12_000 and counts.max() >= 8000
    assert jaccard.word_scores(np.array([0, 1, 2, 1000])).tolist() == [0, 0, 1, 10]
