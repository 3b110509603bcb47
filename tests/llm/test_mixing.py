"""Schedules: windows, deviations, wholeness."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from colloquy.llm import mixing


def corpus(n=400, sources=5):
    rng = random.Random(4)
    return [(i, "x" * rng.choice([0, 10, 500, 2500]), "en", f"s{min(int(rng.expovariate(0.5)), sources - 1)}") for i in range(n)]


def test_every_document_once_within_its_window(documents):
    docs = documents(*corpus())
    rows = mixing.schedule(docs, block_chars=1000).collect()
    assert sorted(r.doc_id for r in rows) == list(range(400))
    assert all(r.release <= r.slot < r.deadline for r in rows)
    blocks = {(r.source, r.block): r.slot for r in rows}
    assert len(set(blocks.values())) == len(blocks)  # a slot holds one block


def test_blocks_cut_the_source(documents):
    rows = mixing.schedule(documents(*corpus()), block_chars=1000).collect()
    for source in {r.source for r in rows}:
        own = [r for r in rows if r.source == source]
        total = sum(r.n_units for r in own)
        assert {0} <= {r.block for r in own} <= set(range(max(1, -(-total // 1000))))


def test_deviation_is_less_than_one_block(spark, documents):
    weights = {"s0": 5.0, "s1": 3.0, "s2": 1.0, "s3": 1.0}
    docs = documents(*[(i, "x" * 100, "en", f"s{i % 4}") for i in range(2000)])
    rows = mixing.schedule(docs, weights, block_chars=100).collect()
    a = {"s0": 10, "s1": 6, "s2": 2, "s3": 2}
    slots = {r.slot: r.source for r in rows}
    first = 20 * (500 // 10)  # until the heaviest source runs out
    done = Counter()
    for t in range(first):
        done[slots[t]] += 1
        assert all(abs(done[s] - (t + 1) * a[s] / 20) < 1 for s in a)
    # the others go on by their own weights
    rest = defaultdict(int)
    for t in range(first, first + 10):
        rest[slots[t]] += 1
    assert dict(rest) == {"s1": 6, "s2": 2, "s3": 2}


def test_odd_rows(documents):
    rows = mixing.schedule(documents((1, None, None, None), (1, None, None, None), (2, "", "en", ""), (None, "abc", None, "z"), (3, "y" * 100_000, None, "z")), block_chars=1000).collect()
    assert len(rows) == 5 and {r.source for r in rows} == {"", "z"}
    assert all(r.release <= r.slot < r.deadline for r in rows)


@pytest.mark.parametrize("run", [mixing.schedule, mixing.mixed])
def test_empty(documents, run):
    assert run(documents()).count() == 0


def test_mixed_keeps_rows_and_orders_them(spark, documents, tmp_path):
    docs = documents(*corpus(100)).withColumnRenamed("n_chars", "slot")
    path = f"file://{tmp_path}/out"
    mixing.mixed(docs, block_chars=1000).write.parquet(path)
    back = spark.read.parquet(path)
    assert back.columns == docs.columns and sorted(back.collect(), key=lambda r: r.doc_id) == sorted(docs.collect(), key=lambda r: r.doc_id)
    slots = {r.doc_id: r.slot for r in mixing.schedule(docs, block_chars=1000).collect()}
    import glob

    import pyarrow.parquet as pq

    order = [slots[i] for f in sorted(glob.glob(f"{tmp_path}/out/part-*")) for i in pq.read_table(f)["doc_id"].to_pylist()]
    assert order == sorted(order)


@pytest.mark.parametrize(("shares", "blocks"), [([(1 / 3) ** 0.5] + [(2 / 57) ** 0.5] * 19, [700] + [74] * 19), ([500_000**0.5] + [1000**0.5] * 1000, [31] + [1] * 1000), ([2**0.5, 3**0.5, 0.01], [3000, 2000, 5])])
def deadlines_first(rows):
    """Slots by brute force: at each, of the released blocks the one with the earliest deadline (ties: by source)."""
    left, out = sorted((r.deadline, r.source, r.block, r.release) for r in rows), []
    while left:
        out.append(next(x for x in left if x[3] <= len(out)))
        left.remove(out[-1])
    return [(s, k) for _, s, k, _ in out]


@pytest.mark.parametrize(("shares", "blocks"), [([(1 / 3) ** 0.5] + [(2 / 57) ** 0.5] * 19, [700] + [74] * 19), ([500_000**0.5] + [1000**0.5] * 1000, [31] + [1] * 1000), ([2**0.5, 3**0.5, 0.01], [3000, 2000, 5]), ([1.0], [1]), ([0.001] * 7, [1, 2, 3, 4, 5, 6, 7])])
def test_deviation_from_unrounded_weights_is_less_than_one_block(spark, shares, blocks):
    sources = [(f"s{i:04d}", float(s), b) for i, (s, b) in enumerate(zip(shares, blocks, strict=True))]
    found, count = mixing.scheduled(spark.createDataFrame(sources, "source string, share double, blocks long"))
    rows = sorted(found.collect(), key=lambda r: r.slot)
    assert [r.slot for r in rows] == list(range(sum(blocks))) and count == len(rows)
    assert all(r.release <= r.slot < r.deadline for r in rows)
    assert [(r.source, r.block) for r in rows] == deadlines_first(rows)
    left, done, target = set(range(len(shares))), [0] * len(shares), [0.0] * len(shares)
    for r in rows:
        i = int(r.source[1:])
        assert done[i] == r.block
        done[i] += 1
        room = 1.0  # the slot's time, shared by the sources that have blocks left
        while room > 1e-9:
            total = sum(shares[s] for s in left)
            step = min(room, *((blocks[s] - target[s]) * total / shares[s] for s in left)) if left else room
            for s in left:
                target[s] += step * shares[s] / total
            left = {s for s in left if blocks[s] - target[s] > 1e-9}
            room -= step
        assert all(abs(d - t) < 1 + 1e-6 for d, t in zip(done, target, strict=True))


def test_weights_are_not_rounded(documents):
    docs = documents(*[(i, "x" * 100, "en", "s0" if i < 500 else f"s{i}") for i in range(1000)])
    weights = {"s0": 500.0, **{f"s{i}": 1.0 for i in range(500, 1000)}}
    slots = {r.slot: r.source for r in mixing.schedule(docs, weights, block_chars=100).collect()}
    done = 0
    for t in range(1000):
        done += slots[t] == "s0"
        assert abs(done - (t + 1) / 2) < 1


def test_weights_of_nought_come_last(documents):
    docs = documents(*[(i, "x" * 100, "en", f"s{i % 2}") for i in range(40)])
    slots = {r.slot: r.source for r in mixing.schedule(docs, {"s0": 0.0, "s1": 1.0}, block_chars=100).collect()}
    assert [slots[t] for t in range(40)] == ["s1"] * 20 + ["s0"] * 20


def test_a_long_corpus_is_cut_into_longer_blocks(documents):
    rows = mixing.schedule(documents(*corpus()), block_chars=100, max_blocks=50).collect()
    assert len(rows) == 400 and max(r.slot for r in rows) < 50 + 5
    assert all(r.release <= r.slot < r.deadline for r in rows)


def test_a_thousand_sources(documents):
    docs = documents(*[(i, "x" * 50, "en", f"s{i % 1000}") for i in range(4000)])
    rows = mixing.schedule(docs, block_chars=50).collect()
    assert len(rows) == 4000 and sorted({r.slot for r in rows}) == list(range(4000)) and all(r.release <= r.slot < r.deadline for r in rows)


def test_mixed_with_clashing_names_and_one_id_for_two_texts(documents):
    docs = documents((1, "a", "en", "x"), (1, "b" * 30_000, "en", "y"), (None, "c", None, None)).withColumnRenamed("n_chars", "file").withColumnRenamed("lang", "row").withColumn("slot", F.lit(3)).withColumn("_metadata", F.lit(1))
    out = mixing.mixed(docs)
    assert out.columns == docs.columns and sorted(out.collect(), key=str) == sorted(docs.collect(), key=str)
