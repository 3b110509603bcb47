"""The pipeline stage by stage and as a whole, against plain Python."""

import random
import re

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")
tokenizers = pytest.importorskip("tokenizers")
pytest.importorskip("public_tokenizers")

from colloquy.llm import bpe, mixing, pii  # noqa: E402


def corpus():
    rng = random.Random(11)
    say = lambda n: " ".join(rng.choice(["river", "stone", "walks", "light", "the", "of"]) + str(rng.randint(0, 400)) for _ in range(n))
    rows = [(i, say(60), "en", f"s{i % 3}") for i in range(30)]
    rows += [(100 + i, rows[i][1], "en", "s0") for i in range(5)]  # exact copies
    rows += [(200 + i, rows[i][1].rsplit(" ", 1)[0] + " changed", "en", "s1") for i in range(5, 9)]  # near copies
    rows += [(300, None, None, None), (301, "", "en", "s1"), (302, "12 34 !!", "en", "s2"), (303, "card 4111111111111111 and und.34@mail7.example.com", "en", None)]
    return rows + [rows[0]]


def near_groups(rows):
    def shingles(t):
        ws = t.lower().split()
        return {tuple(ws[i : i + 5]) for i in range(len(ws) - 4)} or ({tuple(ws)} if ws else set())

    keep = []
    for i, t, *_ in sorted(rows):
        s = shingles(t)
        if all(100 * len(s & k) < 80 * len(s | k) for _, k in keep):
            keep.append((i, s))
    return {i for i, _ in keep}


def test_stages(spark, folder):
    d = folder(corpus())
    docs = spark.read.parquet(f"{d}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, d).collect(), docs.schema)
        assert docs.columns == columns
        kept[name] = {r.doc_id: r for r in docs.collect()}
        if name == "language_id":
            assert set(kept[name]) == {r[0] for r in corpus()} - {300, 301, 302}
        if name == "near_duplicates":
            want = near_groups([r for r in corpus() if r[0] not in (300, 301, 302)])
            assert set(kept[name]) == want and docs.count() == len(want)
    assert "4111111111111111" not in kept["personal_data"][303].text and "mail7" not in kept["personal_data"][303].text
    assert kept["personal_data"][303].n_chars == len(kept["personal_data"][303].text)
    assert kept["mixing"] == kept["personal_data"]


def test_run(spark, folder):
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, folder(corpus())).collect()}
    library = tokenizers.Tokenizer.from_file(bpe.tokenizer_path())
    texts = {i: t for i, t, *_ in corpus()}
    assert set(out) == near_groups([r for r in corpus() if r[0] not in (300, 301, 302)])
    for i, r in out.items():
        if i != 303:
            assert r.ids == library.encode(texts[i], add_special_tokens=False).ids
    assert re.fullmatch("[0-9a-f]{64}", out[303].ids_sha256)


def test_mixing_decides_positions(spark, folder, monkeypatch):
    monkeypatch.setattr(mixing.schedule, "__kwdefaults__", mixing.schedule.__kwdefaults__ | {"block_chars": 500})
    d = folder(corpus())
    position = {r.doc_id: r.position for r in corpus_pipeline.run(spark, d).collect()}
    assert sorted(position.values()) == list(range(len(position)))
    monkeypatch.setattr(corpus_pipeline, "STAGES", [s for s in corpus_pipeline.STAGES if s[0] != "mixing"])
    assert {r.doc_id: r.position for r in corpus_pipeline.run(spark, d).collect()} != position
    docs = spark.read.parquet(f"{d}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, d).collect(), docs.schema)
    slot = {r.doc_id: r.slot for r in mixing.schedule(docs).collect()}
    order = [slot[i] for i in sorted(position, key=position.get)]
    assert order == sorted(order) and len(set(order)) > 3


def test_rows_that_share_an_id_and_clashing_names(spark, documents):
    long = " ".join(f"word{i}" for i in range(40))
    rows = [(7, long), (7, "another text of its own kind"), (3, long + " end"), (None, long), (None, "a third text without any id"), (9, "a third text without any id"), (None, ""), (None, None)]
    docs = documents(*[(i, t, "en", "s") for i, t in rows]).withColumnRenamed("lang", "file").withColumnRenamed("n_chars", "row")
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(3, long + " end"), (7, "another text of its own kind"), (9, "a third text without any id"), (None, ""), (None, None)], key=str)
    beyond = corpus_pipeline.BROADCAST_GONE
    corpus_pipeline.BROADCAST_GONE = 0
    try:
        assert corpus_pipeline.near_duplicates(spark, docs, "").count() == 5
    finally:
        corpus_pipeline.BROADCAST_GONE = beyond


def test_the_key_of_pseudonyms_is_a_setting(spark, documents):
    docs = documents((1, "card 4111111111111111", "en"))
    plain = corpus_pipeline.personal_data(spark, docs, "").first().text
    spark.conf.set(corpus_pipeline.KEY_SETTING, "another")
    try:
        assert corpus_pipeline.personal_data(spark, docs, "").first().text != plain
    finally:
        spark.conf.unset(corpus_pipeline.KEY_SETTING)


def test_nothing_is_left_behind(spark, folder):
    import os
    import re

    shared = re.sub("^file:", "", spark.conf.get("spark.checkpoint.dir"))
    before = {f for f in os.listdir(shared) if not f.endswith(".zip")}
    corpus_pipeline.run(spark, folder(corpus())).count()
    assert len({f for f in os.listdir(shared) if not re.search(r"\.(zip|crc)$", f)} - before) == 1  # the result


def test_empty(spark, folder):
    assert corpus_pipeline.run(spark, folder([])).count() == 0


def test_stage_contract():
    assert 4 <= len(corpus_pipeline.STAGES) <= 5 and all(isinstance(n, str) and callable(f) for n, f in corpus_pipeline.STAGES)
    assert pii.KEY and mixing.BLOCK_CHARS > 0


def test_the_driver_hands_memory_back_within_a_piece_of_work(spark, monkeypatch):
    from colloquy.llm import common

    common._trim(spark.sparkContext)  # this JVM knows the command
    calls = []
    monkeypatch.setattr(common, "_shrink_driver", lambda: calls.append(1))
    with common.working():
        for _ in range(common.SHRINK_EVERY):
            common.stored(spark.range(3))
        assert len(calls) == 1
