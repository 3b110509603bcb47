import hashlib
import pathlib
import random

import numpy as np
import pytest

from colloquy.llm import bpe

tokenizers = pytest.importorskip("tokenizers")
pytest.importorskip("public_tokenizers")
ODD = [
    "", None, "a", "Σας ΟΔΟΣ İstanbul", "x<|endoftext|>y <|startoftext|>", "'s don't we'LL 12 三百", "é ﬁ ǅ ŉ K Å", "\x1c\x85 x​y 𝒳 👩‍👩‍👧", "ẞ Ⅳ ² ½ ª º _a_b", "<|endoftext|>", "<| x", " a b",
    "z" * 5000, "ab" * 700 + " " + "é" * 300, "word " * 20_000,
]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(bpe.tokenizer_path())


def test_query_equals_the_library(spark, folder, library):
    rng = random.Random(3)
    texts = [*ODD, *("".join(rng.choice("abcé ü'1.\n<|>Ώ日") for _ in range(60)) for _ in range(200))]
    rows = list(enumerate(texts)) + [(2, "a")]
    out = bpe.op10_bpe(spark, folder(rows)).collect()
    assert len(out) == len(rows)
    for r in out:
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        said = library.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(said.encode()).hexdigest()), texts[r.doc_id]


def test_ids_and_texts(documents, library):
    (row,) = bpe.encode_documents(documents((1, "Hello there, world")).withColumnRenamed("lang", "ids"), bpe.tokenizer_path(), ids=True, texts=True).collect()
    assert row.ids == library.encode("Hello there, world", add_special_tokens=False).ids and row.decoded == library.decode(row.ids, skip_special_tokens=False)
    assert bpe.encode_documents(documents(), bpe.tokenizer_path()).count() == 0


def test_lexicon_is_minimal_and_exact():
    words = {w: [i, i + 1][: 1 + i % 2] for i, w in enumerate(sorted({a + b + c for a in ("", "un", "re") for b in ("do", "make", "é") for c in ("", "ing", "s")}))}
    lexicon = bpe.Lexicon.map(bpe.Lexicon.build(words).dump())
    found = lexicon.look_up([*words, "", "d", "undoing!", "mak", "x"])
    assert [f.tolist() for f in found[: len(words)]] == list(words.values()) and found[len(words) :] == [None] * 5
    # the minimal automaton of a set: as many states as there are different sets of ways to go on
    ways = {frozenset(v.encode()[len(p) :] for v in words if v.encode().startswith(p)) for w in words for p in (w.encode()[:n] for n in range(len(w.encode()) + 1))}
    assert len(lexicon.final) == len(ways)
    assert bpe.Lexicon.map(bpe.Lexicon.build({}).dump()).look_up(["a"]) == [None]


def test_merging_many_equals_merging_each():
    rules, rng = bpe.Rules.load(bpe.tokenizer_path()), random.Random(1)
    words = ["".join(rng.choice("abcdeé.tionhs") for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    assert rules.merge_many(words) == [rules.merge(w) for w in words]


def test_separators_without_other_odd_characters(spark, folder, library):
    texts = [f"ab{c}cd" for c in "\x1c\x1d\x1e\x1f"] + ["\x1c", "a \x1d\x1e. b", "é\x1f\x1f 12\x1c_", "x\x85y\xa0z\x0b\x0c"]
    out = bpe.op10_bpe(spark, folder(list(enumerate(texts)))).collect()
    for r in out:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        said = library.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(said.encode()).hexdigest()), texts[r.doc_id]


def test_executors_do_not_open_the_tokenizer_file(documents, library, tmp_path):
    import shutil

    path = pathlib.Path(shutil.copy(bpe.tokenizer_path(), tmp_path / "own.json"))
    made = bpe.encode_documents(documents((1, "ΟΔΟΣ 三百"), (1, "İ x"), (None, None)), str(path), ids=True)
    path.unlink()
    assert sorted(r.ids for r in made.collect()) == sorted([*(library.encode(t, add_special_tokens=False).ids for t in ("ΟΔΟΣ 三百", "İ x")), []])


def test_the_lexicon_reads_no_documents(spark, documents):
    """Its words are the tokenizer's own, so no job runs, and none are counted in part of the table."""
    docs = documents((1, "Hello there"))
    spark.sparkContext.setJobGroup("lexicon", "no job")
    bpe.encode_documents(docs, bpe.tokenizer_path())
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("lexicon")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    rules = bpe.Rules.load(bpe.tokenizer_path())
    words = bpe.whole_words(rules, 2000)
    assert len({*words}) == 2000 and "the" in words and all(rules.tokens[i] == w + rules.end for w in words if w.isascii() and w.isalpha() for [i] in [rules.merge(w)])
