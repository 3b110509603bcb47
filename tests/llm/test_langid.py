import random

import numpy as np

from colloquy.llm import langid

VOICE = {"aa": ["ban", "dor", "kel", "the"], "bb": ["éta", "qui", "ois", "les"], "cc": ["schö", "ung", "ver", "der"]}


def say(rng, lang, n=30):
    return " ".join("".join(rng.choices(VOICE[lang], k=rng.randint(1, 3))) for _ in range(n))


def test_query(spark, folder):
    rng = random.Random(3)
    rows = [(i, say(rng, lang), lang) for i in range(150) for lang in [list(VOICE)[i % 3]]]
    rows += [(900, None, "aa"), (901, "", None), (902, "123 !!! ---", "bb"), (903, "日本語", None), (904, say(rng, "bb", 20_000), None), (905, say(rng, "cc", 2).upper(), None)]
    out = {r.doc_id: r for r in langid.op6_language_id(spark, folder(rows)).collect()}
    held = [i for i in range(150) if out[i].held_out]
    assert held and all(out[i].lang_pred == list(VOICE)[i % 3] for i in held)
    assert [out[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3 and out[900].score == 0
    assert out[903].lang_pred in VOICE and out[904].lang_pred == "bb" and out[905].lang_pred == "cc"
    assert all(0 <= r.score <= 1 for r in out.values())


def test_nothing_to_learn_from(spark, folder):
    assert [r.lang_pred for r in langid.op6_language_id(spark, folder([(1, "text", None)])).collect()] == ["und"]


def test_code_lengths_equal_the_definition():
    """The frozen tables against escapes followed one by one, and probabilities that sum to one."""
    texts = ["the cat sat on the mat", "that hat"]
    grams = np.concatenate([langid._grams(langid.coded(t)) for t in texts]).astype(np.int64)
    keys, n = np.unique(grams, return_counts=True)
    model = langid.Model(["x"], [langid.Language.freeze(keys, n.astype(float))])

    def probability(context, byte):
        if context is None:
            return 1 / 256
        counts = {}
        for g, c in zip(keys.tolist(), n.tolist(), strict=True):
            parts = [(g >> s) & 255 for s in (24, 16, 8, 0)]
            if tuple(parts[3 - len(context) : 3]) == context:
                counts[parts[3]] = counts.get(parts[3], 0) + c
        shorter = context[1:] if context else None
        if not counts:
            return probability(shorter, byte)
        total, kinds = sum(counts.values()), len(counts)
        if byte in counts:
            return counts[byte] / (total + kinds)
        left = 1 - sum(probability(shorter, b) for b in counts)
        return kinds / (total + kinds) * probability(shorter, byte) / left

    coded = langid.coded("the rat sat zoo")
    want = -sum(np.log(probability(tuple(coded[i - 3 : i].tolist()), int(coded[i]))) for i in range(3, len(coded)))
    assert np.isclose(model.code_lengths([coded])[0, 0], want)
    assert np.allclose(model.code_lengths([coded, coded[:9], coded], chunk=5)[::2, 0], want)
    for context in ((32, 32, 32), (116, 104, 101), (1, 2, 3)):
        assert np.isclose(sum(probability(context, b) for b in range(256)), 1)


def test_whole_rows_and_clashing_names(spark):
    rows = spark.createDataFrame([(1, "the cat", "aa", "old", 5)], "doc_id long, text string, lang string, lang_pred string, n int")
    model = langid.train(rows)
    (row,) = langid.predict(rows, model, whole=True).collect()
    assert row.lang_pred == "aa" and row.n == 5 and row.text == "the cat"
    assert langid.predict(rows.where("false"), model).count() == 0


def test_many_languages_of_unequal_size(spark):
    """More than 200 languages, the last of few rows beside a big one: each keeps strings of its own."""
    rng = random.Random(9)
    letters = "abcdefghijklmnopqrst"
    voices = {f"l{i:03d}": [letters[i % 20] + letters[i // 20] + c for c in "uvwxyz"] for i in range(210)}
    rows = [(k, " ".join(rng.choices(v, k=20)), lang) for k, (lang, v) in enumerate(voices.items())]
    rows += [(1000 + k, " ".join(rng.choices(voices["l000"], k=200)), "l000") for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs, grams_per_lang=100)
    assert len(model.langs) == 210
    out = {r.doc_id: r.lang_pred for r in langid.predict(docs, model).collect()}
    assert all(out[i] == lang for i, _, lang in rows)


def test_two_texts_of_one_id_and_null_columns(spark):
    docs = spark.createDataFrame([(1, "the cat sat", "aa"), (1, "und der hund", "cc"), (None, "the cat", None), (None, None, None)], "doc_id long, text string, lang string")
    out = langid.predict(docs, langid.train(docs)).collect()
    assert [r.lang_pred for r in out] == ["aa", "cc", "aa", "und"]
