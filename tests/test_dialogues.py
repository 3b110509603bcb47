"""Boundary rows of text rules, validation, replies, cache and the batch job."""

import json
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from colloquy.functions import beliefs, text
from colloquy.operators import cache, facts, gating, ranks, replies, rewards, statistics
from colloquy.plans import extraction
from colloquy.plans.parameters import Parameters

TURNS = [("patient", "I have had a Sore  Throat"), ("doctor", "since when?"), ("patient", "two weeks"), ("system", "note")]


def episode(spark, items, turns=TURNS, conclusion="It is a common cold."):
    shape = f"case_id string, dialogue array<struct<role:string,content:string>>, conclusion string, facts array<{facts.FACT}>"
    return spark.createDataFrame([("c", turns, conclusion, items)], shape)


def reasons(spark, items, **kwargs):
    strict = kwargs.pop("strict", False)
    return [r.reason for r in facts.by_fact(episode(spark, items, **kwargs), strict).orderBy("pos").collect()]


def test_norm_and_fingerprint(spark):
    values = [("  A 　B\x1c c ",), ("",), (None,), ("ΟΔΟΣ",)]
    got = [r[0] for r in spark.createDataFrame(values, "v string").select(text.norm(F.col("v"))).collect()]
    assert got == [" ".join((v or "").lower().split()) for (v,) in values]
    one = spark.createDataFrame([([("patient", "a|doctor:b")],), ([("patient", "a"), ("doctor", "b")],), ([("patient", None)],)], "d array<struct<role:string,content:string>>")
    prints = [r[0] for r in one.select(text.fingerprint(F.col("d"))).collect()]
    assert prints[0] == prints[1] != prints[2] and all(len(p) == 16 for p in prints)


@pytest.mark.parametrize(
    ("fact", "reason"),
    [
        (("symptom", "throat", "sore", 0, "sore throat"), "kept"),
        (("lab", "x", "y", 0, ""), "bad_category"),
        ((None, "x", "y", 0, ""), "bad_category"),
        (("symptom", "  ", "y", 0, ""), "empty_field"),
        (("symptom", "x", None, 0, ""), "empty_field"),
        (("symptom", "x", "y", None, ""), "bad_source_turn"),
        (("symptom", "x", "y", -1, ""), "bad_source_turn"),
        (("symptom", "x", "y", 4, ""), "bad_source_turn"),
        (("symptom", "x", "y", 1, ""), "not_patient_turn"),
        (("symptom", "x", "y", 3, ""), "not_patient_turn"),
        (("duration", "x", "y", 2, "three weeks"), "evidence_mismatch"),
        (("duration", "x", "y", 2, ""), "kept"),
        (("cause", "x", "y", None, "a common COLD"), "kept"),
        (("cause", "x", "y", 99, "flu"), "evidence_mismatch"),
    ],
)
def test_ladder(spark, fact, reason):
    assert reasons(spark, [fact]) == [reason]


def test_a_rejected_fact_blocks_nothing_and_a_kept_one_blocks_later_twins(spark):
    bad, good, worse = ("symptom", "A", "v", 0, "nope"), ("symptom", "a", "v", 0, ""), ("symptom", "A ", "v", 1, "")
    assert reasons(spark, [bad, good, worse]) == ["evidence_mismatch", "kept", "duplicate"]


def test_strict_and_empty_conclusion(spark):
    fact = ("cause", "x", "y", None, "anything")
    assert reasons(spark, [fact], conclusion="") == ["kept"]
    assert reasons(spark, [fact], conclusion="", strict=True) == ["evidence_mismatch"]


def test_no_facts_and_more_than_ten(spark):
    assert reasons(spark, []) == [] and reasons(spark, None) == []
    many = [("symptom", f"n{i}", "v", 0, "") for i in range(13)]
    assert reasons(spark, many) == ["kept"] * 10 + ["truncated"] * 3
    row = facts.validated(episode(spark, many)).first()
    assert len(row.facts) == 10 and row.dropped == []


def test_against_a_sequential_rule(spark):
    rng = random.Random(3)
    names, kinds = ["a", "A", "b", ""], [*facts.PATIENT_SIDE[:2], "cause", "lab"]
    items = [[(rng.choice(kinds), rng.choice(names), "v", rng.choice([0, 1, 2, None]), rng.choice(["", "weeks", "cold"])) for _ in range(rng.randint(0, 25))] for _ in range(60)]
    shape = f"case_id long, dialogue array<struct<role:string,content:string>>, conclusion string, facts array<{facts.FACT}>"
    rows = facts.by_fact(spark.createDataFrame([(i, TURNS, "a cold", f) for i, f in enumerate(items)], shape)).collect()
    got = {(r.case_id, r.pos): r.reason for r in rows}
    for i, given in enumerate(items):
        held, kept = set(), 0
        for pos, (kind, name, _, turn, quote) in enumerate(given):
            if kind == "lab":
                want = "bad_category"
            elif not name:
                want = "empty_field"
            elif (kind, name.lower()) in held:
                want = "duplicate"
            elif kind != "cause" and turn is None:
                want = "bad_source_turn"
            elif kind != "cause" and TURNS[turn][0] != "patient":
                want = "not_patient_turn"
            elif quote not in ("a cold" if kind == "cause" else TURNS[turn][1].lower()):
                want = "evidence_mismatch"
            else:
                held.add((kind, name.lower()))
                kept += 1
                want = "kept" if kept <= 10 else "truncated"
            assert got[i, pos] == want


@pytest.mark.parametrize(
    ("reply", "status", "turns"),
    [
        ('{"facts": [{"category": "symptom", "name": "x", "value": "y", "source_turn": 1, "evidence": "e"}]}', "ok", [1]),
        ('```json\n{"facts": [{"source_turn": true}, {"source_turn": 1.5}, {"source_turn": "1"}, {"source_turn": null}, {}]}\n```', "ok", [1, None, None, None, None]),
        ('{"facts": []}', "ok", []),
        ('{"fact": []}', "no_facts", None),
        ('{"facts": {}}', "no_facts", None),
        ("[1]", "not_object", None),
        ('{"facts": [1]}', "bad_element", None),
        ('{"facts": [null]}', "bad_element", None),
        ("{", "invalid_json", None),
        ('{"facts": NaN}', "invalid_json", None),
        ("", "invalid_json", None),
        (None, "invalid_json", None),
    ],
)
def test_reply(spark, reply, status, turns):
    row = spark.createDataFrame([(reply,)], "raw string").select(replies.parsed(F.col("raw")).alias("p")).first().p
    assert row.status == status
    assert (None if row.facts is None else [f.source_turn for f in row.facts]) == turns


def test_scalars_of_a_reply(spark):
    raw = '{"facts": [{"name": 5, "value": 0, "evidence": false}, {"name": true, "value": "0"}]}'
    a, b = spark.createDataFrame([(raw,)], "raw string").select(replies.parsed(F.col("raw"))["facts"]).first()[0]
    assert (a.name, a.value, a.evidence, b.name, b.value) == ("5", "", "", "True", "0")


def test_last_entry_wins_even_if_stale(spark):
    entries = spark.createDataFrame([("a", 1, "x"), ("a", 2, "old"), ("b", 1, "old"), ("b", 2, "y")], "case_id string, seq long, fp string")
    episodes = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "z")], "case_id string, fp string")
    assert {r.case_id for r in cache.with_cache(episodes, entries).where("cached is not null").collect()} == {"b"}
    assert {r.case_id for r in cache.misses(episodes, entries).collect()} == {"a", "c"}


def write_split(spark, folder, split, cases):
    rows = [Row(extra_info=Row(case_id=c, sample_id="s" + c, patient_state=Row(full_dialogue=[Row(role="patient", content=t)])), ground_truth=Row(reference_conclusion="cold", department_path="", department="ENT")) for c, t in cases]
    spark.createDataFrame(rows).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{split}.parquet")


def answer(request, instructions):
    said = json.loads(request)["turns"][0]["text"]
    if said == "fail":
        raise RuntimeError("no")
    return json.dumps({"facts": [{"category": "symptom", "name": "n", "value": "v", "source_turn": 0, "evidence": said}, {"category": "x"}]})


def test_batch_job(spark, tmp_path):
    write_split(spark, tmp_path / "in", "train", [("1", "ache"), ("2", "fail"), ("3", "cough")])
    config = extraction.Config(f"file://{tmp_path}/in", f"file://{tmp_path}/out", retries=2, pause=0.0)
    first = extraction.run(spark, config, answer)
    assert first == {"episodes": 3, "failed": 1, "no_facts": 0, "by_category": {"symptom": 2}, "drop_reasons": {"bad_category": 2}}
    assert json.loads((tmp_path / "out/_facts_report.json").read_text()) == first
    assert spark.read.parquet(config.output + "/cache").count() == 2
    again = extraction.run(spark, config, lambda r, i: "{")  # everything but the failed one comes from the cache
    assert again == first and spark.read.parquet(config.output + "/cache").count() == 2
    written = spark.read.json(config.output + "/facts")
    assert written.count() == 2 and {r.split for r in written.collect()} == {"train"}
    assert [json.loads(json.dumps(r.asDict(recursive=True)))["fact"] for r in written.first().dropped] == [{"category": "x"}]
    with pytest.raises(NotImplementedError):
        extraction.run(spark, config, None)


def missing(request, instructions):
    raise NotImplementedError("later")


def test_a_responder_that_is_not_implemented_ends_the_job(spark, tmp_path):
    write_split(spark, tmp_path / "in", "train", [("1", "ache")])
    with pytest.raises(NotImplementedError):
        extraction.run(spark, extraction.Config(f"file://{tmp_path}/in", f"file://{tmp_path}/out", retries=2, pause=0.0), missing)


def test_ranks_and_quantiles(spark):
    rng = random.Random(4)
    values = [rng.choice([1.5, 2.0, 2.0, 7.25, rng.random() * 10]) for _ in range(500)] + [None]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    known = sorted(v for v in values if v is not None)
    got = ranks.quantiles(rows, "v", {"a": 0.0, "b": 0.25, "c": 0.9, "d": 1.0}).first()
    at = lambda q: (lambda x, k: known[k] + (known[min(k + 1, len(known) - 1)] - known[k]) * (x - k))(q * (len(known) - 1), int(q * (len(known) - 1)))
    assert [got.a, got.b, got.c, got.d] == pytest.approx([at(q) for q in (0.0, 0.25, 0.9, 1.0)])
    for r in ranks.ranked(rows.where("v is not null"), "v", "rank").collect():
        assert r["rank"] == sum(x < r.v for x in known) + (known.count(r.v) + 1) / 2
    empty = rows.where("false")
    assert ranks.quantiles(empty, "v", {"a": 0.5}).first().a is None and ranks.ranked(empty, "v", "r").count() == 0
    texts = spark.createDataFrame([(f"k{i}",) for i in range(50)], "key string")
    assert sorted(r.before for r in ranks.placed(texts, "key", F.lit(1))[0].collect()) == list(range(50))


def test_limit_and_missing_splits(spark, tmp_path):
    write_split(spark, tmp_path / "in", "dev", [(str(i), "t") for i in range(5)])
    found, missing = extraction.source.read_splits(spark, f"file://{tmp_path}/in", ["train", "dev"], 2)
    assert missing == ["train"] and sorted(r.case_id for r in found.collect()) == ["0", "1"]
    with pytest.raises(ValueError, match="negative"):
        extraction.source.read_splits(spark, f"file://{tmp_path}/in", ["dev"], -1)


def tiny_log(spark, beliefs_, u=None):
    rows = [(1, 1, t, (u or ["WEN"] * 9)[t], 4, b, [0] if t else [], False, [0.0, 1.0], 1.0, [0, 1], [1.0, 2.0]) for t, b in enumerate(beliefs_)]
    return spark.createDataFrame(rows, "case_id long, traj_id long, t long, u string, n_tok long, belief array<double>, confirmed array<int>, emergency_hit boolean, utility array<double>, r_out double, required array<int>, omega array<double>")


def test_rising_and_zero_entropy(spark):
    p = Parameters(facts=1, diagnoses=1)
    rising = rewards.measured(tiny_log(spark, [[0.9, 0.1], [0.5, 0.5]]), p).orderBy("t").collect()
    assert rising[1].s < 0 and rising[0].ig < 0 and rising[1].ig is None and rising[1].r_p == 0.0
    certain = rewards.measured(tiny_log(spark, [[1.0, 0.0], [1.0, 0.0]]), p).orderBy("t").collect()
    assert certain[0].h == 0.0 and certain[1].s is None
    assert gating.gated(rewards.measured(tiny_log(spark, [[1.0, 0.0]], ["DIG"]), p), p).first().gate == "pass"


def test_rewards_add_up_and_lambda_counts_once(spark):
    p = Parameters(facts=1, diagnoses=1, fact_weight=0.5, tau_low=-9.0)
    row = rewards.returns(rewards.rewarded(tiny_log(spark, [[0.5, 0.5], [0.25, 0.75], [0.1, 0.9]], ["WEN", "WEN", "DIG"]), p), p).first()
    assert row.adds_up and row.in_bounds and row.facts == pytest.approx(0.5 * 2.0)


def test_disclosure_ties_go_to_the_smallest(spark):
    rows = spark.createDataFrame([([0.5, 0.5], [], [0, 1], [1.0, 1.0]), ([0.5, 0.5], [0, 1], [0, 1], [1.0, 1.0])], "belief array<double>, confirmed array<int>, required array<int>, omega array<double>")
    assert [r.disclose for r in gating.disclosure(rows).collect()] == [0, None]


def test_statistics_without_variation(spark):
    flat = spark.createDataFrame([(1, 1.0, 2.0), (2, 1.0, 3.0)], "case_id long, a double, b double")
    assert statistics.spearman(flat, "a", "b").first().rho is None
    same = spark.createDataFrame([(s, r, 1.0) for s in range(3) for r in range(2)], "subject long, rater long, score double")
    assert statistics.agreement(same).first().icc is None
    tests = spark.createDataFrame([("H1", 0.01), ("H2", 0.04), ("H3", 0.03)], "hypothesis string, p double")
    assert {r.hypothesis: round(r.adjusted, 6) for r in statistics.holm(tests).collect()} == {"H1": 0.03, "H3": 0.06, "H2": 0.06}


def test_occupancy_bits(spark):
    row = spark.createDataFrame([([0.5, 0.0, 0.3, 0.2],)], "b array<double>").select(beliefs.occupied(F.col("b"), 3, 0.1)).first()[0]
    assert row == 0b101
