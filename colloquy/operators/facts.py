"""Validation of extracted facts against the turns that disclose them.

A fact goes down a ladder of tests in reply order; the first that fails is its reason.  Of facts with the same category and
name (in lower case), the first *valid* one is kept and all later ones are duplicates; a fact rejected earlier blocks nothing.
Everything happens inside the episode's row, with array functions: no shuffle, and no window over facts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import norm, strip

# Categories whose facts must cite a patient's turn, and those that come from the conclusion.
PATIENT_SIDE = ["symptom", "duration", "medical_history", "allergy_history", "medication"]
CONCLUSION_SIDE = ["cause", "disease_name"]
# Fixed value: facts kept per episode.
MOST_FACTS = 10
FACT = "struct<category:string,name:string,value:string,source_turn:int,evidence:string>"


def _once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """rows with a column that is worked out once per row.

    A plain column would be put into every lambda that mentions it, and worked out again for every element; a
    generator of one element keeps projections apart.
    """
    return rows.select("*", F.explode(F.array(value)).alias(name))


def _prepared(fact: Column, pos: Column) -> Column:
    """What the tests look at, each worked out once."""
    source = fact["source_turn"]
    there = source.isNotNull() & (source >= 0) & (source < F.size("dialogue"))
    turn = F.get(F.col("dialogue"), F.when(there, source))
    name = strip(F.coalesce(fact["name"], F.lit("")))
    return F.struct(
        pos.alias("pos"),
        fact.alias("fact"),
        F.concat_ws("\x1f", fact["category"], F.lower(name)).alias("key"),
        ((name == "") | (strip(F.coalesce(fact["value"], F.lit(""))) == "")).alias("empty"),
        there.alias("there"),
        F.coalesce(turn["role"], F.lit("")).alias("role"),
        norm(turn["content"]).alias("said"),
        norm(fact["evidence"]).alias("evidence"),
    )


def _looked_at(f: Column, strict: bool) -> Column:
    """With pre and own: the reason before and after the duplicate test, null where the tests pass."""
    category = f["fact"]["category"]
    known = F.coalesce(category.isin(*PATIENT_SIDE, *CONCLUSION_SIDE), F.lit(False))
    pre = F.when(~known, "bad_category").when(f["empty"], "empty_field")

    def misquoted(where: Column, open_: Column) -> Column:
        missing = (f["evidence"] == "") | ~F.contains(where, f["evidence"])
        return missing if strict else missing & ~open_

    unquoted = f["evidence"] == ""
    patient = F.when(~f["there"], "bad_source_turn").when(f["role"] != "patient", "not_patient_turn").when(misquoted(f["said"], unquoted), "evidence_mismatch")
    other = F.when(misquoted(F.col("conclusion_"), unquoted | (F.col("conclusion_") == "")), "evidence_mismatch")
    own = F.when(category.isin(*PATIENT_SIDE), patient).otherwise(other)
    return F.struct(f["pos"].alias("pos"), f["fact"].alias("fact"), f["key"].alias("key"), pre.alias("pre"), own.alias("own"))


def checked(episodes: DataFrame, strict: bool = False) -> DataFrame:
    """Episodes (dialogue, conclusion, facts) with checked: array<struct<pos, fact, reason>> in reply order.

    reason is a drop reason, 'kept', or 'truncated' for valid facts beyond the first ten.  With strict, empty evidence or an empty conclusion
    never passes.
    """
    facts = F.coalesce("facts", F.expr(f"cast(array() as array<{FACT}>)"))
    rows = _once(episodes, "conclusion_", norm(F.col("conclusion")))
    rows = _once(rows, "prepared_", F.transform(facts, _prepared))
    rows = _once(rows, "looked_", F.transform("prepared_", lambda f: _looked_at(f, strict)))
    rows = _once(rows, "valid_", F.filter("looked_", lambda f: f["pre"].isNull() & f["own"].isNull()))
    # the valid facts that no earlier valid one has the key of
    rows = _once(rows, "kept_", F.filter("valid_", lambda f: ~F.exists("valid_", lambda g: (g["key"] == f["key"]) & (g["pos"] < f["pos"]))))

    def verdict(f: Column) -> Column:
        earlier = F.exists("kept_", lambda g: (g["key"] == f["key"]) & (g["pos"] < f["pos"]))
        place = F.size(F.filter("kept_", lambda g: g["pos"] < f["pos"]))
        reason = F.coalesce(f["pre"], F.when(earlier, "duplicate"), f["own"], F.when(place >= MOST_FACTS, "truncated"), F.lit("kept"))
        return F.struct(f["pos"].alias("pos"), f["fact"].alias("fact"), reason.alias("reason"))

    rows = _once(rows, "checked", F.transform("looked_", verdict))
    return rows.drop("conclusion_", "prepared_", "looked_", "valid_", "kept_")


def validated(episodes: DataFrame, strict: bool = False) -> DataFrame:
    """Episodes with facts replaced by those kept, and dropped: array<struct<reason, fact, pos>>; truncated facts are in neither."""
    rows = checked(episodes, strict)
    clean = lambda f: F.struct(
        f["fact"]["category"].alias("category"), strip(f["fact"]["name"]).alias("name"), strip(f["fact"]["value"]).alias("value"),
        f["fact"]["source_turn"].alias("source_turn"), strip(F.coalesce(f["fact"]["evidence"], F.lit(""))).alias("evidence"),
    )
    kept = F.transform(F.filter("checked", lambda f: f["reason"] == "kept"), clean)
    dropped = F.transform(F.filter("checked", lambda f: ~f["reason"].isin("kept", "truncated")), lambda f: F.struct(f["reason"].alias("reason"), f["fact"].alias("fact"), f["pos"].alias("pos")))
    return _once(_once(rows.drop("facts"), "facts", kept), "dropped", dropped).drop("checked")


def by_fact(episodes: DataFrame, strict: bool = False) -> DataFrame:
    """One row per fact: the episode's case_id, pos, category, name, reason."""
    rows = checked(episodes, strict).select("case_id", F.explode("checked").alias("c"))
    return rows.select("case_id", "c.pos", "c.fact.category", "c.fact.name", "c.reason")
