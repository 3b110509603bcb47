"""Text rules of dialogues as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points that count as white space (Java's own classes leave some of them out).
WHITE_SPACE = r"[\x09-\x0d\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
# A leading fence, with or without "json", and a trailing one.
FENCE = rf"^{WHITE_SPACE}*```(?:json)?{WHITE_SPACE}*|{WHITE_SPACE}*```{WHITE_SPACE}*$"


def strip(c: Column) -> Column:
    """Without white space at either end; null stays null."""
    return F.regexp_replace(c, f"^{WHITE_SPACE}+|{WHITE_SPACE}+$", "")


def norm(c: Column) -> Column:
    """Lower case, runs of white space as one space, none at the ends; null gives ''."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), f"{WHITE_SPACE}+", " "))


def or_empty(*columns: Column) -> Column:
    """The first that is neither null nor '', else ''."""
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in columns), F.lit(""))


def fingerprint(dialogue: Column, *more: Column) -> Column:
    """16 hex digits over role:content of all turns, joined by |; a null content reads None.  Separators aren't escaped, so
    a turn that holds "|doctor:" can look like two.  Further columns make the cache depend on them too."""
    turns = F.transform(dialogue, lambda t: F.concat(F.coalesce(t["role"], F.lit("None")), F.lit(":"), F.coalesce(t["content"], F.lit("None"))))
    payload = F.array_join(turns, "|")
    if more:
        payload = F.concat_ws("\x1f", payload, *more)
    return F.substring(F.sha2(payload, 256), 1, 16)


def unfenced(c: Column) -> Column:
    return strip(F.regexp_replace(F.coalesce(c, F.lit("")), FENCE, ""))


def shaped_turns(dialogue: Column) -> Column:
    """array<struct<role, text>> in dialogue order."""
    return F.transform(dialogue, lambda t: F.struct(t["role"].alias("role"), t["content"].alias("text")))


def request(dialogue: Column, conclusion: Column, department: Column) -> Column:
    """What a text model is asked, as JSON; nulls are written out."""
    return F.to_json(F.struct(shaped_turns(dialogue).alias("turns"), conclusion.alias("reference_conclusion"), department.alias("department")), {"ignoreNullFields": "false"})
