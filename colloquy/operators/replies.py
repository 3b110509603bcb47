"""Text-model replies: asking with retries, and reading the JSON that comes back."""

from __future__ import annotations

import json
import re
import sys
import time
from collections.abc import Callable

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import unfenced
from .facts import FACT

#: The task in this package's own words; a responder gets it with every request.
INSTRUCTIONS = (
    "Read the consultation in the request and list its key facts as JSON: an object with one member, facts, a list of objects with category, name, "
    "value, source_turn and evidence. category is one of symptom, duration, medical_history, allergy_history, medication, cause, disease_name. The "
    "first five cite the position of the patient's turn that says so, counted from 0, and quote it word for word; the last two quote the conclusion and "
    "have a null source_turn. At most ten facts."
)
Responder = Callable[[str, str], str]


def parsed(raw: Column) -> Column:
    """struct<status, facts, raw>: status is ok, invalid_json, not_object, no_facts or bad_element; facts and raw, the JSON text of
    each fact as it came, are null unless ok.

    JSON types are kept apart as far as they matter: source_turn takes whole numbers and booleans (true is 1), not 3.5 or "3";
    other members are read as text, with 0 and false as ''.  NaN is invalid here, and text after the JSON value is
    let pass.
    """
    v = F.try_parse_json(unfenced(raw))
    kind = F.schema_of_variant(v)
    elements = F.try_variant_get(v, "$.facts", "array<variant>")
    objects = F.forall(elements, lambda e: e.isNotNull() & F.coalesce(F.schema_of_variant(e).startswith("OBJECT"), F.lit(False)))
    status = (
        F.when(v.isNull(), "invalid_json").when(~kind.startswith("OBJECT"), "not_object").when(elements.isNull(), "no_facts").when(~objects, "bad_element").otherwise("ok")
    )
    return F.struct(status.alias("status"), F.when(status == "ok", F.transform(elements, _fact)).cast(f"array<{FACT}>").alias("facts"), F.when(status == "ok", F.transform(elements, lambda e: F.to_json(e))).alias("raw"))


def _text(e: Column, name: str) -> Column:
    value = F.try_variant_get(e, f"$.{name}", "variant")
    kind = F.coalesce(F.schema_of_variant(value), F.lit("VOID"))
    text = F.try_variant_get(e, f"$.{name}", "string")
    zero = ~kind.isin("STRING", "BOOLEAN") & (F.try_variant_get(e, f"$.{name}", "double") == 0)
    return F.when(kind == "BOOLEAN", F.when(F.try_variant_get(e, f"$.{name}", "boolean"), "True").otherwise("")).when(zero, "").otherwise(text)


def _fact(e: Column) -> Column:
    source = F.try_variant_get(e, "$.source_turn", "variant")
    kind = F.coalesce(F.schema_of_variant(source), F.lit("VOID"))
    turn = F.when(kind == "BIGINT", F.try_variant_get(e, "$.source_turn", "int")).when(kind == "BOOLEAN", F.try_variant_get(e, "$.source_turn", "boolean").cast("int"))
    return F.struct(F.try_variant_get(e, "$.category", "string").alias("category"), _text(e, "name").alias("name"), _text(e, "value").alias("value"), turn.alias("source_turn"), _text(e, "evidence").alias("evidence"))


def acceptable(reply: str) -> bool:
    """Whether a reply will parse; asked before an attempt counts as done."""
    text = re.sub(r"\A\s*```(?:json)?\s*|\s*```\s*\Z", "", reply or "").strip()
    try:
        value = json.loads(text)
    except ValueError:
        return False
    facts = value.get("facts") if isinstance(value, dict) else None
    return isinstance(facts, list) and all(isinstance(f, dict) for f in facts)


def asked(requests: DataFrame, responder: Responder | None, *, retries: int = 3, pause: float = 1.0) -> DataFrame:
    """requests (case_id, fp, request) with reply (null if all attempts failed) and attempts.

    After a failure the next attempt waits pause seconds, then twice that, and so on; none after the last.  A
    task that Spark runs again asks again: store the result before using it twice.  NotImplementedError is no failed attempt: it ends
    the job.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not have the package installed
    if responder is None:
        raise NotImplementedError("no responder was given; pass a function of (request, instructions) that returns the reply")

    def ask(request: str) -> tuple[str | None, int]:
        for attempt in range(retries):
            try:
                reply = responder(request, INSTRUCTIONS)
                if acceptable(reply):
                    return reply, attempt + 1
            except NotImplementedError:
                raise
            except Exception:  # noqa: BLE001  whatever a responder raises is a failed attempt
                pass
            if attempt + 1 < retries:
                time.sleep(pause * 2**attempt)
        return None, retries

    def run(parts):
        for part in parts:
            out = [ask(r) for r in part["request"]]
            yield pd.DataFrame({"case_id": part["case_id"], "fp": part["fp"], "reply": [r for r, _ in out], "attempts": [n for _, n in out]})

    kind = requests.schema["case_id"].dataType.simpleString()
    return requests.select("case_id", "fp", "request").mapInPandas(run, f"case_id {kind}, fp string, reply string, attempts int")
