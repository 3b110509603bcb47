"""Inputs of the catalogue's queries, derived from the tables at hand (they hold no logged beliefs or model replies)."""

from __future__ import annotations

import atexit
import json
import sys
import tempfile
import uuid
from contextlib import suppress

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import beliefs
from ..functions.text import fingerprint
from ..operators.gating import with_emergency
from ..operators.rewards import rewarded
from ..sources.episodes import from_conversations
from .parameters import DEFAULTS

# The fixture's categories, one of them unknown.
CATEGORIES = ["symptom", "duration", "medical_history", "allergy_history", "medication", "cause", "disease_name", "lab"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_conversations(read(spark, sf_dir, "conversations"))


def with_facts(rows: DataFrame, per_turn: int = 3, names: int = 4, gaps: bool = True) -> DataFrame:
    """Candidate facts of each turn, standing in for a model's reply (turns are contiguous from 0)."""
    category = "element_at(array({}), cast((case_id + pos) % 8 as int) + 1)".format(", ".join(f"'{c}'" for c in CATEGORIES))
    name = f"concat('f', pos % {names})"
    name = f"if((case_id + pos) % 17 = 0, '', {name})" if gaps else name
    source = f"case when pos % 13 = 0 then null when pos % 11 = 0 then pos div {per_turn} + 100 else pos div {per_turn} end"
    quote = f"substring(get(dialogue, cast(pos div {per_turn} as int)).content, 3, 12)"
    evidence = f"case when pos % 7 = 0 then 'no such quote' when pos % 5 = 0 then '' else {quote} end"
    fact = f"named_struct('category', {category}, 'name', {name}, 'value', concat('v', pos), 'source_turn', cast({source} as int), 'evidence', {evidence})"
    return rows.withColumn("facts", F.expr(f"transform(sequence(0, size(dialogue) * {per_turn} - 1), pos -> {fact})"))


def fact_episodes(spark: SparkSession, sf_dir: str, wide: bool = False) -> DataFrame:
    return with_facts(episodes(spark, sf_dir), 10, 40, False) if wide else with_facts(episodes(spark, sf_dir))


def fingerprinted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return episodes(spark, sf_dir).withColumn("fp", fingerprint(F.col("dialogue")))


def cache_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """0 to 2 entries per case, fresh or stale, in every order."""
    rows = fingerprinted(spark, sf_dir).where("case_id % 3 > 0").select("case_id", "fp", F.explode(F.sequence(F.lit(1), (F.col("case_id") % 3).cast("int"))).alias("i"))
    stale = (F.col("case_id") + F.col("i")) % 2 == 1
    return rows.select("case_id", (F.col("case_id") * 10 + F.col("i")).alias("seq"), F.when(stale, F.concat(F.lit("stale"), F.col("i").cast("string"))).otherwise(F.col("fp")).alias("fp"))


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies of several kinds by case."""
    good = F.to_json(F.struct(F.col("facts")))
    kind = F.col("case_id") % 6
    raw = F.when(kind == 0, good).when(kind == 1, F.concat(F.lit("```json\n"), good, F.lit("\n```"))).when(kind == 2, "{not json").when(kind == 3, "[1, 2]").when(kind == 4, '{"facts": 3}').otherwise('{"facts": [{"name": "x"}, 7]}')
    return fact_episodes(spark, sf_dir).withColumn("raw", raw)


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logged turns: four conversations make the trajectories of a case, embeddings sharpened by turn the beliefs."""
    p = DEFAULTS
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    n = vectors.count()
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", F.length("text").alias("chars"))
    last = turns.groupBy("conv_id").agg(F.max("turn").alias("last"))
    rows = turns.join(last, "conv_id").withColumn("vec_id", F.col("conv_id") % n).join(vectors, "vec_id")
    c, t = F.col("conv_id"), F.col("turn")
    u = F.when((t == F.col("last")) | ((c * 7 + t) % 11 == 0), "DIG").when((c + t) % 4 == 3, "TALK").otherwise("WEN")
    old = -1.0 - ((c * 3 + t) % 10) / 10.0
    return rows.select(
        F.expr("conv_id div 4").alias("case_id"),
        (c % 4).alias("traj_id"),
        t.alias("t"),
        u.alias("u"),
        F.expr("cast(chars div 4 as bigint)").alias("n_tok"),
        beliefs.sharpened(F.col("embedding"), 1 + t).alias("belief"),
        F.expr(f"filter(sequence(0, {p.facts - 1}), k -> k % 9 <= turn and (conv_id + k) % 5 = 0)").alias("confirmed"),
        ((c * 13 + t) % 37 == 0).alias("emergency_hit"),
        old.alias("logp_old"),
        (old + ((c + t) % 7 - 3) / 10.0).alias("logp_new"),
        F.expr(f"transform(sequence(0, {p.atoms - 1}), z -> (z % 10) / 10.0D)").alias("utility"),
        ((c % 3) / 2.0).alias("r_out"),
        F.expr(f"filter(sequence(0, {p.facts - 1}), k -> k % 6 = 0)").alias("required"),
        F.expr(f"transform(sequence(0, {p.facts - 1}), k -> 1.0D + k % 3)").alias("omega"),
        (F.col("last") + 1).alias("real_turns"),
        F.expr("conv_id div 64").alias("batch"),
    )


def rewarded_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_emergency(rewarded(log(spark, sf_dir)))


SPLITS = ["train", "dev", "test"]


def split() -> str:
    return "case when case_id % 10 < 8 then 'train' when case_id % 10 = 8 then 'dev' else 'test' end"


def workspace(spark: SparkSession) -> str:
    """A folder that all executors share, deleted when the driver exits; local masters without one take a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="colloquy-")
    path = f"{base.rstrip('/')}/batch-{uuid.uuid4().hex}"

    @atexit.register
    def gone() -> None:
        with suppress(Exception):  # the session may have ended before
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)

    return path


def write_splits(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """conversations as the batch job's input; the department says the case, for the responder below."""
    case = F.col("case_id").cast("string")
    state = F.struct(F.col("dialogue").alias("full_dialogue"))
    info = F.struct(case.alias("case_id"), F.concat(F.lit("s"), case).alias("sample_id"), state.alias("patient_state"))
    truth = F.struct(F.col("conclusion").alias("reference_conclusion"), F.lit("").alias("department_path"), case.alias("department"))
    rows = episodes(spark, sf_dir).select(F.expr(split()).alias("split"), info.alias("extra_info"), truth.alias("ground_truth"))
    for name in SPLITS:
        rows.where(F.col("split") == name).drop("split").write.parquet(f"{folder}/{name}.parquet")


_ASKED: set[str] = set()


def responder(request: str, instructions: str) -> str:
    """Stands in for a model: a fact per patient turn and one of an unknown category; every seventh case fails, every fifth at first."""
    asked = json.loads(request)
    case = int(asked["department"])
    if case % 7 == 0 or (case % 5 == 1 and request not in _ASKED):
        _ASKED.add(request)
        raise RuntimeError("no answer")
    facts = [{"category": "symptom", "name": f"f{i % 4}", "value": "v", "source_turn": i, "evidence": (t["text"] or "")[:12]} for i, t in enumerate(asked["turns"]) if t["role"] == "patient"]
    return json.dumps({"facts": [*facts, {"category": "lab", "name": "x", "note": "as said"}]})


def silent(request: str, instructions: str) -> str:
    raise RuntimeError("no answer")


#: Occupancy bits of the fixture's centroids.
CENTROIDS = [sum(1 << k for k in range(DEFAULTS.facts) if (k + c) % 4 == 0) for c in range(4)]
