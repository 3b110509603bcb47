"""The batch job: episodes in, validated facts, cache entries and a report out."""

from __future__ import annotations

import argparse
import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import fingerprint, request
from ..operators import cache, replies, report
from ..operators.facts import FACT, validated
from ..sources import episodes as source

RECORD = f"case_id string, fp string, seq long, facts array<{FACT}>, dropped array<struct<reason:string,fact:string>>"


@dataclass(frozen=True)
class Config:
    input: str
    output: str
    splits: list[str] = field(default_factory=lambda: ["train", "dev", "test"])
    limit: int = 0
    retries: int = 3
    pause: float = 1.0
    #: Also make the fingerprint depend on conclusion and department.
    wide_fingerprint: bool = False
    strict: bool = False


def cache_entries(spark: SparkSession, config: Config) -> DataFrame:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{config.output}/cache")
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.read.schema(RECORD).parquet(str(path))
    return spark.createDataFrame([], RECORD)


def run(spark: SparkSession, config: Config, responder: replies.Responder | None) -> dict:
    """One run; episodes whose last cache entry has their fingerprint aren't asked about again.

    Replies are written before they are used, so that retried tasks of later stages don't ask again.
    """
    found, missing = source.read_splits(spark, config.input, config.splits, config.limit)
    for split in missing:
        print(f"{split} is skipped: no such file")
    if found is None:
        return {"episodes": 0, "failed": 0, "no_facts": 0, "by_category": {}, "drop_reasons": {}}
    more = [F.col("conclusion"), F.col("department")] if config.wide_fingerprint else []
    rows = found.withColumn("fp", fingerprint(F.col("dialogue"), *more))
    entries = cache_entries(spark, config)
    after = entries.agg(F.max("seq")).first()[0]
    asking = cache.misses(rows, entries).withColumn("request", request(F.col("dialogue"), F.col("conclusion"), F.col("department")))
    unique = asking.groupBy("case_id", "fp").agg(F.min("request").alias("request"))
    stage = f"{config.output}/replies"
    try:
        replies.asked(unique, responder, retries=config.retries, pause=config.pause).write.mode("overwrite").parquet(stage)
    except Exception as e:
        if "NotImplementedError: " in str(e):
            raise NotImplementedError("the responder isn't implemented; nothing was written") from e
        raise
    answered = spark.read.parquet(stage)

    rows = cache.with_cache(rows, entries)
    rows = rows.join(answered.select("case_id", "fp", "reply"), ["case_id", "fp"], "left").withColumn("p", replies.parsed(F.col("reply")))
    fresh = validated(rows.withColumn("facts", F.col("p.facts")).withColumn("raw", F.col("p.raw")), config.strict)
    said = F.transform("dropped", lambda d: F.struct(d["reason"].alias("reason"), F.get(F.col("raw"), d["pos"]).alias("fact")))  # as the reply had it
    failed = F.col("cached").isNull() & (F.col("reply").isNull() | (F.col("p.status") != "ok"))
    done = fresh.select(
        "case_id", "sample_id", "split", "fp",
        F.when(failed, "failed").when(F.col("cached").isNotNull(), "cached").otherwise("new").alias("status"),
        F.coalesce("cached.facts", "facts").alias("facts"),
        F.coalesce("cached.dropped", said).alias("dropped"),
    )
    path = f"{config.output}/validated"
    done.write.mode("overwrite").parquet(path)
    done = spark.read.parquet(path)
    new = done.where("status = 'new'").dropDuplicates(["case_id", "fp"]).select("case_id", "fp", "facts", "dropped")
    cache.append(cache.numbered(new, -1 if after is None else after).select("case_id", "fp", "seq", "facts", "dropped"), f"{config.output}/cache")
    source.write_results(done, f"{config.output}/facts")
    return report.write_report(done, f"{config.output}/_facts_report.json")


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description="Validate key facts of consultations.")
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--splits", nargs="+", default=["train", "dev", "test"])
    parser.add_argument("--limit", type=int, default=0)
    parser.add_argument("--retries", type=int, default=3)
    parser.add_argument("--pause", type=float, default=1.0, help="seconds before the second attempt; later ones wait twice as long each")
    parser.add_argument("--strict", action="store_true", help="empty evidence never passes")
    parser.add_argument("--wide-fingerprint", action="store_true", help="conclusion and department are part of the fingerprint")
    parser.add_argument("--responder", help="module:function of (request, instructions)")
    a = parser.parse_args(arguments)
    responder = None
    if a.responder:
        import importlib

        module, _, name = a.responder.partition(":")
        responder = getattr(importlib.import_module(module), name)
    spark = SparkSession.builder.getOrCreate()
    print(json.dumps(run(spark, Config(a.input, a.output, a.splits, a.limit, a.retries, a.pause, a.wide_fingerprint, a.strict), responder), ensure_ascii=False, indent=2))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
