"""Counts over validated episodes."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def by_category(episodes: DataFrame) -> DataFrame:
    return episodes.select(F.explode("facts.category").alias("category")).groupBy("category").agg(F.count("*").alias("n"))


def by_reason(episodes: DataFrame) -> DataFrame:
    return episodes.select(F.explode("dropped.reason").alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def counters(episodes: DataFrame) -> DataFrame:
    """Episodes attempted, failed, and with no fact kept (failed ones not counted among these)."""
    failed = F.col("status") == "failed" if "status" in episodes.columns else F.lit(False)
    return episodes.agg(F.count("*").alias("episodes"), F.count_if(failed).alias("failed"), F.count_if(~failed & (F.size("facts") == 0)).alias("no_facts"))


def report(episodes: DataFrame) -> DataFrame:
    """One row: the counters and two maps."""
    as_map = lambda df, key: df.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, "n")))).alias("m"))
    ok = episodes.where(F.col("status") != "failed") if "status" in episodes.columns else episodes
    one = F.lit(1)
    categories, reasons = as_map(by_category(ok), "category"), as_map(by_reason(ok), "reason")
    rows = counters(episodes).withColumn("k", one)
    rows = rows.join(categories.select(one.alias("k"), F.col("m").alias("by_category")), "k").join(reasons.select(one.alias("k"), F.col("m").alias("drop_reasons")), "k")
    return rows.drop("k")


def write_report(episodes: DataFrame, path: str) -> dict:
    """The report as indented JSON in one file, and as a dict."""
    out = report(episodes).first().asDict(recursive=True)
    spark = episodes.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    stream.write((json.dumps(out, ensure_ascii=False, indent=2) + "\n").encode("utf-8"))
    stream.close()
    return out
