"""The cache of validated records, keyed by case and by the dialogue's fingerprint."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def last_entries(entries: DataFrame) -> DataFrame:
    """Of each case the entry appended last (by seq).  One aggregate: the row is carried through the map side."""
    columns = [c for c in entries.columns if c not in ("case_id", "seq")]
    rows = entries.groupBy("case_id").agg(F.max_by(F.struct("seq", *columns), "seq").alias("e"))
    return rows.select("case_id", "e.*")


def with_cache(episodes: DataFrame, entries: DataFrame, fingerprint: str = "fp") -> DataFrame:
    """Episodes with cached: the case's last entry if its fingerprint is the episode's, else null.

    An older entry with the right fingerprint doesn't count once another one follows it.
    """
    last = last_entries(entries)
    held = F.struct(*(F.col(f"c.{c}").alias(c) for c in last.columns if c != "case_id"))
    rows = episodes.alias("e").join(last.alias("c"), F.col("e.case_id") == F.col("c.case_id"), "left")
    return rows.select("e.*", F.when(F.col(f"c.{fingerprint}") == F.col(f"e.{fingerprint}"), held).alias("cached"))


def misses(episodes: DataFrame, entries: DataFrame, fingerprint: str = "fp") -> DataFrame:
    return episodes.join(last_entries(entries).select("case_id", fingerprint), ["case_id", fingerprint], "left_anti")


def cases_in_several_splits(episodes: DataFrame) -> DataFrame:
    """Cases whose single cache slot several splits would write."""
    return episodes.groupBy("case_id").agg(F.count_distinct("split").alias("splits")).where("splits > 1")


def numbered(entries: DataFrame, after: int = -1) -> DataFrame:
    """Entries with seq continuing after that of the last run; case by case, so that nothing is gathered in one task."""
    place = F.row_number().over(Window.partitionBy("case_id").orderBy("fp"))
    return entries.withColumn("seq", F.lit(after).cast("long") + place)


def append(entries: DataFrame, path: str) -> None:
    entries.write.mode("append").parquet(path)
