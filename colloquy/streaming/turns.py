"""Dialogues that arrive turn by turn (an extension: the batch method has no streams).

Each micro-batch is written under its own number, so a batch that runs again replaces itself; the dialogues it touches are
assembled anew from all their turns.  current() is the newest version of every dialogue, and a fingerprint that changed tells
the cache to extract again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import fingerprint
from ..sources.episodes import from_conversations

TURNS = "conv_id long, turn long, role string, text string"


def follow(turns: DataFrame, store: str, once: bool = True) -> StreamingQuery:
    """Start a query that keeps the dialogues under store up to date with a stream of turns; with once=True it stops when what is there is done."""
    spark = turns.sparkSession

    def arrived(batch: DataFrame, number: int) -> None:
        batch.select("conv_id", "turn", "role", "text").write.mode("overwrite").parquet(f"{store}/turns/batch={number}")
        # turns that a source delivers twice count once
        known = spark.read.schema(TURNS + ", batch long").parquet(f"{store}/turns").where(F.col("batch") <= number)
        touched = spark.read.schema(TURNS).parquet(f"{store}/turns/batch={number}").select("conv_id").distinct()
        latest = known.join(touched, "conv_id", "left_semi").groupBy("conv_id", "turn").agg(F.max_by(F.struct("role", "text"), "batch").alias("t"))
        rows = from_conversations(latest.select("conv_id", "turn", "t.role", "t.text"))
        rows.withColumn("fp", fingerprint(F.col("dialogue"))).write.mode("overwrite").parquet(f"{store}/episodes/batch={number}")

    writer = turns.writeStream.foreachBatch(arrived).option("checkpointLocation", f"{store}/progress")
    return (writer.trigger(availableNow=True) if once else writer).start()


def current(spark: SparkSession, store: str) -> DataFrame:
    """case_id, dialogue, conclusion, fp of every dialogue as of the last batch that touched it."""
    rows = spark.read.parquet(f"{store}/episodes")
    return rows.groupBy("case_id").agg(F.max_by(F.struct("dialogue", "conclusion", "fp"), "batch").alias("e")).select("case_id", "e.*")


def counts(turns: DataFrame, lateness: str = "10 minutes", window: str = "5 minutes") -> DataFrame:
    """Turns per window and role of a stream with a timestamp column ts; windows close once the watermark has passed."""
    return turns.withWatermark("ts", lateness).groupBy(F.window("ts", window), "role").agg(F.count("*").alias("n"))
