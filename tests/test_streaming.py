from pyspark.sql import functions as F

from colloquy.functions.text import fingerprint
from colloquy.sources.episodes import from_conversations
from colloquy.streaming import turns


def test_arriving_turns_equal_the_batch(spark, tmp_path):
    first = [(1, 0, "user", "a"), (2, 0, "user", "x"), (1, 1, "assistant", "b")]
    second = [(1, 2, "user", "c"), (3, 0, "assistant", "z"), (1, 0, "user", "a")]  # one turn twice
    source, store = f"file://{tmp_path}/in", f"file://{tmp_path}/store"
    for rows in (first, second):
        spark.createDataFrame(rows, turns.TURNS).coalesce(1).write.mode("append").parquet(source)
        turns.follow(spark.readStream.schema(turns.TURNS).parquet(source), store).awaitTermination()
    whole = from_conversations(spark.createDataFrame([*first, *second[:2]], turns.TURNS)).withColumn("fp", fingerprint(F.col("dialogue")))
    assert sorted(turns.current(spark, store).collect(), key=lambda r: r.case_id) == sorted(whole.collect(), key=lambda r: r.case_id)
    assert {r.case_id: r.conclusion for r in whole.collect()} == {1: "b", 2: "", 3: "z"}
