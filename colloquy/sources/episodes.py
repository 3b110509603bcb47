"""Where dialogues come from and where results go."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import or_empty

TURN = T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])
EPISODE = T.StructType(
    [
        T.StructField(
            "extra_info",
            T.StructType(
                [
                    T.StructField("case_id", T.StringType()),
                    T.StructField("sample_id", T.StringType()),
                    T.StructField("patient_state", T.StructType([T.StructField("full_dialogue", T.ArrayType(TURN))])),
                ]
            ),
        ),
        T.StructField("ground_truth", T.StructType([T.StructField(n, T.StringType()) for n in ("reference_conclusion", "department_path", "department")])),
    ]
)
#: conversations' roles as dialogue roles; others stay, so that turn positions hold.
ROLES = {"user": "patient", "assistant": "doctor"}


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    """case_id, sample_id, split, dialogue, conclusion, department, and the row's place in its file."""
    rows = spark.read.schema(EPISODE).parquet(path)
    truth = F.col("ground_truth")
    return rows.select(
        F.col("extra_info.case_id").alias("case_id"),
        F.col("extra_info.sample_id").alias("sample_id"),
        F.lit(split).alias("split"),
        F.col("extra_info.patient_state.full_dialogue").alias("dialogue"),
        or_empty(truth["reference_conclusion"]).alias("conclusion"),
        or_empty(truth["department_path"], truth["department"]).alias("department"),
        F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")).alias("place"),
    )


def read_splits(spark: SparkSession, folder: str, splits: list[str], limit: int = 0) -> tuple[DataFrame | None, list[str]]:
    """All splits that are there, each up to limit episodes in file order (0: all), and the names of the missing ones."""
    found, missing = None, []
    files = spark._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    for split in splits:
        path = f"{folder.rstrip('/')}/{split}.parquet"
        if not files.exists(spark._jvm.org.apache.hadoop.fs.Path(path)):
            missing.append(split)
            continue
        rows = first_rows(read_split(spark, path, split), limit, F.col("place"))
        found = rows if found is None else found.unionByName(rows)
    return found, missing


def first_rows(rows: DataFrame, limit: int, *order: Column) -> DataFrame:
    """The first rows in an order; 0 keeps all.  A top-k selection, not a sort of everything."""
    if limit < 0:
        raise ValueError("a limit must not be negative")
    return rows.orderBy(*order).limit(limit) if limit else rows


def first_per_group(rows: DataFrame, limit: int, group: str, *order: Column) -> DataFrame:
    """The first rows of each group; Spark cuts groups down before it shuffles them (window group limit)."""
    if limit < 0:
        raise ValueError("a limit must not be negative")
    if not limit:
        return rows
    place = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return rows.withColumn("place_", place).where(F.col("place_") <= limit).drop("place_")


def from_conversations(turns: DataFrame) -> DataFrame:
    """Episodes from (conv_id, turn, role, text): case_id, dialogue, conclusion (the last assistant turn, or '')."""
    role = F.col("role")
    for there, here in ROLES.items():
        role = F.when(F.col("role") == there, F.lit(here)).otherwise(role)
    turn = F.struct("turn", role.alias("role"), F.col("text").alias("content"))
    rows = turns.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(turn)).alias("turns"),
        F.max(F.when(F.col("role") == "assistant", F.struct("turn", "text"))).alias("last"),
    )
    return rows.select(
        F.col("conv_id").alias("case_id"),
        F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content"))).alias("dialogue"),
        or_empty(F.col("last.text")).alias("conclusion"),
    )


def write_results(rows: DataFrame, path: str) -> None:
    """JSON lines, a folder per split, replacing earlier ones; failed episodes are left out, and dropped facts are written as the reply had them."""
    kept = rows.where(F.col("status") != "failed") if "status" in rows.columns else rows
    dropped = F.transform("dropped", lambda d: F.struct(d["reason"].alias("reason"), F.parse_json(d["fact"]).alias("fact")))
    kept.select("case_id", "sample_id", "split", "facts", dropped.alias("dropped")).write.mode("overwrite").partitionBy("split").json(path)
