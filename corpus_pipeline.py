"""From documents to tokens: language ID, near duplicates, personal data, source mixing, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which run() writes as Parquet and reads again as the next
stage's docs.  All but the last return the columns of documents; the last also says where in the mixing order a document is.  Empty
input gives empty output; rows are told apart by their place in the files, so rows that share a doc_id, or have none, are documents of their own.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from colloquy.llm import bpe, jaccard, langid, mixing, pii
from colloquy.llm.common import drop_stored, fresh, ship, stored, table, with_row_ids, working

#: Near duplicates: shingles of five words, similarity 0.8.
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80
#: Rows to be left out (16 bytes each) that are broadcast at most; more are joined by shuffle.
BROADCAST_GONE = 500_000
#: The session setting that holds the key of the pseudonyms.
KEY_SETTING = "spark.colloquy.pii.key"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (no text, no letters) go; lang becomes the predicted one."""
    ship(spark)
    found = langid.predict(docs, langid.train(docs), whole=True).where(F.col("lang_pred") != "und")
    return found.withColumn("lang", F.col("lang_pred")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the row with the smallest doc_id stays (null ids last; ties: the first row)."""
    ship(spark)
    file, row = fresh(docs, "file"), fresh(docs, "row")
    rows = with_row_ids(docs, file=file, row=row)
    with working() as held:
        groups = jaccard.jaccard_groups(rows, k=SHINGLE_WORDS, percent=SIMILAR_PERCENT, keep=(file, row)).where(F.col("group").isNotNull())
        place = F.struct(F.col("doc_id").isNull(), "doc_id", file, row)
        best = groups.groupBy("group").agg(F.min(place).alias("best"), F.count("*").alias("rows")).where("rows > 1").select("group", "best")
        gone = held.keep(stored(groups.join(best, "group").where(place != F.col("best")).select(file, row)))
    few = gone.count() <= BROADCAST_GONE
    return rows.join(F.broadcast(gone) if few else gone, [file, row], "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by pseudonyms under the key that the session's KEY_SETTING names; n_chars follows the text."""
    out = pii.replace_pii(docs, spark.conf.get(KEY_SETTING, pii.KEY))
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the order of the Pfair schedule of their sources, at its default weights; all stay, and the next stage numbers them in this order."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with the digests of ids and decoded text, and the document's position in the order of docs."""
    ship(spark)
    return bpe.encode_documents(positioned(docs), bpe.tokenizer_path(), ids=True, keep=("position",))


def positioned(docs: DataFrame) -> DataFrame:
    """docs with position, from 0 on: by file, in the order of their numbers, and row in it, since scans pack files by size.

    Rows that no Parquet file holds are stored first, as the DataFrame has them.
    """
    try:
        place = docs.metadataColumn("_metadata")
    except AnalysisException:
        docs = stored(docs.select("doc_id", "text"))
        place = docs.metadataColumn("_metadata")
    name = place["file_name"]
    rows = docs.select(docs["doc_id"], docs["text"], F.struct(F.length(name), name).alias("file"), place["row_index"].alias("row"))
    before = Window.partitionBy(F.lit(1)).orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    files = rows.groupBy("file").agg(F.count("*").alias("n")).select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    return rows.join(F.broadcast(files), "file").select("doc_id", "text", (F.col("first") + F.col("row")).alias("position"))


STAGES = [
    ("language_id", language),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixing", mix),
    ("bpe", encode),
]
#: Trained models, groups of links and merges have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        with working() as held:
            docs = held.keep(stored(stage(spark, docs, sf_dir)))
        if before is not None:
            drop_stored(before)
        before = docs
    return docs
