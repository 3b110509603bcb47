"""A bounded sample of labelled texts, for the operators that learn from labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash_share


def sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int, fold: Column | None = None) -> DataFrame:
    """(doc_id, text, label) of about max_rows labelled documents in expectation, chosen by a hash of doc_id.

    Rows without a label or text are left out, repeated ones count each time; fold is a condition on doc_id.  The
    chosen labels are bounded and broadcast, so the texts aren't shuffled.
    """
    labels = labels.select("doc_id", F.col(label).cast("int").alias("label")).where(F.col("label").isNotNull())
    if fold is not None:
        labels = labels.where(fold)
    chosen = labels.where(hash_share("doc_id", min(1.0, max_rows / max(1, labels.count()))))
    return docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(chosen), "doc_id")
