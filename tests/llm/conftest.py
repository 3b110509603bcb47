import pytest

SHAPE = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Makes a documents table from (doc_id, text[, lang[, source]]) rows."""

    def make(*rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, r[3] if len(r) > 3 else None, None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, SHAPE)

    return make


@pytest.fixture
def folder(spark, documents, tmp_path):
    """Writes documents (and labels) rows where a query reads them."""

    def write(rows, labels=()):
        documents(*rows).write.parquet(f"file://{tmp_path}/documents.parquet")
        spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"file://{tmp_path}/labels.parquet")
        return f"file://{tmp_path}"

    return write
