import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
)


@pytest.fixture
def make_docs(spark):
    """A documents table of (doc_id, text[, lang]) rows, with columns whose
    names clash with the operators' own."""

    def make(rows, parts: int = 3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, DOCS).repartition(parts)
        for name in ("row", "rep", "hash", "size", "hits", "_sha", "n_words"):
            df = df.selectExpr("*", f"'clash' AS `{name}`")
        return df

    return make


@pytest.fixture(scope="session")
def sf001_texts(spark, sf001):
    rows = spark.read.parquet(f"{sf001}/documents.parquet").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] for r in rows}
