"""The corpus pipeline: ``documents`` through five operators of ``tessera.llm``.

Each stage works on all rows that its predecessor kept, read again from the
Parquet table that the predecessor wrote in the shared folder. The first four
return the columns of ``documents``; the last returns the encoding digests.

1. language: texts that the classifier rejects go (null or without a letter)
2. exact: of texts equal up to white space the longest stays, then the
   smallest doc_id
3. near_duplicates: of each group linked by a Jaccard similarity of 0.8 or
   more on five-word shingles, the row with the smallest doc_id stays
4. decontamination: texts with a benchmark window of ten words go
5. bpe: every text is encoded and decoded
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm.bpe import encoding_digests
from tessera.llm.common import stored, table
from tessera.llm.contamination import decontaminated
from tessera.llm.exact import deduplicated
from tessera.llm.jaccard import one_per_group
from tessera.llm.langid import accepted


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return accepted(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return deduplicated(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encoding_digests(docs)


STAGES = [("language", language), ("exact", exact), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("bpe", bpe)]

#: No stage but exact de-duplication can be told in SQL; tests/llm/test_pipeline.py
#: holds the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
