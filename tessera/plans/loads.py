"""Database loads (J3 relational, J4 column store).

J3 loads the exported rows as they are (no cleaning) and replaces the table; a
load that fails leaves the old table. J4 cleans (C8), sorts (O5) and appends,
so a second run adds the rows again, unless it has the first one's load id.
Row counts come from ``observe``, collected while the write runs, not from a
second pass over the data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tessera.operators.quality import clean_for_warehouse
from tessera.schemas import DEFAULT_TABLE
from tessera.sinks.tables import append_columnar, loadable, replace_table
from tessera.sources.files import load_parquet_exports


@dataclass
class LoadResult:
    rows: int | None  # rows written; None when the guards stopped the load
    files: int  # Parquet part files read (A7)


def _counted(df: DataFrame, name: str):
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def load_relational(spark: SparkSession, parquet_dir: str, *, path: str | None = None, jdbc: dict | None = None, table: str = DEFAULT_TABLE, schema=None, catalog: bool = False) -> LoadResult:
    """Rows written (None when nothing was written) and files read."""
    df, files = load_parquet_exports(spark, parquet_dir, schema)  # S3, S6, A7
    if not loadable(df):  # C10, C11
        return LoadResult(None, files)
    counted, obs = _counted(df, "relational_load")
    replace_table(counted, path=path, jdbc=jdbc, table=table, guard=False, catalog=catalog)  # K6
    return LoadResult(obs.get["rows"], files)


def load_columnar(
    spark: SparkSession,
    parquet_dir: str,
    *,
    path: str | None = None,
    jdbc: dict | None = None,
    table: str = DEFAULT_TABLE,
    schema=None,
    load_id: str | None = None,
    catalog: bool = False,
) -> LoadResult:
    """Rows appended and files read (``load_id``, ``catalog``: see ``append_columnar``)."""
    df, files = load_parquet_exports(spark, parquet_dir, schema)  # S3, S6, A7
    clean = clean_for_warehouse(df)  # C8
    obs = Observation("columnar_load")
    append_columnar(clean, path=path, jdbc=jdbc, table=table, observation=obs, load_id=load_id, catalog=catalog)  # O5, K7
    return LoadResult(obs.get["rows"], files)
