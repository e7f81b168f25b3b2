"""Operator 10: exact de-duplication by Grace hashing.

Two texts are equal when identical after deleting the white space
``[\\x20\\x09-\\x0D]``. The operator partitions records by a hash of the
normalised text until each bucket fits a table in memory that compares the
complete content:

1. Each scan task keeps a bounded table of the texts it has met and sends on
   one *representative* per distinct text with the count and the best row of
   its copies, so a text that holds a third of all rows leaves a task once.
   A task whose table is full sends each further new text on once a batch.
2. The representatives are hash-partitioned by a shuffle (its files are the
   spill files). Each bucket fills a bounded table; a text that no longer fits
   overflows to a table in the shared folder, which is partitioned again with
   another hash, recursively, until nothing overflows. A text found in the
   table is always counted there and a text that overflowed always overflows,
   so every bucket's groups are complete.
3. Every row joins its group over the representative's number. A number
   belongs to the rows of one scan task, hence no join key is hot, and no two
   texts are taken as equal on a digest alone.

The table is a Python ``dict`` keyed by the text: an open-addressing hash
table that compares whole keys.

Of equal texts the row with the most code points in the original text stays,
then the smallest doc_id (null last), then the earliest row as scanned.
Defined results: null text counts as empty, and all empty texts are equal;
repeated rows are rows of their own of which one stays; an empty table gives
no rows; other input columns are ignored here, and kept by ``deduplicated``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import shuffle_partitions, stored, table, trimmed

#: Bytes of text (UTF-8, with an allowance per entry) that one table holds.
TABLE_BYTES = 64 << 20
ENTRY_BYTES = 300
#: The characters that do not count, plain list.
WHITE = " \t\n\x0b\x0c\r"

_SCAN = "doc_id bigint, row bigint, rep bigint, sha string, raw_sha string, text string, size bigint, n bigint, best_chars int, best_id bigint, best_row bigint"
_GROUPS = "rep bigint, keep_id bigint, keep_row bigint, group_size bigint, text string, size bigint, n bigint, best_chars int, best_id bigint, best_row bigint"
_LAST = (1 << 63) - 1


def _better(a: tuple, b: tuple) -> tuple:
    """Of (code points, doc_id, row), the one that stays."""
    return min(a, b, key=lambda x: (-x[0], _LAST if x[1] is None else x[1], x[2]))


def _scan_task(table_bytes: int):
    """Per row: its number, its representative's number and its digest; per
    representative: its text, count and best row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[str, list] = {}  # text -> [representative, copies, best]
        held = 0
        for batch in batches:
            doc_id, row, text, chars, sha, raw_sha = batch.columns
            ids, rows, counts = doc_id.to_pylist(), row.to_pylist(), chars.to_pylist()
            reps: list[int] = []
            beyond: dict[str, list] = {}  # what the full table lacks, collapsed within the batch
            for i, key in enumerate(text.to_pylist()):
                mine = (counts[i], ids[i], rows[i])
                group = groups.get(key) or beyond.get(key)
                if group is not None:
                    group[1] += 1
                    group[2] = _better(group[2], mine)
                else:
                    group = [rows[i], 1, mine]
                    if held < table_bytes:
                        groups[key] = group
                        held += len(key) + ENTRY_BYTES
                    else:
                        beyond[key] = group
                reps.append(group[0])
            nothing = [None] * len(reps)
            yield _batch(_SCAN, [ids, rows, reps, sha.to_pylist(), raw_sha.to_pylist(), *[nothing] * 6])
            yield from _representatives((g[0], key, g[1], g[2]) for key, g in beyond.items())
        yield from _representatives((g[0], key, g[1], g[2]) for key, g in groups.items())

    return run


def _representatives(found) -> Iterator[pa.RecordBatch]:
    part: list[tuple] = []
    size = 0
    for rep, text, n, best in found:
        part.append((None, None, rep, None, None, text, len(text), n, *best))
        size += len(text)
        if size > 8 << 20:
            yield _batch(_SCAN, list(zip(*part)))
            part, size = [], 0
    if part:
        yield _batch(_SCAN, list(zip(*part)))


_TYPES = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}


def _batch(schema: str, columns: list) -> pa.RecordBatch:
    fields = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, _TYPES[t]) for c, (_, t) in zip(columns, fields)], [n for n, _ in fields])


def _bucket_task(table_bytes: int):
    """Groups of one bucket; texts beyond the table's bound overflow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[str, list] = {}  # text -> [representatives, copies, best]
        held = 0
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            over: list[tuple] = []
            for rep, text, size, n, *best in zip(*columns):
                best = tuple(best)
                group = groups.get(text)
                if group is not None:
                    group[0].append(rep)
                    group[1] += n
                    group[2] = _better(group[2], best)
                elif held < table_bytes:
                    groups[text] = [[rep], n, best]
                    held += len(text) + ENTRY_BYTES
                else:
                    over.append((rep, None, None, None, text, size, n, *best))
            if over:
                yield _batch(_GROUPS, list(zip(*over)))
        part: list[tuple] = []
        for reps, n, (_, keep_id, keep_row) in groups.values():
            for rep in reps:
                part.append((rep, keep_id, keep_row, n, *[None] * 6))
                if len(part) >= 20_000:
                    yield _batch(_GROUPS, list(zip(*part)))
                    part = []
        if part:
            yield _batch(_GROUPS, list(zip(*part)))

    return run


def exact_groups(docs: DataFrame, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per input row: doc_id, row, keep_id, keep_row, group_size,
    text_sha256 (normalised), raw_sha256 (original text).

    ``row`` numbers the rows of this run; ``row = keep_row`` marks the rows that stay.
    """
    normal = F.translate(F.col("text"), WHITE, "")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    ).select("doc_id", "row", normal.alias("text"), F.char_length("text").alias("chars"), F.sha2(normal, 256).alias("sha"), F.sha2("text", 256).alias("raw_sha"))
    # Written once: the row numbers and representatives below all come from
    # this table, whatever is lost or run again later.
    scanned = stored(rows.mapInArrow(trimmed(_scan_task(table_bytes)), _SCAN), "exact-scan")
    records = scanned.where(F.col("text").isNotNull()).select("rep", "text", "size", "n", "best_chars", "best_id", "best_row")
    groups, level = None, 0
    while True:
        total = records.agg(F.sum(F.col("size") + ENTRY_BYTES)).first()[0]
        if not total:
            break
        buckets = max(shuffle_partitions(docs.sparkSession), -(-2 * total // table_bytes))
        dealt = records.repartition(int(buckets), F.xxhash64(F.lit(level), "text"))
        found = stored(dealt.mapInArrow(trimmed(_bucket_task(table_bytes)), _GROUPS), f"exact-groups-{level}")
        done = found.where(F.col("text").isNull()).select("rep", "keep_id", "keep_row", "group_size")
        groups = done if groups is None else groups.unionByName(done)
        records = found.where(F.col("text").isNotNull()).select("rep", "text", "size", "n", "best_chars", "best_id", "best_row")
        level += 1
    every = scanned.where(F.col("row").isNotNull()).select("doc_id", "row", "rep", F.col("sha").alias("text_sha256"), F.col("raw_sha").alias("raw_sha256"))
    if groups is None:
        return every.select("doc_id", "row", F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"), F.lit(1).cast("long").alias("group_size"), "text_sha256", "raw_sha256").limit(0)
    return every.join(groups, "rep").select("doc_id", "row", "keep_id", "keep_row", "group_size", "text_sha256", "raw_sha256")


def deduplicated(docs: DataFrame, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows are matched by doc_id and a digest of the original text; of rows that
    agree in both, one stays."""
    groups = exact_groups(docs, table_bytes)
    longest = max(map(len, docs.columns))
    own_id, own_raw = (x.ljust(longest + 1, "_") for x in ("id", "raw"))  # longer than any column's name
    raw = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
    kept = groups.where(F.col("row") == F.col("keep_row")).select(F.col("doc_id").alias(own_id), F.col("raw_sha256").alias("raw"))
    marked = docs.withColumn(own_raw, raw)
    chosen = marked.join(kept, F.col("doc_id").eqNullSafe(F.col(own_id)) & (F.col(own_raw) == kept["raw"]), "left_semi")
    repeated = groups.groupBy("doc_id", "raw_sha256").count().where("count > 1")
    if not repeated.isEmpty():  # else no row has a copy with its own doc_id, and nothing is left to drop
        chosen = chosen.dropDuplicates(["doc_id", own_raw])
    return chosen.drop(own_raw)


def op10_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256")


#: The query's contract in DuckDB SQL.
OP10_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS raw,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
), w AS (
  SELECT doc_id, sha256(norm) AS text_sha256, count(*) OVER (PARTITION BY norm) AS group_size,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(raw) DESC, doc_id NULLS LAST) AS keep_id
  FROM t
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM w
"""
