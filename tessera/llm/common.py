"""Shared helpers of the corpus operators: table access, shared-folder tables,
and the vectorised word stream that several operators read texts through.

A *word* here is a maximal run of the characters ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``
after lower-casing A-Z: digits, a-z and every non-ASCII character. In UTF-8
that is a property of single bytes, so whole batches of texts are split with
array operations on the bytes Arrow delivers, without a loop over words.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tessera.session import scratch_path

#: The words of column ``text`` as a list, in DuckDB SQL (for the oracles).
WORDS_SQL = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

#: Bytes of text that one round of array work takes (a longer text goes alone).
SLICE_BYTES = 2 << 20
SLICE_ROWS = 1 << 15


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str, partitions: int | None = None) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and return its reader.

    This cuts the lineage: what a lost executor held is read again from the
    table. The folder is left to the owner of ``spark.checkpoint.dir``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    (df.coalesce(partitions) if partitions else df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # GNU libc has it
    if trim is not None:
        trim(0)


def trimmed(run: Callable) -> Callable:
    """``run`` as a task that gives freed memory back to the system when it
    ends: workers are pooled, and an idle one still counts on its executor."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            _give_back()

    return task


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash (avalanche), element by element."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(32))


def _lower_table() -> np.ndarray:
    lut = np.zeros(256, np.uint8)
    keep = [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]
    lut[keep] = keep
    lut[0x41:0x5B] = np.arange(0x61, 0x7B)
    return lut


LOWER = _lower_table()
_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
_VALUES[0] = 0  # a byte outside words
_BASE = 0x5851F42D4C957F2D
#: Bytes that one round of hashing takes; its power tables are all that a worker keeps.
HASH_BYTES = 1 << 17
_POWERS: list[tuple[np.ndarray, np.ndarray]] = []


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    tables = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(size, base, np.uint64)
        p[0] = 1
        tables.append(np.multiply.accumulate(p))
    return tables[0], tables[1]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n > HASH_BYTES + 1:  # for a single word longer than a round
        return _power_tables(n)
    if not _POWERS:
        _POWERS.append(_power_tables(HASH_BYTES + 1))
    return _POWERS[0]


def _hashes(low: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each word ``low[start:end]``, in rounds of some ``HASH_BYTES``."""
    out = np.empty(len(start), np.uint64)
    a = 0
    while a < len(start):
        b = max(a + 1, int(np.searchsorted(end, start[a] + HASH_BYTES, "right")))
        base = start[a]
        part = low[base : end[b - 1]]
        power, inverse = _powers(len(part) + 1)
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_VALUES[part] * power[: len(part)], out=total[1:])
        lo = start[a:b] - base
        out[a:b] = mix((total[end[a:b] - base] - total[lo]) * inverse[lo])
        a = b
    return out


class Words:
    """The words of several texts: hash, byte bounds and index of the text."""

    __slots__ = ("hash", "doc", "start", "end", "per_doc")

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        n, docs = len(data), len(offsets) - 1
        low = LOWER[data]
        inside = np.zeros(n + 2, np.int8)
        inside[1:-1] = low > 0
        first, last = inside[1:] > inside[:-1], inside[1:] < inside[:-1]
        cut = offsets[1:-1]
        cut = cut[(cut > 0) & (cut < n)]
        joined = cut[(inside[cut] == 1) & (inside[cut + 1] == 1)]  # a word ends where its text ends
        first[joined] = last[joined] = True
        self.start, self.end = np.flatnonzero(first), np.flatnonzero(last)
        self.hash = _hashes(low, self.start, self.end)
        self.doc = np.searchsorted(offsets, self.start, "right") - 1
        self.per_doc = np.bincount(self.doc, minlength=docs)


def word_hashes(text: str) -> np.ndarray:
    """Hashes of one text's words, in order."""
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    return Words(data, np.array([0, len(data)])).hash


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column into runs of rows of about ``limit`` bytes:
    first row, end row, their bytes, and the rows' offsets in these bytes.
    Null counts as empty. Nothing is left out; a long text is a run of its own."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, bounds, content = column.buffers()
    offsets = np.frombuffer(bounds, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(content, np.uint8) if content is not None and content.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = min(max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1), lo + SLICE_ROWS)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi
