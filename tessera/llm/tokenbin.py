"""Operator 13: token ids in binary segments with Elias-Fano document boundaries.

Texts are encoded, closed with an end id and concatenated in ascending doc_id
order. A *segment* is one binary value: a header, the ids in the narrowest
width that the vocabulary needs (2 bytes up to 65,536 tokens), and the ends of
its documents as an Elias-Fano sequence: of each end the low ``l`` bits are
packed side by side, the high bits set one bit each in a bitmap of about 2n
bits, so n ends below u take about ``n * (2 + log2(u / n))`` bits. A select
sample (32 bits) for each ``SAMPLE`` ends tells where in the bitmap to start
counting; no table of 64-bit offsets is stored or built.

``write_ids`` lays the texts out by range of doc_id (one exchange of the texts,
before they are encoded) and writes the segments as a Parquet table, so that
file commits, retries and remote paths are Spark's; ``read_ids`` reads a folder
back and places each segment by running sums over the segments' sizes, per
range first, then over the ranges. Neither collects anything.

Encoding works on whole rounds of text: a round's bytes are cut at ASCII white
space, equal words are grouped by hash and compared byte for byte, each
distinct word is encoded once (``merges.WordEncoder``), and the ids are gathered
by array indexing. ``bpe.check_tokenizer`` makes sure that a
tokenizer drops white space and never merges across it.

Defined results: null text counts as empty, which has the end id only; null
doc_ids come first; rows of one doc_id follow each other by the text's hash,
then as scanned, so repeated rows are documents of their own and one doc_id
that holds a third of all rows is spread over ranges; an empty table gives no
rows; other input columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.bpe import check_tokenizer, default_tokenizer_path
from tessera.llm.common import shuffle_partitions, table, text_slices, trimmed
from tessera.llm.merges import WordEncoder, grouped, runs, words_at
from tessera.session import scratch_path

END_ID = 2
#: Ids after which a segment is closed; a longer document is a segment of its own.
SEGMENT_IDS = 2 << 20
#: Ends between two select samples.
SAMPLE = 128
#: Bytes of text (UTF-8) that one range is planned for, and of one round of encoding.
RANGE_BYTES = 64 << 20
ROUND_BYTES = 4 << 20
#: Bytes of the segments' starts up to which they are sent to all tasks, and of one start.
BROADCAST_BYTES, START_BYTES = 16 << 20, 32

_SEGMENTS = "part int, segment int, n_docs bigint, n_ids bigint, doc_ids array<bigint>, payload binary"
_HEADER = struct.Struct("<4sBBHQQ")  # magic, id width, low bits, ends between samples, documents, ids
_MAGIC = b"EFT1"


class EliasFano:
    """Ascending numbers below ``2 ** 32``, with ``select(i)`` for the i-th."""

    __slots__ = ("n", "bits", "low", "high", "samples", "every")

    def __init__(self, n: int, bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray, every: int = SAMPLE):
        self.n, self.bits, self.low, self.high, self.samples, self.every = n, bits, low, high, samples, every

    @classmethod
    def encode(cls, values: np.ndarray, every: int = SAMPLE) -> EliasFano:
        n = len(values)
        top = int(values[-1]) if n else 0
        bits = max(0, (top // n).bit_length() - 1) if n else 0
        values = values.astype(np.uint64)
        ones = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(-(-(int(ones[-1]) + 1 if n else 1) // 64) * 8, np.uint8)
        np.bitwise_or.at(high, ones >> 3, (1 << (ones & 7)).astype(np.uint8))
        places = (values[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
        low = np.packbits(places.astype(np.uint8).ravel(), bitorder="little")
        return cls(n, bits, np.concatenate([low, np.zeros(8, np.uint8)]), high.view("<u8"), ones[::every].astype("<u4"), every)

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), np.int64)
        at = i * self.bits
        window = np.lib.stride_tricks.sliding_window_view(self.low, 8)[at >> 3]
        word = np.ascontiguousarray(window).view("<u8").ravel()
        return ((word >> (at & 7).astype(np.uint64)) & np.uint64((1 << self.bits) - 1)).astype(np.int64)

    def select(self, i: np.ndarray) -> np.ndarray:
        """The values at the places ``i``: from the sample before a place on,
        whole words of the bitmap are counted until its bit is in the word."""
        i = np.asarray(i, np.int64)
        if len(i) and (i.min() < 0 or i.max() >= self.n):
            raise IndexError("no such value")
        start = self.samples[i // self.every].astype(np.int64)
        word = start >> 6
        left = i % self.every  # ones to pass, from the sample's own on
        now = self.high[word] & (np.uint64(0xFFFFFFFFFFFFFFFF) << (start & 63).astype(np.uint64))
        open_ = np.arange(len(i))
        while len(open_):
            ones = np.bitwise_count(now[open_]).astype(np.int64)
            on = ones <= left[open_]
            open_, ones = open_[on], ones[on]
            left[open_] -= ones
            word[open_] += 1
            now[open_] = self.high[word[open_]]
        bit = np.zeros(len(i), np.int64)
        for width in (32, 16, 8, 4, 2, 1):  # halve the word until one bit is left
            half = (now >> bit.astype(np.uint64)) & np.uint64((1 << width) - 1)
            ones = np.bitwise_count(half).astype(np.int64)
            beyond = left >= ones
            left -= np.where(beyond, ones, 0)
            bit += np.where(beyond, width, 0)
        return ((((word << 6) + bit) - i) << self.bits) | self._low(i)

    def parts(self) -> list[bytes]:
        return [self.samples.astype("<u4").tobytes(), self.high.astype("<u8").tobytes(), self.low.tobytes()]


class Segment:
    """Concatenated ids with their documents' ends."""

    def __init__(self, ids: np.ndarray, ends: EliasFano):
        self.ids, self.ends = ids, ends

    def to_bytes(self) -> bytes:
        ends = self.ends
        header = _HEADER.pack(_MAGIC, self.ids.dtype.itemsize, ends.bits, ends.every, ends.n, len(self.ids))
        return b"".join([header, struct.pack("<Q", len(ends.high)), *ends.parts(), self.ids.astype(self.ids.dtype.newbyteorder("<")).tobytes()])

    @classmethod
    def from_bytes(cls, raw: bytes) -> Segment:
        magic, width, bits, every, n, total = _HEADER.unpack_from(raw)
        if magic != _MAGIC:
            raise ValueError("not a segment of token ids")
        (words,) = struct.unpack_from("<Q", raw, _HEADER.size)
        at = _HEADER.size + 8
        pieces = []
        for kind, count in (("<u4", -(-n // every)), ("<u8", words), ("u1", -(-n * bits // 8) + 8), (f"<u{width}", total)):
            pieces.append(np.frombuffer(raw, kind, count, at))
            at += pieces[-1].nbytes
        samples, high, low, ids = pieces
        return cls(ids, EliasFano(n, bits, low, high, samples, every))

    def bounds(self, first: int = 0, count: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of ``count`` documents from ``first`` on."""
        count = self.ends.n - first if count is None else count
        before = self.ends.select(np.arange(max(first - 1, 0), first + count))
        return (before[:-1], before[1:]) if first else (np.concatenate([[0], before[:-1]]).astype(np.int64), before)

    def document(self, i: int) -> np.ndarray:
        (start,), (end,) = self.bounds(i, 1)
        return self.ids[start:end]


class RoundEncoder:
    """Ids of many texts at once (see the module's text)."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.lowers, _ = check_tokenizer(self.tokenizer)
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.words = WordEncoder(self.tokenizer, self.lowers)

    def encode(self, data: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, an end id after each, and their numbers of ids."""
        raw = data.tobytes()
        if self.lowers and b"<|" not in raw:  # else a special token might appear by lowering
            data = np.frombuffer(raw.lower(), np.uint8)
        start, end = words_at(data, offsets)
        docs = len(offsets) - 1
        if not len(start):
            return np.full(docs, end_id, f"<u{self.width}"), np.ones(docs, np.int64)
        first, place = grouped(data, start, end)
        ids, counts = self.words.encode(data, start[first], (end - start)[first])
        at, size = (np.cumsum(counts) - counts)[place], counts[place]
        owner = np.searchsorted(offsets, start, "right") - 1
        per_doc = np.bincount(owner, size, docs).astype(np.int64) + 1
        out = np.full(int(per_doc.sum()), end_id, f"<u{self.width}")
        out[runs(np.cumsum(size) - size + owner, size)] = ids[runs(at, size)]  # an end id stands after each text before
        return out, per_doc


#: One encoder for a worker process.
_ENCODERS: dict[str, RoundEncoder] = {}


def _write_task(path: str, end_id: int, segment_ids: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _ENCODERS.get(path) or _ENCODERS.setdefault(path, RoundEncoder(path))
        part, segment = TaskContext.get().partitionId(), 0
        ids: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        names: list[pa.Array] = []
        held = 0

        def close() -> pa.RecordBatch:
            nonlocal segment, held
            every, per_doc = np.concatenate(ids), np.concatenate(counts)
            made = Segment(every, EliasFano.encode(np.cumsum(per_doc))).to_bytes()
            doc_ids = pa.ListArray.from_arrays(pa.array([0, len(per_doc)], pa.int32()), pa.concat_arrays(names))
            row = [pa.array([part], pa.int32()), pa.array([segment], pa.int32()), pa.array([len(per_doc)], pa.int64()), pa.array([len(every)], pa.int64()), doc_ids, pa.array([made], pa.binary())]
            segment, held = segment + 1, 0
            for kept in (ids, counts, names):
                kept.clear()
            return pa.RecordBatch.from_arrays(row, [x.split()[0] for x in _SEGMENTS.split(", ")])

        for batch in batches:
            for lo, hi, data, offsets in text_slices(batch.column(1), ROUND_BYTES):
                found, per_doc = encoder.encode(data, offsets, end_id)
                if held and held + len(found) > segment_ids:
                    yield close()
                ids.append(found)
                counts.append(per_doc)
                names.append(batch.column(0).slice(lo, hi - lo))
                held += len(found)
        if held:
            yield close()

    return run


def write_ids(docs: DataFrame, path: str, tokenizer_path: str | None = None, end_id: int = END_ID, segment_ids: int = SEGMENT_IDS, range_bytes: int = RANGE_BYTES) -> None:
    """Write the ids of every text of ``docs`` (doc_id, text) to the folder ``path``."""
    tokenizer_path = tokenizer_path or default_tokenizer_path()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("row"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(shuffle_partitions(docs.sparkSession), -(-size // range_bytes))
    order = ["doc_id", "hash", "row"]
    laid = texts.repartitionByRange(int(ranges), *order).sortWithinPartitions(*order)
    laid.select("doc_id", "text").mapInArrow(trimmed(_write_task(tokenizer_path, end_id, segment_ids)), _SEGMENTS).write.parquet(path)


def segments(spark: SparkSession, path: str) -> DataFrame:
    """The segments of a folder, with ``start``: the ids of all segments before."""
    found = spark.read.schema(_SEGMENTS).parquet(path)
    # Running sums without the payloads: over the segments of each range, and over the ranges.
    within = found.select("part", "segment", "n_ids").withColumn("before", F.sum("n_ids").over(Window.partitionBy("part").orderBy("segment")) - F.col("n_ids"))
    ranges = found.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    block = F.floor(F.col("part") / 1024)  # ranges in blocks, so that no task sums all of them one by one
    blocks = ranges.groupBy(block.alias("block")).agg(F.sum("ids").alias("ids"))
    blocks = blocks.select("block", (F.sum("ids").over(Window.orderBy("block")) - F.col("ids")).alias("at_block"))
    placed = ranges.withColumn("block", block).withColumn("at", F.sum("ids").over(Window.partitionBy("block").orderBy("part")) - F.col("ids")).join(blocks, "block")
    starts = within.join(placed.select("part", (F.col("at") + F.col("at_block")).alias("at_part")), "part").select("part", "segment", (F.col("at_part") + F.col("before")).alias("start"))
    small = found.select("part").count() * START_BYTES <= BROADCAST_BYTES  # then the payloads stay where they are
    return found.join(F.broadcast(starts) if small else starts.hint("merge"), ["part", "segment"])


def _read_task(schema: str, make: Callable) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, start in enumerate(batch.column(0).to_pylist()):
                segment = Segment.from_bytes(batch.column(2)[row].as_buffer())
                names = batch.column(1)[row].values
                for lo in range(0, segment.ends.n, 1 << 12):
                    count = min(1 << 12, segment.ends.n - lo)
                    first, last = segment.bounds(lo, count)
                    columns = [names.slice(lo, count), pa.array(start + first, pa.int64()), make(segment.ids, first, last)]
                    yield pa.RecordBatch.from_arrays([*columns[:2], *columns[2]], [x.split()[0] for x in schema.split(", ")])

    return run


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start and ids (with the end id) of every document of a folder."""
    schema = "doc_id bigint, start bigint, ids array<int>"

    def make(ids: np.ndarray, first: np.ndarray, last: np.ndarray) -> list[pa.Array]:
        flat = pa.array(ids[first[0] : last[-1]].astype(np.int32))
        return [pa.ListArray.from_arrays(pa.array(np.concatenate([first[:1], last]) - first[0], pa.int32()), flat)]

    return segments(spark, path).select("start", "doc_ids", "payload").mapInArrow(_read_task(schema, make), schema)


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and the CRC-32 of the ids of every document."""
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"

    def make(ids: np.ndarray, first: np.ndarray, last: np.ndarray) -> list[pa.Array]:
        raw = memoryview(ids[first[0] : last[-1]].astype("<u4").tobytes())
        base = int(first[0])
        crc = [zlib.crc32(raw[4 * (a - base) : 4 * (b - base)]) for a, b in zip(first.tolist(), last.tolist())]
        return [pa.array(last - first, pa.int64()), pa.array(crc, pa.int64())]

    return segments(spark, path).select("start", "doc_ids", "payload").mapInArrow(_read_task(schema, make), schema)


def op13_tokenbin(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-ids")
    write_ids(table(spark, sf_dir, "documents"), path)
    return checksums(spark, path)
