"""Operator 7: benchmark decontamination over a distributed positional inverted index.

The index is partitioned by document, as search engines do it: a task takes a
run of documents (a *segment*, about 2 MB of text), numbers their words, and
stores one row with the positions of every benchmark term in it. No posting is
ever shuffled, so a term that stands in every document is no hot key.

A search takes the benchmark's windows (10 consecutive words; a shorter item
is one window). Within a segment each window starts from the postings of its
globally rarest term, shifted back by the term's offset, and is intersected
with the shifted postings of its other terms, rarest first, until nothing is
left. All windows of a segment go through one array search per step. With a
``slop`` a term may stand that many words from its place (proximity match); a
match without any shift is an exact phrase.

The benchmark is the query set. It is read in blocks of at most
``BLOCK_BYTES`` of text, each block's windows are sent to all tasks, and the
hits of several blocks are merged by document. (A single item above the bound
is a block of its own.)

Defined results: null or empty text has no words and no hits; an empty
benchmark or null item text gives no windows; equal item ids count as one;
a null item_id reads as an empty string; repeated documents are searched row
by row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import WORDS_SQL, Words, stored, table, text_slices, trimmed, word_hashes

WINDOW_WORDS = 10
#: Words a term may be off its place in a proximity match.
SLOP = 2
BLOCK_BYTES = 16 << 20

_INDEX = (
    "segment bigint, doc_ids array<bigint>, rows array<bigint>, hashes array<bigint>, bases array<bigint>, n_words array<bigint>, "
    "terms array<int>, counts array<int>, positions binary"
)
_HITS = "doc_id bigint, row bigint, text_hash bigint, n_words bigint, hits array<int>, items array<string>, near_items array<string>"


class Windows:
    """The windows of one block of benchmark items, over its own vocabulary."""

    def __init__(self, items: list[tuple[str, str]], width: int, slop: int):
        self.slop = slop
        self.gap = width + 2 * slop + 2  # empty positions between the documents of a segment
        hashes = [word_hashes(text) for _, text in items]
        self.vocabulary = np.unique(np.concatenate([np.zeros(0, np.uint64), *hashes]))
        self.names = sorted({name for name, _ in items})
        place = {name: i for i, name in enumerate(self.names)}
        terms, lengths, owners = [], [], []
        for (name, _), h in zip(items, hashes):
            ids = np.searchsorted(self.vocabulary, h).astype(np.int32)
            if not len(ids):
                continue
            if len(ids) < width:
                ids = np.pad(ids, (0, width - len(ids)), constant_values=-1)
            rows = np.lib.stride_tricks.sliding_window_view(ids, width)
            terms.append(rows)
            lengths.append(np.full(len(rows), min(len(h), width), np.int32))
            owners.append(np.full(len(rows), place[name], np.int32))
        self.terms = np.concatenate(terms) if terms else np.zeros((0, width), np.int32)
        self.length = np.concatenate(lengths) if terms else np.zeros(0, np.int32)
        self.item = np.concatenate(owners) if terms else np.zeros(0, np.int32)
        self.order = np.zeros(self.terms.shape, np.int8)

    def rarest_first(self, counts: dict[int, int]) -> None:
        """Order each window's places by the total count of their terms."""
        total = np.zeros(len(self.vocabulary) + 1, np.int64)
        for term, n in counts.items():
            total[term] = n
        weight = np.where(self.terms >= 0, total[self.terms], np.iinfo(np.int64).max)
        self.order = np.argsort(weight, axis=1, kind="stable").astype(np.int8)

    def search(self, terms: np.ndarray, counts: np.ndarray, positions: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matches in one segment: window, start position, whether exact."""
        present = np.zeros(len(self.vocabulary) + 1, bool)
        present[terms] = True
        present[-1] = True  # where a short window has no term
        alive = np.flatnonzero(present[self.terms].all(axis=1))
        bound = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        keys = (np.repeat(terms.astype(np.int64), counts) << 32) + positions
        # start from the rarest term of each window
        first = self.order[alive, 0].astype(np.int64)
        slot = np.searchsorted(terms, self.terms[alive, first])
        n = counts[slot].astype(np.int64)
        window = np.repeat(alive, n)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(bound[slot], n)
        start = positions[at].astype(np.int64) - np.repeat(first, n)
        exact = np.ones(len(start), bool)
        for step in range(1, self.terms.shape[1]):
            if not len(start):
                break
            place = self.order[window, step].astype(np.int64)
            term = self.terms[window, place].astype(np.int64)
            key = (term << 32) + start + place
            near = np.searchsorted(keys, key - self.slop)
            found = keys[np.minimum(near, len(keys) - 1)]
            ok = (near < len(keys)) & (found <= key + self.slop)
            same = np.searchsorted(keys, key)
            here = (same < len(keys)) & (keys[np.minimum(same, len(keys) - 1)] == key)
            short = term < 0
            ok, here = ok | short, here | short
            exact = (exact & here)[ok]
            window, start = window[ok], start[ok]
        return window, start, exact


def _index_task(windows):
    """Postings of the benchmark's terms, one row per segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, gap = windows.value.vocabulary, windows.value.gap
        segment = TaskContext.get().partitionId() << 32
        for batch in batches:
            for lo, hi, data, offsets in text_slices(batch.column(3)):
                words = Words(data, offsets)
                n = words.per_doc
                bases = gap + np.cumsum(n + gap) - (n + gap)
                position = np.arange(len(words.hash)) + (bases - (np.cumsum(n) - n))[words.doc]
                term = np.searchsorted(known, words.hash)
                hit = np.flatnonzero(known[np.minimum(term, len(known) - 1)] == words.hash) if len(known) else np.zeros(0, np.int64)
                term, position = term[hit], position[hit]
                order = np.argsort(term, kind="stable")
                terms, counts = np.unique(term, return_counts=True)
                row = [
                    [segment], *([batch.column(i).slice(lo, hi - lo).to_pylist()] for i in range(3)),
                    [bases], [n], [terms.astype(np.int32)], [counts.astype(np.int32)], [position[order].astype("<u4").tobytes()],
                ]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, _INDEX_TYPES)], _INDEX_NAMES)
                segment += 1

    return run


_LONGS, _INTS = pa.list_(pa.int64()), pa.list_(pa.int32())
_INDEX_TYPES = [pa.int64(), _LONGS, _LONGS, _LONGS, _LONGS, _LONGS, _INTS, _INTS, pa.binary()]
_INDEX_NAMES = [x.split()[0] for x in _INDEX.split(", ")]


def _search_task(windows):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w: Windows = windows.value
        for batch in batches:
            for i in range(batch.num_rows):
                get = lambda k: batch.column(k)[i].values.to_numpy(zero_copy_only=False)  # noqa: B023, E731
                doc_ids, rows, hashes = (batch.column(k)[i].as_py() for k in (1, 2, 3))
                bases, n_words, terms, counts = get(4), get(5), get(6), get(7)
                positions = np.frombuffer(batch.column(8)[i].as_buffer(), "<u4")
                window, start, exact = w.search(terms, counts, positions)
                doc = np.searchsorted(bases, start, "right") - 1
                hits, items, near = ([[] for _ in doc_ids] for _ in range(3))
                names = w.names
                for found, into in ((exact, items), (~exact, near)):
                    for pair in np.unique(doc[found].astype(np.int64) << 32 | w.item[window[found]]).tolist():
                        into[pair >> 32].append(names[pair & 0xFFFFFFFF])
                length = w.length[window[exact]].astype(np.int64)
                every = np.repeat(start[exact], length) + np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
                every = np.unique(every)
                of = np.searchsorted(bases, every, "right") - 1
                for d in np.unique(of).tolist():
                    hits[d] = (every[of == d] - bases[d]).astype(np.int32)
                out = [doc_ids, rows, hashes, n_words, hits, items, near]
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), _INTS, pa.list_(pa.string()), pa.list_(pa.string())]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds)], [x.split()[0] for x in _HITS.split(", ")])

    return run


def _text_hash():
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def build_index(docs: DataFrame, windows) -> DataFrame:
    """The stored index of ``docs`` for the terms of a broadcast ``Windows``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), _text_hash().alias("text_hash"), "text")
    return stored(rows.mapInArrow(trimmed(_index_task(windows)), _INDEX), "positional-index")


def search_benchmark(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW_WORDS, slop: int = SLOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document row: doc_id, row, text_hash, n_words, the word positions hit by exact
    matches, the items matched exactly, and those matched in proximity only
    at some place (as sorted strings)."""
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text")).where(F.col("text").isNotNull())
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-int(total) // block_bytes))
    found = None
    for k in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k)
        windows = Windows([tuple(r) for r in part.collect()], width, slop)
        index = build_index(docs, spark.sparkContext.broadcast(windows))
        pairs = index.select(F.explode(F.arrays_zip("terms", "counts")).alias("x"))
        counts = pairs.groupBy(F.col("x.terms").alias("term")).agg(F.sum("x.counts").alias("n")).collect()
        windows.rarest_first({r["term"]: r["n"] for r in counts})
        hits = index.mapInArrow(trimmed(_search_task(spark.sparkContext.broadcast(windows))), _HITS)
        found = hits if found is None else found.unionByName(hits)
    if blocks == 1:
        return found
    joined = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
    return found.groupBy("row", "doc_id", "text_hash").agg(F.max("n_words").alias("n_words"), joined("hits"), joined("items"), joined("near_items")).select("doc_id", "row", "text_hash", "n_words", "hits", "items", "near_items")


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The contract's digest of ``search_benchmark``, and the proximity items."""
    found = search_benchmark(docs, benchmark, **options)
    return found.select(
        "doc_id",
        "n_words",
        F.size("hits").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
        F.size(F.array_except("near_items", "items")).cast("long").alias("n_near_items"),
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without an exact benchmark window, all columns kept."""
    hit = search_benchmark(docs, benchmark, **options).where(F.size("hits") > 0)
    dirty = hit.select(F.col("doc_id").alias("__dirty_id"), F.col("text_hash").alias("__dirty_hash")).distinct()
    return docs.join(dirty, F.col("doc_id").eqNullSafe(F.col("__dirty_id")) & (_text_hash() == F.col("__dirty_hash")), "left_anti")


def op7_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns (proximity matches are in ``contamination``)."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("n_near_items")


#: The query's contract in DuckDB SQL.
OP7_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS_SQL} AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {WORDS_SQL} AS w FROM benchmark),
bn AS (SELECT item, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0),
bw AS (
  SELECT DISTINCT item, n, unnest(list_transform(generate_series(1, len(w) - n + 1), lambda i: array_to_string(w[i : i + n - 1], ' '))) AS win
  FROM bn
), lengths AS (SELECT DISTINCT n FROM bw),
di AS (SELECT r, n, w, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, lengths),
hits AS (SELECT DISTINCT r, i, di.n, item FROM di JOIN bw ON di.n = bw.n AND array_to_string(w[i : i + di.n - 1], ' ') = win),
pos AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY r),
found AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (r) LEFT JOIN found USING (r)
"""
