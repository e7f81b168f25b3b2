"""Operator 8: language identification with string kernels.

Texts are compared by the blended-spectrum presence kernel: the number of
distinct character n-grams (n = 1 to 3, letters lower-cased, every run of
other characters one space) that two whole texts share, divided by the root of
the product of their numbers of distinct n-grams. Kernel ridge regression, one
classifier for each language against the rest, is fitted in the Nystroem space
of ``LANDMARKS`` landmark texts. Scoring needs only the landmarks' n-grams:
per batch of texts a presence matrix times the landmark matrix gives the
kernel rows, and these times the coefficients give the margins.

The classifier is fitted on a bounded sample of labelled rows: at most
``TRAIN_ROWS`` in all, the same number for each language, taken by the hash of
doc_id among rows with a language whose ``crc32(doc_id) mod 3`` is not 1. The
n-grams of the sample's whole texts are found on the executors.

Defined results: a null text, or one without a letter, is ``und`` with score 0;
so is every text where there is no labelled row; a null doc_id is neither held
out nor learnt from; ties go to the language first in order; repeated rows are
judged alike; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import sys
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import table, text_slices, trimmed

TRAIN_ROWS = 1200
LANDMARKS = 128
RIDGE = 0.02
UNKNOWN = "und"

_OUT = "doc_id bigint, held_out boolean, lang_pred string, score double"


@functools.cache
def _letters() -> np.ndarray:
    """Code point -> its lower-case letter within 16 bits (rarer planes are
    folded), or a space for what is no letter."""
    out = np.full(sys.maxunicode + 1, 32, np.uint16)
    for i in range(sys.maxunicode + 1):
        c = chr(i)
        if c.isalpha():
            low = ord(c.lower()[0])
            out[i] = (low ^ (low >> 16) * 40503) & 0xFFFF
    return out


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, n-gram) pairs as ``text << 48 | n-gram``, ascending;
    distinct n-grams per text; and whether each text has a letter."""
    n_docs = len(offsets) - 1
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), "<u4")
    first = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    letter = _letters()[points]
    doc = np.repeat(np.arange(n_docs, dtype=np.uint64), np.diff(first))
    gap = letter == 32
    keep = np.ones(len(letter), bool)
    keep[1:] = ~(gap[1:] & gap[:-1] & (doc[1:] == doc[:-1]))
    has = np.bincount(doc[~gap].astype(np.int64), minlength=n_docs) > 0
    letter, doc = letter[keep].astype(np.uint64), doc[keep]
    top = doc << np.uint64(48)
    found = [top | letter]
    for n in (2, 3):
        if len(letter) >= n:
            code = letter[: len(letter) - n + 1].copy()
            for j in range(1, n):
                code |= letter[j : len(letter) - n + 1 + j] << np.uint64(16 * j)
            same = doc[n - 1 :] == doc[: len(doc) - n + 1]
            found.append((top[: len(code)] | code)[same])
    pairs = np.concatenate(found)
    pairs.sort()
    if len(pairs):
        pairs = pairs[np.concatenate([[True], pairs[1:] != pairs[:-1]])]
    count = np.bincount((pairs >> np.uint64(48)).astype(np.int64), minlength=n_docs)
    return pairs, count, has


_LOW = np.uint64((1 << 48) - 1)


class Model:
    """Landmark n-grams, landmark matrix and ridge coefficients."""

    def __init__(self, sample: list[tuple[str, np.ndarray]], landmarks: int, ridge: float):
        self.langs = sorted({lang for lang, _ in sample})
        if not self.langs:
            return
        by_lang = {lang: [g for x, g in sample if x == lang] for lang in self.langs}
        turn = [by_lang[lang][i] for i in range(max(map(len, by_lang.values()))) for lang in self.langs if i < len(by_lang[lang])]
        marks = turn[:landmarks]
        self.grams = np.unique(np.concatenate(marks))
        self.marks = np.zeros((len(self.grams), len(marks)), np.float32)
        for j, g in enumerate(marks):
            self.marks[np.searchsorted(self.grams, g), j] = 1 / np.sqrt(len(g))
        rows = [self._presence([g]) for _, g in sample]
        k_nm = np.concatenate([r @ self.marks for r in rows]).astype(np.float64)
        k_mm = np.concatenate([self._presence([g]) @ self.marks for g in marks]).astype(np.float64)
        y = np.array([[1.0 if x == lang else -1.0 for lang in self.langs] for x, _ in sample])
        weight = np.array([len(sample) / len(self.langs) / len(by_lang[x]) for x, _ in sample])[:, None]
        left = k_nm.T @ (weight * k_nm) + ridge * len(sample) / len(marks) * k_mm + 1e-6 * np.eye(len(marks))
        self.alpha = np.linalg.solve(left, k_nm.T @ (weight * y)).astype(np.float32)

    def _presence(self, sets: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(sets), len(self.grams)), np.float32)
        for i, g in enumerate(sets):
            at = np.searchsorted(self.grams, g)
            at = at[self.grams[np.minimum(at, len(self.grams) - 1)] == g]
            out[i, at] = 1 / np.sqrt(max(1, len(g)))
        return out

    def margins(self, pairs: np.ndarray, count: np.ndarray, rows: int = 256) -> np.ndarray:
        """One margin per text and language."""
        doc, gram = (pairs >> np.uint64(48)).astype(np.int64), pairs & _LOW
        at = np.searchsorted(self.grams, gram)
        known = self.grams[np.minimum(at, len(self.grams) - 1)] == gram
        doc, at = doc[known], at[known]
        out = np.zeros((len(count), len(self.langs)), np.float32)
        for lo in range(0, len(count), rows):
            hi = min(lo + rows, len(count))
            a, b = np.searchsorted(doc, [lo, hi])
            presence = np.zeros((hi - lo, len(self.grams)), np.float32)
            presence[doc[a:b] - lo, at[a:b]] = 1
            kernel = (presence @ self.marks) / np.sqrt(np.maximum(count[lo:hi], 1))[:, None].astype(np.float32)
            out[lo:hi] = kernel @ self.alpha
        return out


#: Bytes of text whose n-grams are held at once (a longer text goes alone).
ROUND_BYTES = 1 << 19


def _held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1


def _sample_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, offsets in text_slices(batch.column(2), ROUND_BYTES):
            pairs, count, has = grams(data, offsets)
            ends = np.cumsum(count)
            sets = [(pairs[e - n : e] & _LOW).astype("<u8").tobytes() if h else b"" for e, n, h in zip(ends, count, has)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(sets, pa.binary())], ["doc_id", "lang", "grams"])


def _low_ranks(rows: DataFrame, counts: dict[str, int], expected: int) -> DataFrame:
    """The rows of each language with the lowest ranks, about ``expected`` of
    them: what comes first in rank order lies in it, and no language's rows
    meet in one task, however many there are."""
    least, every = -(1 << 63), (1 << 64) - 1
    bounds = [F.lit(x) for lang, n in counts.items() for x in (lang, least + min(every, every * expected // n))]
    return rows.where(F.col("rank") <= F.element_at(F.create_map(*bounds), F.col("lang"))) if bounds else rows


def fit(docs: DataFrame, train_rows: int = TRAIN_ROWS, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Fit on a bounded sample of the labelled rows that are not held out."""
    labelled = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~_held_out())
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row per language
    each = max(4, train_rows // max(1, len(counts)))
    rows = labelled.select("doc_id", "lang", F.xxhash64("doc_id").alias("rank"))
    first = F.row_number().over(Window.partitionBy("lang").orderBy("rank", "doc_id")) <= each
    chosen = _low_ranks(rows, counts, 4 * each).withColumn("first", first).where("first").select("doc_id", "lang").distinct()
    found = chosen.collect()  # at most train_rows (or 4 for each language)
    taken = Counter(r["lang"] for r in found)
    if any(taken[lang] < min(n, each) for lang, n in counts.items()):  # repeated rows, or a thin slice of the hashes
        found = rows.withColumn("first", first).where("first").select("doc_id", "lang").distinct().collect()
    ids = sorted({r["doc_id"] for r in found})
    texts = labelled.where(F.col("doc_id").isin(ids)).groupBy("doc_id", "lang").agg(F.max("text").alias("text"))  # one of repeated rows
    sample = texts.mapInArrow(_sample_task, "doc_id long, lang string, grams binary").collect() if ids else []
    rank = lambda r: (zlib.crc32(b"%d" % r["doc_id"]), r["doc_id"], r["lang"], r["grams"])
    return Model([(r["lang"], np.frombuffer(r["grams"], "<u8")) for r in sorted(sample, key=rank) if r["grams"]], landmarks, ridge)


def _score_task(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        names = np.array([*m.langs, UNKNOWN], object)
        for batch in batches:
            for lo, hi, data, offsets in text_slices(batch.column(2), ROUND_BYTES):
                pairs, count, has = grams(data, offsets)
                best, score = np.full(hi - lo, len(m.langs)), np.zeros(hi - lo)
                if m.langs:
                    margin = m.margins(pairs, count)
                    best = np.where(has, margin.argmax(axis=1), len(m.langs))
                    score = np.where(has, np.clip((margin.max(axis=1) + 1) / 2, 0, 1), 0).round(4)
                columns = [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(names[best], pa.string()), pa.array(score, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang_pred", "score"])

    return run


def identify(docs: DataFrame, model: Model | None = None, **options) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""
    model = model or fit(docs, **options)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(_held_out(), F.lit(False)).alias("held_out"), "text")
    return rows.mapInArrow(trimmed(_score_task(docs.sparkSession.sparkContext.broadcast(model))), _OUT)


def accepted(docs: DataFrame, model: Model | None = None, **options) -> DataFrame:
    """The rows of ``docs`` that can be given a language, all columns kept; null
    texts and texts without a letter go. (Where no row has a language to learn
    from, only these go as well.) Rows are judged where they are read."""
    shared = docs.sparkSession.sparkContext.broadcast(model or fit(docs, **options))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for lo, hi, data, offsets in text_slices(batch.column(batch.schema.get_field_index("text")), ROUND_BYTES):
                pairs, count, has = grams(data, offsets)
                keep[lo:hi] = has & np.isfinite(m.margins(pairs, count).max(axis=1)) if m.langs else has
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(trimmed(run), docs.schema)


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
