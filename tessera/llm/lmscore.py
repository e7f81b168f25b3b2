"""Operator 4: language-model scoring by cross-entropy difference.

Two bigram models share one vocabulary: words and word pairs, each known by its
full 64-bit hash. The target model counts the texts with the target label, the
background model all texts; every word and pair of every whole text is counted.
The two are matched: background counts are scaled to the target's number of
words, and both use the same smoothing, so a difference in loss tells about the
texts and not about the amount of data. A text's score is the mean over its
words of the target's loss less the background's loss (in nats): low scores
resemble the target.

The counts are a table in the shared folder and grow with the corpus. Its rows
are *parts*: ranges of hashes with their counts, more of them for more text, so
a part stays about as large as ``PART_BYTES`` of text makes it. Counting tasks
send, for every run of ``RUN_BYTES`` of text, each distinct word and pair once;
scoring tasks ask the parts for the counts of a run's distinct words and pairs
and take the answers back to the run. A frequent word or pair is therefore one
entry a run wherever it goes, and no table is collected or broadcast.
``score_corpus`` scores the texts that are counted: there the parts answer the
counting tasks at once, so the words and pairs travel once instead of twice.

Defined results: a null or empty text has no words: n_tokens 0 and null
figures; without target texts both models are alike and scores are 0; repeated
rows count as often as they occur and score alike; a repeated label counts
once; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import Words, mix, shuffle_partitions, stored, table, text_slices

RUN_BYTES = 8 << 20
PART_BYTES = 32 << 20
#: Weight of the word model in the pair model, and of the uniform model in the word model.
BACKOFF = 20.0
UNIFORM = 0.1

#: Kinds of key, and the number of counts of each: as a word and as the word before, or as a pair; by target and background.
WORD, PAIR = 0, 1
WIDTH = (4, 2)

_COUNTS = "kind int, part int, keys binary, counts binary"
_RUNS = "run bigint, docs array<bigint>, texts array<string>, targets array<boolean>"
_ENTRIES = "kind int, part int, run bigint, keys binary, counts binary"
_WANTED = "kind int, part int, run bigint, keys binary"
_ANSWERS = "run bigint, kind int, part int, counts binary"
_SCORES = "doc_id bigint, n_tokens bigint, ce_target double, ce_background double, score double"
_START = np.uint64(0x9E3779B97F4A7C15)


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def keys(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per word: its key, the key of the word before, and the pair's key."""
    before = np.empty_like(words.hash)
    before[1:] = words.hash[:-1]
    first = np.flatnonzero(words.per_doc)
    before[(np.cumsum(words.per_doc) - words.per_doc)[first]] = _START
    return words.hash, before, mix(before * np.uint64(3) + words.hash)


def _distinct(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per kind: the distinct keys, ascending, and the place of each occurrence
    among them (words: first those of the words, then of the words before)."""
    now, before, pair = keys(words)
    for x in (np.concatenate([now, before]), pair):
        found, place = np.unique(x, return_inverse=True)
        yield found, place.astype(np.int32)


def _narrow(counts: np.ndarray) -> bytes:
    """Counts in the smallest unsigned type that holds them, after its size."""
    kind = np.min_scalar_type(int(counts.max(initial=0)))
    return bytes([kind.itemsize]) + counts.astype(f"<u{kind.itemsize}").tobytes()


def _wide(raw: bytes, width: int) -> np.ndarray:
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype(np.int64).reshape(-1, width)


def _parts(found: np.ndarray, kind: int, bits: int) -> Iterator[tuple[int, int, int]]:
    """Number, first and end of the parts that ascending keys fall in."""
    bits = _bits(kind, bits)
    part = (found >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(found), np.int64)
    cut = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(found)]
    for lo, hi in zip(cut[:-1], cut[1:]):
        if hi > lo:
            yield int(part[lo]), lo, hi


def _bits(kind: int, bits: int) -> int:
    return max(0, bits - 3) if kind == WORD else bits  # far fewer words than pairs


def _rows(schema: str, rows: list[tuple], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], _names(schema))


def _counted(words: Words, target: np.ndarray, bits: int) -> Iterator[tuple[int, int, bytes, bytes]]:
    """Kind, part, keys and counts of a run's distinct words and pairs; ``target`` says which texts are."""
    wanted, n = target[words.doc], len(words.doc)
    for kind, (found, place) in enumerate(_distinct(words)):
        counts = np.column_stack([np.bincount(x, minlength=len(found)) for at in ((place[:n], place[n:]) if kind == WORD else (place,)) for x in (at[wanted], at)])
        for part, a, b in _parts(found, kind, bits):
            yield kind, part, found[a:b].astype("<u8").tobytes(), _narrow(counts[a:b])


def _count_task(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            target = np.asarray(batch.column(1).to_numpy(zero_copy_only=False), bool)
            for lo, hi, data, offsets in text_slices(batch.column(0), RUN_BYTES):
                yield _rows(_COUNTS, list(_counted(Words(data, offsets), target[lo:hi], bits)), [pa.int32(), pa.int32(), pa.binary(), pa.binary()])

    return run


def _summed(kind: int, rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, tuple[int, int, int]]:
    """Of one part: its distinct keys, ascending; the place of each entry among
    them; their summed counts; words in the target and background, and distinct words."""
    found, place = np.unique(np.concatenate([np.frombuffer(x.as_buffer(), "<u8") for x in rows["keys"]]), return_inverse=True)
    total = np.zeros((len(found), WIDTH[kind]), np.int64)
    at = 0
    for x in rows["counts"]:
        counts = _wide(x.as_py(), WIDTH[kind])
        total[place[at : at + len(counts)]] += counts  # a run has a key once
        at += len(counts)
    shared = (*total[:, :2].sum(axis=0).tolist(), int((total[:, 1] > 0).sum())) if kind == WORD else (0, 0, 0)
    return found, place, total, shared


def _sum_part(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    kind, part = (k.as_py() for k in key)
    found, _, total, shared = _summed(kind, rows)
    return pa.Table.from_batches([_rows(_MODEL, [(kind, part, found.tobytes(), _narrow(total), *shared)], [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()])])


def _sum_runs(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """One part's summed counts, given back to the runs that it came from."""
    kind, part = (k.as_py() for k in key)
    _, place, total, shared = _summed(kind, rows)
    out, at = [], 0
    for number, raw in zip(rows["run"].to_pylist(), rows["keys"]):
        n = len(raw.as_buffer()) // 8
        out.append((number, kind, part, _narrow(total[place[at : at + n]]), *(shared if not at else (0, 0, 0))))
        at += n
    return pa.Table.from_batches([_rows(_SUMS, out, [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64()])])


_SHARED = "n_target bigint, n_background bigint, n_words bigint"
_MODEL = f"{_COUNTS}, {_SHARED}"
_SUMS = f"{_ANSWERS}, {_SHARED}"


class Model(NamedTuple):
    """The table of counts by part, and what all parts share."""

    counts: DataFrame
    bits: int
    n_target: int
    n_background: int
    n_words: int

    def losses(self, words: np.ndarray, pairs: np.ndarray, now: np.ndarray, before: np.ndarray, pair: np.ndarray) -> Iterator[np.ndarray]:
        """Loss of every word under the target and the background model, given
        the counts of the distinct words and pairs, and their places."""
        scale = (1.0, self.n_target / self.n_background if self.n_background else 0.0)
        spread = float(self.n_target) + UNIFORM * max(1, self.n_words)  # all distinct words of the corpus
        for k in (0, 1):
            word = BACKOFF * (words[:, k] * scale[k] + UNIFORM) / spread
            yield np.log(words[:, 2 + k] * scale[k] + BACKOFF)[before] - np.log((pairs[:, k] * scale[k])[pair] + word[now])


@contextmanager
def _shuffles_dropped(spark: SparkSession):
    """The shuffle files of the tables written inside go when the tables are there."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _part_bits(docs: DataFrame, part_bytes: int) -> int:
    """Parts of about ``part_bytes`` of text, and one for each task at least (as a power of 2)."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return (max(-(-size // part_bytes), min(shuffle_partitions(docs.sparkSession), size >> 16), 1) - 1).bit_length()


def _marked(docs: DataFrame, target_ids: DataFrame) -> DataFrame:
    wanted = target_ids.select(F.col("doc_id").cast("long").alias("__target")).where(F.col("__target").isNotNull()).distinct()
    # Labels grow with the texts, so they are never broadcast: one plan at every size.
    marked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted.hint("merge"), F.col("doc_id") == F.col("__target"), "left")
    return marked.select("doc_id", "text", F.col("__target").isNotNull().alias("target"))


def _totals(rows: DataFrame):
    return rows.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in _names(_SHARED)]).first()


def fit(docs: DataFrame, target_ids: DataFrame, part_bytes: int = PART_BYTES) -> Model:
    """Count all of ``docs``; those whose doc_id is in ``target_ids`` (doc_id) are the target."""
    bits = _part_bits(docs, part_bytes)
    counted = _marked(docs, target_ids).select("text", "target").mapInArrow(_count_task(bits), _COUNTS)
    with _shuffles_dropped(docs.sparkSession):
        model = stored(counted.groupBy("kind", "part").applyInArrow(_sum_part, _MODEL), "lm-counts")
    return Model(model.select("kind", "part", "keys", "counts"), bits, *_totals(model))


def _run_task(run_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for lo, hi, _, _ in text_slices(batch.column(1), run_bytes):
                own = [pa.ListArray.from_arrays(pa.array([0, hi - lo], pa.int32()), batch.column(i).slice(lo, hi - lo)) for i in range(3)]
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *own], _names(_RUNS))
                number += 1

    return run


def _runs(marked: DataFrame, run_bytes: int) -> DataFrame:
    # Written once, so that what is asked for a run and what is scored are the same texts.
    with _shuffles_dropped(marked.sparkSession):
        return stored(marked.mapInArrow(_run_task(run_bytes), _RUNS), "lm-runs")


def _words(texts: pa.Array) -> Words:
    """The words of a whole run."""
    _, _, data, offsets = next(text_slices(texts, 1 << 62))
    return Words(data, offsets)


def _ask_task(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, texts in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = [(kind, part, number, found[a:b].astype("<u8").tobytes()) for kind, (found, _) in enumerate(_distinct(_words(texts.values))) for part, a, b in _parts(found, kind, bits)]
                yield _rows(_WANTED, rows, [pa.int32(), pa.int32(), pa.int64(), pa.binary()])

    return run


def _entry_task(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, texts, targets in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                rows = [(kind, part, number, *blobs) for kind, part, *blobs in _counted(_words(texts.values), np.array(targets, bool), bits)]
                yield _rows(_ENTRIES, rows, [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()])

    return run


def _answer_part(key: tuple[pa.Scalar, ...], asked: pa.Table, model: pa.Table) -> pa.Table:
    """The counts of each run's keys; 0 for those that the model doesn't know."""
    kind, part = (k.as_py() for k in key)
    known, counts = np.zeros(0, np.uint64), np.zeros((0, WIDTH[kind]), np.int64)
    if model.num_rows:
        known, counts = np.frombuffer(model["keys"][0].as_buffer(), "<u8"), _wide(model["counts"][0].as_py(), WIDTH[kind])
    counts = np.concatenate([counts, np.zeros((1, WIDTH[kind]), np.int64)])
    rows = []
    for number, raw in zip(asked["run"].to_pylist(), asked["keys"]):
        wanted = np.frombuffer(raw.as_buffer(), "<u8")
        at = np.searchsorted(known, wanted)
        if len(known):
            at[known[np.minimum(at, len(known) - 1)] != wanted] = len(known)
        rows.append((number, kind, part, _narrow(counts[at])))
    return pa.Table.from_batches([_rows(_ANSWERS, rows, [pa.int64(), pa.int32(), pa.int32(), pa.binary()])])


def _score_run(model: Model):
    shared = model._replace(counts=None)

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        docs, words = texts["docs"][0].values, _words(texts["texts"][0].values)
        n = words.per_doc
        some = np.flatnonzero(n)
        mean = np.full((2, len(n)), np.nan)
        if len(some):
            (_, place), (_, pair) = _distinct(words)
            ordered = answers.sort_by([("kind", "ascending"), ("part", "ascending")])
            kinds = ordered["kind"].to_pylist()
            counts = [np.concatenate([_wide(raw.as_py(), WIDTH[kind]) for k, raw in zip(kinds, ordered["counts"]) if k == kind]) for kind in (WORD, PAIR)]
            at = (np.cumsum(n) - n)[some]
            for k, loss in enumerate(shared.losses(*counts, place[: len(pair)], place[len(pair) :], pair)):
                mean[k, some] = np.add.reduceat(loss, at) / n[some]
        figures = [pa.array(x.round(6), pa.float64(), from_pandas=True) for x in (mean[0], mean[1], mean[0] - mean[1])]
        return pa.table([docs, pa.array(n, pa.int64()), *figures], _names(_SCORES))

    return run


def _scored(runs: DataFrame, answers: DataFrame, model: Model) -> DataFrame:
    return runs.select("run", "docs", "texts").groupBy("run").cogroup(answers.groupBy("run")).applyInArrow(_score_run(model), _SCORES)


def score(docs: DataFrame, model: Model, run_bytes: int = RUN_BYTES) -> DataFrame:
    """Scores of any texts under a fitted model."""
    runs = _runs(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.lit(False).alias("target")), run_bytes)
    asked = runs.select("run", "texts").mapInArrow(_ask_task(model.bits), _WANTED)
    answers = asked.groupBy("kind", "part").cogroup(model.counts.groupBy("kind", "part")).applyInArrow(_answer_part, _ANSWERS)
    return _scored(runs, answers, model)


def score_corpus(docs: DataFrame, target_ids: DataFrame, part_bytes: int = PART_BYTES, run_bytes: int = RUN_BYTES) -> DataFrame:
    """What ``score(docs, fit(docs, target_ids))`` gives, with one shuffle of words and pairs."""
    bits = _part_bits(docs, part_bytes)
    runs = _runs(_marked(docs, target_ids), run_bytes)
    entries = runs.select("run", "texts", "targets").mapInArrow(_entry_task(bits), _ENTRIES)
    with _shuffles_dropped(docs.sparkSession):
        sums = stored(entries.groupBy("kind", "part").applyInArrow(_sum_runs, _SUMS), "lm-sums")
    return _scored(runs, sums.select(*_names(_ANSWERS)), Model(sums, bits, *_totals(sums)))


def op4_lmscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: texts labelled of good quality and not toxic."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return score_corpus(docs, labels.where("quality = 1 AND toxic = 0"))
