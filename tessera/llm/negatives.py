"""Operator 11: hard negatives from shared lists of anchor clusters (MAXIMUS).

Anchors near each other share one list: the rows, sorted once by an upper bound
on their inner product with any anchor of the cluster. With c the cluster's
unit centre, t the largest angle between c and a member, and a row x at the
angle s from c, ``|x| cos(max(0, s - t))`` bounds ``<u, x>`` of every member's
unit vector u (angles obey the triangle inequality). Each member walks the list
downwards, scores the rows it meets and ends, with a certificate, where the
bound falls below what it still needs: the score of its k-th best row so far,
or the lowest score that it may return. A row that is not walked can't enter
the result, so results are exact.

On Spark the rows lie packed in blocks in a table. Anchors go through in rounds
of ``ROUND_BYTES``: a round's anchors are clustered and sent with the tasks, a
task walks its blocks' lists for every cluster and sends what its anchors keep,
and a window over each anchor's candidates makes the result. One block in
``FIRST`` is walked before the others: the k-th best score it gives an anchor is
a floor for its walks through all blocks, so a task sends only rows that may be
among the first k overall, not k rows of each task. Nothing is sampled: each
row is in a block, and each block is walked for each anchor until certified.

``nearest`` finds the first k rows within a window of scores for each request
of an anchor; positives (own label) and negatives (another label, score within
fractions of the positive's) are two such searches.

Defined results: rows with a null label, a null or empty vector, or a null or
non-finite component take no part, nor do those with a scaled component beyond
2^26 or whose length is not the most frequent one; rows with a null vec_id are
no anchors and come last among ties, as do later rows of equal vec_ids; repeated
anchors are anchors of their own, and "other" rows are all but the anchor's own
row; no anchors, no positives or an empty table give no rows; other input
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import stored, table
from tessera.llm.whitening import dimension_of, whole_vectors

SCALE = 256
LARGEST = 1 << 26
#: Rows of a block, and bytes of anchors of one round (what the driver and each task hold of them).
BLOCK_ROWS = 1 << 13
ROUND_BYTES = 16 << 20
#: Anchors of one cluster at most, about; rows scored in one step of a walk; one in so many blocks goes first.
CLUSTER_ANCHORS = 64
STEP = 512
FIRST = 16
LLOYD_ROUNDS, CENTRE_ROWS = 4, 4096
#: More than rounding can take from an angle (arc cosines near 1 lose half of the digits).
ANGLE_SLACK = 1e-7

_BLOCKS = "block bigint, n int, ids binary, rows binary, labels binary, vectors binary"
_FOUND = "request bigint, id bigint, row bigint, score bigint"
_NO_ID = (1 << 63) - 1
_FLOOR = -(1 << 62)


class Rows(NamedTuple):
    """Rows that take part, by column."""

    ids: np.ndarray
    rows: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray

    def at(self, place: np.ndarray) -> Rows:
        return Rows(*(x[place] for x in self))


class Requests(NamedTuple):
    """What is wanted of anchors: ``owner`` is the anchor's place, ``number``
    names the request; scores from ``low`` to ``high``; ``own`` wants the
    anchor's label, else another; ``floor`` is a score that k rows reach."""

    owner: np.ndarray
    number: np.ndarray
    low: np.ndarray
    high: np.ndarray
    floor: np.ndarray


def _block_task(dimension: int, flip: int, classes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 33
        number = seen = 0
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(lo, BLOCK_ROWS)
                places, x = whole_vectors(part.column(1), dimension, SCALE, 0)
                labels = part.column(2).cast(pa.int64())
                ok = ~np.asarray(labels.is_null())[places] & (np.abs(x) <= LARGEST).all(axis=1)
                places, x = places[ok], x[ok].astype("<i4")
                if len(places):
                    known = ~np.asarray(part.column(0).is_null())[places]
                    ids = part.column(0).fill_null(_NO_ID).to_numpy()[places].astype("<i8")
                    label = labels.fill_null(0).to_numpy()[places].astype("<i8")
                    if flip:
                        label = np.where(known & (ids % flip == 0), (label + 1) % classes, label)
                    row = [(base + number, len(places), ids.tobytes(), (base + seen + places).astype("<i8").tobytes(), label.astype("<i8").tobytes(), x.tobytes())]
                    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in row], t) for i, t in enumerate((pa.int64(), pa.int32(), *[pa.binary()] * 4))], [c.split()[0] for c in _BLOCKS.split(", ")])
                    number += 1
                seen += part.num_rows

    return run


def _unpacked(batch: pa.RecordBatch, i: int) -> Rows:
    n = batch.column(1)[i].as_py()
    ids, rows, labels = (np.frombuffer(batch.column(k)[i].as_buffer(), "<i8") for k in (2, 3, 4))
    return Rows(ids, rows, labels, np.frombuffer(batch.column(5)[i].as_buffer(), "<i4").reshape(n, -1))


def packed(embeddings: DataFrame, flip: int = 0, classes: int = 10) -> DataFrame | None:
    """The rows that take part, in blocks, written once; None where no vector has a length."""
    dimension = dimension_of(embeddings.select("embedding"))
    if not dimension:
        return None
    source = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.col("label").cast("long").alias("label"))
    return stored(source.mapInArrow(_block_task(dimension, flip, classes), _BLOCKS), "negatives-blocks")


def _every_task(every: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = _unpacked(batch, i)
                mine = rows.at(np.flatnonzero((rows.ids % every == 0) & (rows.ids != _NO_ID)))
                vectors = [x.tobytes() for x in mine.vectors]
                yield pa.RecordBatch.from_arrays([pa.array(mine.rows), pa.array(mine.ids), pa.array(mine.labels), pa.array(vectors, pa.binary())], ["row", "id", "label", "vector"])

    return run


def anchors_of(blocks: DataFrame, every: int) -> DataFrame:
    """The rows whose vec_id is divisible by ``every``: row, id, label, vector."""
    return blocks.mapInArrow(_every_task(every), "row bigint, id bigint, label bigint, vector binary")


# --- clusters and walks ----------------------------------------------------------------


def _units(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    y = x.astype(np.float64)
    norms = np.sqrt((y * y).sum(axis=1))
    return y / np.where(norms > 0, norms, 1)[:, None], norms


def clusters(vectors: np.ndarray, size: int = CLUSTER_ANCHORS) -> list[np.ndarray]:
    """Places of a round's anchors, clustered by direction (spherical k-means;
    centres from ``CENTRE_ROWS`` evenly spaced anchors at most, all assigned)."""
    units, _ = _units(vectors)
    if not len(units):
        return []
    basis = units[:: -(-len(units) // CENTRE_ROWS)]
    count = min(-(-len(units) // size), len(basis))
    centres = basis[np.linspace(0, len(basis) - 1, count).astype(int)]
    for _ in range(LLOYD_ROUNDS):
        near = (basis @ centres.T).argmax(axis=1)
        for k in np.unique(near):
            centres[k] = basis[near == k].sum(axis=0)
        centres, _ = _units(centres)
    near = np.concatenate([(units[a : a + 4096] @ centres.T).argmax(axis=1) for a in range(0, len(units), 4096)])
    order = np.argsort(near, kind="stable")
    cut = np.flatnonzero(np.diff(near[order])) + 1
    return [part for group in np.split(order, cut) for part in np.array_split(group, -(-len(group) // (4 * size)))]


def upper_bounds(members: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """For each vector a bound on its inner product with any member's unit vector."""
    units, _ = _units(members)
    (centre,), _ = _units(units.sum(axis=0, keepdims=True))
    widest = np.arccos(np.clip(units @ centre, -1, 1)).max()
    x, norms = _units(vectors)
    angle = np.arccos(np.clip(x @ centre, -1, 1))
    return norms * np.cos(np.maximum(0, angle - widest - ANGLE_SLACK)) * (1 + 1e-9)


def _scores(anchors: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact integer inner products: in doubles where all sums stay below 2^53."""
    top = float(np.abs(anchors).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * anchors.shape[1]
    if top < 2.0**53:
        return (anchors.astype(np.float64) @ vectors.T.astype(np.float64)).astype(np.int64)
    return anchors.astype(np.int64) @ vectors.T.astype(np.int64)


class Best:
    """The first k rows so far of each request."""

    def __init__(self, requests: Requests, k: int):
        self.k, self.requests = k, requests
        self.kept: list[list[tuple[int, int, int]]] = [[] for _ in requests.number]  # (-score, id, row), ascending
        self.need = np.maximum(requests.low, requests.floor)

    def add(self, at: int, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        kept = sorted([*self.kept[at], *zip((-scores).tolist(), ids.tolist(), rows.tolist())])[: self.k]
        self.kept[at] = kept
        if len(kept) == self.k:
            self.need[at] = max(self.need[at], -kept[-1][0])


def walk(anchors: Rows, members: list[np.ndarray], of: list[np.ndarray], best: Best, own: bool, block: Rows) -> int:
    """Every cluster's members walk its list of a block; ``of`` has the requests
    of each anchor. Returns how many scores were computed."""
    scored = 0
    lengths = np.sqrt((anchors.vectors.astype(np.float64) ** 2).sum(axis=1))
    requests = best.requests
    for cluster in members:
        cluster = cluster[[len(of[a]) > 0 for a in cluster]]
        if not len(cluster):
            continue
        bound = upper_bounds(anchors.vectors[cluster], block.vectors)
        order = np.argsort(-bound, kind="stable")
        active = cluster
        for lo in range(0, len(order), STEP):
            # Whoever needs more than the bound allows from here on has certainly all of this block.
            need = np.array([best.need[of[a]].min() for a in active])
            active = active[bound[order[lo]] * lengths[active] + 1 >= need]
            if not len(active):
                break
            part = block.at(order[lo : lo + STEP])
            scores = _scores(anchors.vectors[active], part.vectors)
            scored += scores.size
            same = anchors.labels[active][:, None] == part.labels[None, :]
            fits = (same if own else ~same) & (anchors.rows[active][:, None] != part.rows[None, :])
            for a, mine, ok in zip(active, scores, fits):
                for q in of[a]:
                    hit = np.flatnonzero(ok & (mine >= best.need[q]) & (mine <= requests.high[q]))
                    if len(hit):
                        best.add(q, mine[hit], part.ids[hit], part.rows[hit])
    return scored


def _walk_task(anchors: Rows, members: list[np.ndarray], requests: Requests, k: int, own: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = np.argsort(requests.owner, kind="stable")
        of = np.split(order, np.searchsorted(requests.owner[order], np.arange(1, len(anchors.ids))))
        best = Best(requests, k)
        for batch in batches:
            for i in range(batch.num_rows):
                walk(anchors, members, of, best, own, _unpacked(batch, i))
        number = np.repeat(requests.number, [len(x) for x in best.kept])
        flat = np.array([x for kept in best.kept for x in kept], np.int64).reshape(-1, 3)
        for lo in range(0, len(flat), 1 << 15):
            part = slice(lo, lo + (1 << 15))
            yield pa.RecordBatch.from_arrays([pa.array(number[part]), *(pa.array(x) for x in (flat[part, 1], flat[part, 2], -flat[part, 0]))], [c.split()[0] for c in _FOUND.split(", ")])

    return run


def _first(found: DataFrame, k: int) -> DataFrame:
    """The first k rows of each request, with their rank."""
    order = Window.partitionBy("request").orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(blocks: DataFrame, anchors: Rows, requests: Requests, k: int, own: bool) -> DataFrame:
    """request, id, row, score of at least the first ``k`` rows of each request
    of a round's anchors (``_first`` takes them)."""
    members = clusters(anchors.vectors)
    head = blocks.where(F.pmod(F.xxhash64("block"), F.lit(FIRST)) == 0).mapInArrow(_walk_task(anchors, members, requests, k, own), _FOUND)
    reached = _first(head, k).where(F.col("rank") == k).select("request", "score").collect()  # one a request of the round at most
    floors = dict(zip((r["request"] for r in reached), (r["score"] for r in reached)))
    floor = np.array([floors.get(n, _FLOOR) for n in requests.number.tolist()], np.int64)
    return blocks.mapInArrow(_walk_task(anchors, members, requests._replace(floor=floor), k, own), _FOUND)


# --- mining ---------------------------------------------------------------------------


def _rounds(anchors: DataFrame, wanted: DataFrame | None = None) -> Iterator[tuple[Rows, list]]:
    """Anchors in rounds of about ``ROUND_BYTES``; with ``wanted`` (row, wanted)
    those that have such a row, and their lists. One round is on the driver at a time."""
    size = anchors.agg(F.sum(F.octet_length("vector") + 400)).first()[0] or 0
    count = -(-size // ROUND_BYTES)
    if wanted is not None:
        anchors = anchors.join(wanted, "row")
    for k in range(count):
        got = anchors.where(F.pmod(F.xxhash64("row"), F.lit(count)) == k).collect()
        if got:
            vectors = np.frombuffer(b"".join(r["vector"] for r in got), "<i4").reshape(len(got), -1)
            yield Rows(*(np.array([r[c] for r in got], np.int64) for c in ("id", "row", "label")), vectors), [r["wanted"] for r in got] if wanted is not None else []


def _all_rounds(parts: list[DataFrame], schema: str, spark: SparkSession) -> DataFrame:
    found = spark.createDataFrame([], schema)
    for part in parts:
        found = found.unionByName(part)
    return found


def positives(blocks: DataFrame, anchors: DataFrame, k: int) -> DataFrame:
    """anchor (its row), rank, id, row, score of the first ``k`` other rows of each anchor's label."""
    parts = []
    for rows, _ in _rounds(anchors):
        n = len(rows.ids)
        any_score = np.full(n, _FLOOR, np.int64)
        requests = Requests(np.arange(n), rows.rows, any_score, -any_score, any_score)
        parts.append(stored(_first(nearest(blocks, rows, requests, k, True), k), "negatives-positives"))
    return _all_rounds(parts, f"{_FOUND}, rank int", blocks.sparkSession).withColumnRenamed("request", "anchor")


def mine(embeddings: DataFrame, every: int = 100, n_positives: int = 5, k: int = 10, low: int = 30, high: int = 90, flip: int = 0, classes: int = 10) -> DataFrame:
    """The first ``k`` rows of another label with a score of ``low`` to ``high``
    hundredths of the positive's, for each anchor and each of its positives."""
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    spark = embeddings.sparkSession
    blocks = packed(embeddings, flip, classes)
    if blocks is None:
        return spark.createDataFrame([], schema)
    anchors = stored(anchors_of(blocks, every), "negatives-anchors")
    chosen = positives(blocks, anchors, n_positives)
    listed = chosen.groupBy("anchor").agg(F.collect_list(F.struct("rank", "id", "score")).alias("wanted")).withColumnRenamed("anchor", "row")
    parts = []
    for rows, wanted in _rounds(anchors, listed):
        owner = np.repeat(np.arange(len(wanted)), [len(w) for w in wanted])
        rank, _, score = np.array([w for each in wanted for w in each], np.int64).T
        requests = Requests(owner, rows.rows[owner] * n_positives + rank - 1, -(-low * score // 100), high * score // 100, np.full(len(owner), _FLOOR, np.int64))
        requests = Requests(*(x[requests.low <= requests.high] for x in requests))  # else no score fits
        if len(requests.owner):
            parts.append(stored(_first(nearest(blocks, rows, requests, k, False), k), "negatives-found"))
    every_part = _all_rounds(parts, f"{_FOUND}, rank int", spark).select(
        F.expr(f"request div {int(n_positives)}").alias("anchor"),
        (F.col("request") % n_positives + 1).cast("int").alias("positive"),
        "id",
        "score",
        F.col("rank").alias("at"),
    )
    named = chosen.select("anchor", F.col("rank").alias("positive"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    own = anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    full = every_part.join(named, ["anchor", "positive"]).join(own, "anchor")
    shown = lambda c: F.when(F.col(c) != _NO_ID, F.col(c))
    return full.select("anchor_id", shown("positive_id").alias("positive_id"), F.col("at").cast("int").alias("rank"), shown("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(table(spark, sf_dir, "embeddings"), flip=7)


#: The query's contract in DuckDB SQL.
OP11_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         CAST(list_inner_product(CAST(a.x AS DOUBLE[]), CAST(b.x AS DOUBLE[])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank,
       s.id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
 AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""
