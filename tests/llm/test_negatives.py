import numpy as np
import pytest
from pyspark.sql import types as T

from tessera.llm import negatives as ng

SCHEMA = T.StructType(
    [T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()), T.StructField("rank", T.StringType()), T.StructField("score", T.StringType())]
)


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, label, "clash", "clash") for i, v, label in rows], SCHEMA).repartition(parts)


def brute(rows, every=100, n_positives=5, k=10, low=30, high=90):
    part = []
    for i, v, label in rows:
        if label is not None and v and all(c is not None and np.isfinite(c) for c in v):
            x = [int(np.floor(256 * float(np.float32(c)))) for c in v]
            part.append((i, (label + 1) % 10 if i is not None and i % 7 == 0 else label, x))
    out = []
    place = lambda i: (i is None, i or 0)
    for at, (anchor, label, x) in enumerate(part):
        if anchor is None or anchor % every:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(x, y)), place(i), i, other) for n, (i, other, y) in enumerate(part) if n != at), key=lambda r: r[:2])
        for s, _, positive, _ in [r for r in scored if r[3] == label][:n_positives]:
            fits = [r for r in scored if r[3] != label and low * -s <= 100 * -r[0] <= high * -s][:k]
            out += [(anchor, positive, rank, i, -s, -t) for rank, (t, _, i, _) in enumerate(fits, 1)]
    return sorted(out, key=str)


def random_rows(n, d=16, seed=0, classes=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(classes, d))
    return [(i, (0.4 * centres[i % classes] + rng.normal(size=d) * 0.3).astype(np.float32).tolist(), int(rng.integers(classes))) for i in range(n)]


def got_of(spark, rows, **options):
    return sorted(map(tuple, ng.mine(frame(spark, rows), flip=7, **options).collect()), key=str)


def test_query(spark, sf001):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{sf001}/embeddings.parquet").collect()]
    assert sorted(map(tuple, ng.op11_negatives(spark, sf001).collect()), key=str) == brute(rows) != []


def test_many_blocks_rounds_and_steps(spark, monkeypatch):
    """Small bounds everywhere: floors from the first blocks, several rounds, walks that end early."""
    for name, value in (("BLOCK_ROWS", 40), ("ROUND_BYTES", 4000), ("STEP", 8), ("FIRST", 3), ("CLUSTER_ANCHORS", 3)):
        monkeypatch.setattr(ng, name, value)
    rows = random_rows(700)
    assert got_of(spark, rows, every=20) == brute(rows, 20) != []


def test_ties_repeats_and_odd_rows(spark):
    rows = random_rows(60, 4) + [(100, [0.5, 0.5, 0.0, 0.0], 1)] * 3 + [(i, [0.25, 0.25, 0.0, 0.0], 2) for i in range(300, 330)] * 2
    rows += [(200, None, 1), (300, [], 1), (400, [0.1, None, 0.1, 0.1], 1), (500, [float("nan")] * 4, 1), (600, [0.1] * 4, None), (None, [0.3, 0.3, 0.0, 0.0], 2), (None, [0.9, 0.9, 0.0, 0.0], 1)]
    rows += [(700, [0.0] * 4, 1), (800, [-0.5, -0.5, 0.0, 0.0], 3), (900, [float("inf")] * 4, 1), (-100, [0.4, 0.4, 0.1, 0.0], 1)]
    assert got_of(spark, rows) == brute(rows)


def test_without_results(spark):
    assert got_of(spark, []) == []
    assert got_of(spark, [(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 2)]) == []  # no anchor
    assert got_of(spark, [(100, [1.0, 2.0], 1), (3, [1.0, 2.0], 2)]) == []  # no positive
    assert got_of(spark, [(100, None, 1)]) == []
    assert got_of(spark, [(1000, [3e9, 0.0], 1), (100, [1.0, 2.0], 1), (3, [1.0, 1.0], 1), (4, [0.5, 1.0], 2)])[0][:2] == (100, 3)  # too large to take part


def test_bounds_hold_and_walks_end_early():
    rng = np.random.default_rng(0)
    base = rng.normal(size=64)
    members = (100 * (base + 0.1 * rng.normal(size=(30, 64)))).astype(np.int64)
    vectors = (100 * rng.normal(size=(4000, 64))).astype(np.int32)
    vectors[:40] = (90 * (base + 0.1 * rng.normal(size=(40, 64)))).astype(np.int32)
    units = members / np.linalg.norm(members, axis=1)[:, None]
    assert ((units @ vectors.T).max(axis=0) <= ng.upper_bounds(members, vectors)).all()
    n = len(members)
    anchors = ng.Rows(np.arange(n), -1 - np.arange(n), np.ones(n, np.int64), members.astype(np.int32))
    block = ng.Rows(np.arange(4000), np.arange(4000), np.ones(4000, np.int64), vectors)
    requests = ng.Requests(np.arange(n), np.arange(n), *(np.full(n, x, np.int64) for x in (ng._FLOOR, -ng._FLOOR, ng._FLOOR)))
    best = ng.Best(requests, 5)
    scored = ng.walk(anchors, [np.arange(n)], [np.array([i]) for i in range(n)], best, True, block)
    exact = members @ vectors.T.astype(np.int64)
    for i in range(n):
        order = np.lexsort((np.arange(4000), -exact[i]))[:5]
        assert [(-s, r) for s, _, r in best.kept[i]] == [(exact[i, j], j) for j in order]
    assert scored < exact.size / 2


def test_exact_beyond_doubles():
    a = np.full((1, 64), ng.LARGEST, np.int32)
    b = np.array([[ng.LARGEST - 1] * 63 + [ng.LARGEST]], np.int32)
    assert ng._scores(a, b)[0, 0] == 63 * ng.LARGEST * (ng.LARGEST - 1) + ng.LARGEST**2


def test_clusters_hold_every_anchor():
    x = np.random.default_rng(0).normal(size=(1000, 8)) * 100
    x[:5] = 0
    parts = ng.clusters(x.astype(np.int64))
    assert sorted(np.concatenate(parts).tolist()) == list(range(1000)) and max(map(len, parts)) <= 4 * ng.CLUSTER_ANCHORS
    assert ng.clusters(np.zeros((0, 8), np.int64)) == []
