import numpy as np
import pytest
from pyspark.sql import types as T

from tessera.llm import whitening

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("label", T.IntegerType()), T.StructField("component", T.StringType())])


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, 1, "clash") for i, v in rows], SCHEMA).repartition(parts)


def brute(rows, most=32):
    """Exact sums, covariance by numpy, one dense eigendecomposition."""
    part = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for _, v in part], object)
    n, sums = len(part), x.sum(axis=0)
    deviations = ((n * x - sums) ** 2).sum(axis=1)
    y = ((n * x - sums) / n).astype(float)
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = [i for i in range(min(most, len(values))) if values[i] > 1e-9]
    return [i for i, _ in part], n, deviations.tolist(), y @ vectors[:, k] / np.sqrt(values[k]), values[k] / values.sum()


def check(got, rows, tolerance=1e-8):
    ids, n, deviations, white, explained = brute(rows)
    by_row = {}
    for r in got:
        by_row.setdefault((r["vec_id"], r["deviation"]), {}).setdefault(r["component"], []).append(r)
    assert len(got) == white.size and {r["n"] for r in got} <= {n}
    signs = {}
    for at, (i, d) in enumerate(zip(ids, deviations)):
        mine = by_row[i, d]
        assert sorted(mine) == list(range(1, white.shape[1] + 1))
        for c, found in mine.items():
            want = white[at, c - 1]
            near = min(found, key=lambda r: min(abs(r["whitened"] - want), abs(r["whitened"] + want)))["whitened"]
            if abs(want) > 1e-3 and len(found) == 1:
                signs.setdefault(c, set()).add(np.sign(near * want))
            assert abs(near) == pytest.approx(abs(want), abs=tolerance)
            assert found[0]["explained"] == pytest.approx(explained[c - 1], rel=1e-9)
    assert all(len(s) == 1 for s in signs.values())  # one sign for all rows
    assert all(r["identity_error"] == got[0]["identity_error"] <= 1e-9 for r in got)


def random_rows(n, d, seed=0, spread=1.0):
    rng = np.random.default_rng(seed)
    return [(i, (rng.normal(size=d) * spread ** np.arange(d)).tolist()) for i in range(n)]


def test_query(spark, sf001):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf001}/embeddings.parquet").collect()]
    check(whitening.op12_whitening(spark, sf001).collect(), rows)


def test_ill_conditioned_rows(spark):
    """Variances over eight orders of magnitude: small components keep their digits."""
    rows = random_rows(100, 10, spread=3.0)
    check(whitening.components(frame(spark, rows)).collect(), rows, 1e-7)


def test_odd_rows(spark):
    rows = random_rows(60, 4) + [(1, [0.5, 0.5, 0.5, 0.5])] * 3 + [(None, [1.0, 2.0, 3.0, -4.0])]
    odd = [(100, None), (101, []), (102, [1.0, None, 2.0, 3.0]), (103, [float("nan")] * 4), (104, [float("inf"), 0.0, 0.0, 0.0]), (105, [1.0]), (106, [1e300, 0.0, 0.0, 0.0])]
    got = whitening.components(frame(spark, rows + odd, 5)).collect()
    check(got, rows)


def test_rank_deficient_rows(spark):
    """A constant dimension and one that repeats another have no component of their own."""
    rows = [(i, [v[0], v[1], 7.0, v[0]]) for i, v in random_rows(80, 2)]
    got = whitening.components(frame(spark, rows)).collect()
    assert {r["component"] for r in got} == {1, 2}
    check(got, rows)


def test_alike_and_empty(spark):
    assert whitening.components(frame(spark, [(i, [1.0, 2.0]) for i in range(5)])).collect() == []
    assert whitening.components(frame(spark, [(1, [1.0, 2.0])], 1)).collect() == []
    assert whitening.components(frame(spark, [(1, None)], 1)).collect() == []
    assert whitening.components(spark.createDataFrame([], SCHEMA)).collect() == []


def test_exact_deviations_of_large_entries(spark):
    rows = [(i, [i * 1.1e6, float(-i)]) for i in range(6)] + [(6, [4.0e9, 0.0])]
    got = {r["vec_id"]: r["deviation"] for r in whitening.components(frame(spark, rows)).where("component = 1").collect()}
    want = dict(zip(*[brute(rows)[k] for k in (0, 2)]))
    assert got == {i: d if d < 2**63 else None for i, d in want.items()} and None in got.values()
    rows = rows[:6]
    got = {r["vec_id"]: r["deviation"] for r in whitening.components(frame(spark, rows)).where("component = 1").collect()}
    assert got == dict(zip(*[brute(rows)[k] for k in (0, 2)])) and max(got.values()) > 2**53


def test_triangle_is_the_qr_factor(spark):
    rows = random_rows(300, 40, 3)
    vectors = frame(spark, rows).select("embedding")
    n, sums = whitening._sums(vectors, 40)
    centre = whitening.Centre(n, sums)
    y = centre.apply(np.array([np.floor(64 * np.array(v)) + 1_000_000 for _, v in rows]).astype(np.int64))
    r = whitening.triangle(vectors, 40, centre)
    want = np.linalg.qr(y)[1]
    assert np.allclose(np.abs(r), np.abs(want), rtol=1e-10, atol=1e-9) and np.allclose(np.tril(r, -1), 0)


def test_solve_rows():
    rng = np.random.default_rng(0)
    r = np.triu(rng.normal(size=(70, 70))) + 5 * np.eye(70)
    y = rng.normal(size=(9, 70))
    assert np.allclose(whitening.solve_rows(y, r) @ r, y)
