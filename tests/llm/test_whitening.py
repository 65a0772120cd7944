"""Whitening beside whole-number covariances in plain Python and numpy."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from stayflow.llm import whitening as wh
from stayflow.llm.queries import op13_embedding_whitening

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(vectors):
    """n, sums, deviations, covariance of the whole numbers."""
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors], object)
    n, sums = len(x), x.sum(axis=0)
    y = n * x - sums
    covariance = np.array([[e / n**3 for e in row] for row in y.T @ y], float)
    return n, y, (y * y).sum(axis=1), covariance


def check(rows, fitted, off, vectors, most=32):
    n, y, deviations, covariance = plain(vectors)
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    k = len(fitted.variances)
    assert fitted.n == n and k == min(most, int(np.sum(values > values[0] * wh.SMALLEST_SHARE)))
    assert np.allclose(fitted.variances, values[:k], rtol=1e-9)
    assert np.allclose(fitted.explained, values[:k] / np.trace(covariance), rtol=1e-9)
    assert off < 1e-9
    by_id = {r.vec_id: r.whitening for r in rows.collect()}
    assert len(by_id) == n
    got = np.array([by_id[i].whitened for i in sorted(by_id)])
    want = (y / n).astype(float) @ axes[:, :k] / np.sqrt(values[:k])
    signs = np.sign((got * want).sum(axis=0))
    assert np.allclose(got, want * signs, atol=1e-8)
    assert [by_id[i].deviation for i in sorted(by_id)] == [int(d) if d < 1 << 63 else None for d in deviations]


def frame(spark, vectors):
    return spark.createDataFrame([(i, [float(c) for c in v], 0) for i, v in enumerate(vectors)], SCHEMA).repartition(5)


def vectors_of(seed, rows, size, spread=1.0):
    rng = np.random.default_rng(seed)
    mixed = rng.normal(size=(rows, size)) @ rng.normal(size=(size, size)) * spread
    return (mixed + rng.normal(size=size) * 5 * spread).tolist()


def test_small_and_wide_vectors(spark):
    for rows, size in ((200, 6), (300, 40), (4, 3), (2, 1)):
        vectors = vectors_of(rows, rows, size)
        check(*wh.whiten(frame(spark, vectors)), vectors)
    vectors = vectors_of(1, 120, 9)
    check(*wh.whiten(frame(spark, vectors), most=2), vectors, most=2)


def test_sums_beyond_64_bits_stay_exact(spark):
    vectors = vectors_of(3, 60, 4, spread=float(1 << 30))
    check(*wh.whiten(frame(spark, vectors)), vectors)
    rng = random.Random(4)
    x = np.array([[rng.randrange(-(1 << 40), 1 << 40) for _ in range(3)] for _ in range(50)], np.int64)
    n, sums = wh.sum_rows(iter([x[:20], x[20:]]))
    assert (n, sums) == (50, [int(s) for s in x.astype(object).sum(axis=0)])
    d = x.astype(object) - 7
    pairs = wh.squares_of_pairs(iter([x[:20], x[20:]]), np.full(3, 7))
    want = [int(((d[:, i] if i == j else d[:, i] + d[:, j]) ** 2).sum()) for i in range(3) for j in range(i, 3)]
    assert pairs == want


def test_sums_move_on_when_64_bits_are_nearly_full():
    sums = wh.ExactSums(1)
    for _ in range(20):
        sums.add(np.array([1 << 60], np.int64), 1 << 60)
    assert sums.totals() == [20 << 60]


def test_rows_that_are_left_out(spark):
    good = vectors_of(5, 30, 3)
    odd = [
        (100, None, 1),
        (101, [], 1),
        (102, [1.0, None, 2.0], 1),
        (103, [1.0, float("nan"), 2.0], 1),
        (104, [1.0, float("inf"), 2.0], 1),
        (105, [1.0, 2.0], 1),
        (106, [1.0, 2.0, float(1 << 41)], 1),
    ]
    df = frame(spark, good).unionByName(spark.createDataFrame(odd, SCHEMA)).withColumn("whitening", F.lit("old"))
    rows, fitted, off = wh.whiten(df)
    assert rows.columns == df.columns
    check(rows, fitted, off, good)


def test_repeated_rows_and_null_ids_count_row_by_row(spark):
    good = vectors_of(6, 20, 3)
    df = frame(spark, good).unionByName(frame(spark, good)).withColumn("vec_id", F.lit(None).cast("long"))
    rows, fitted, off = wh.whiten(df)
    assert fitted.n == rows.count() == 40 and off < 1e-9
    assert np.allclose(fitted.variances, np.linalg.eigvalsh(plain(good + good)[3])[::-1], rtol=1e-9)


def test_without_spread_there_is_no_component(spark):
    for vectors in ([], [[1.0, 2.0]], [[1.0, 2.0]] * 7):
        rows, fitted, off = wh.whiten(frame(spark, vectors) if vectors else spark.createDataFrame([], SCHEMA))
        assert len(fitted.variances) == 0 and off == 0.0
        assert [r.whitening.whitened for r in rows.collect()] == [[]] * len(vectors)
    # Dimensions that follow others add no component.
    flat = [[a, 2 * a, b, a + b] for a, b in np.random.default_rng(2).integers(-50, 50, (60, 2)).astype(float).tolist()]
    rows, fitted, off = wh.whiten(frame(spark, flat))
    assert len(fitted.variances) == 2 and off < 1e-9


def test_floats_and_query(spark):
    folder = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{folder}/embeddings.parquet").orderBy("vec_id").collect()
    n, y, deviations, covariance = plain([r.embedding for r in table])
    values, axes = np.linalg.eigh(covariance)
    rows = op13_embedding_whitening(spark, folder).collect()
    assert len(rows) == 32 * n and {r.component for r in rows} == set(range(1, 33))
    place = {r.vec_id: i for i, r in enumerate(table)}
    want = (y / n).astype(float) @ axes[:, ::-1][:, :32] / np.sqrt(values[::-1][:32])
    got = np.zeros_like(want)
    for r in rows:
        assert r.n == n and r.deviation == deviations[place[r.vec_id]] and r.identity_error < 1e-9
        assert math.isclose(r.explained, values[::-1][r.component - 1] / np.trace(covariance), rel_tol=1e-9)
        got[place[r.vec_id], r.component - 1] = r.whitened
    assert np.allclose(got, want * np.sign((got * want).sum(axis=0)), atol=1e-9)
