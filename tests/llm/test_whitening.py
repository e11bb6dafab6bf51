"""Whitening against an eigendecomposition of the covariance."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import whitening
from tidemark.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def steps(vectors):
    return np.floor(256 * np.array(vectors, np.float32).astype(np.float64)).astype(np.int64)


def check(rows, ids, x, components=4):
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    centred = fit - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(components, x.shape[1])
    assert len(rows) == len(ids)
    by_id = {r.vec_id: r for r in rows}
    assert {r.n for r in rows} == {n} and max(r.identity_error for r in rows) < 1e-9
    assert all(by_id[i].deviation == int(((n * v - sums) ** 2).sum()) for i, v in zip(ids, x, strict=True))
    for c in range(k):
        wanted = (x - sums / n) @ vectors[:, c] / math.sqrt(values[c])
        got = np.array([by_id[i].whitened[c] for i in ids])
        assert np.allclose(got * np.sign(got @ wanted), wanted, atol=1e-7)
        assert abs(by_id[ids[0]].explained[c] / (values[c] / values.sum()) - 1) < 1e-9


def test_query(spark, folder):
    table = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    rows = QUERIES["op11_whitening"](spark, folder).collect()
    assert len(rows) == 4 * len(table) and {r.component for r in rows} == {1, 2, 3, 4}
    whole = whitening.whitened(spark.read.parquet(f"{folder}/embeddings.parquet")).collect()
    check(whole, [r.vec_id for r in table], steps([r.embedding for r in table]))
    by_key = {(r.vec_id, r.component): r for r in rows}
    assert all(by_key[r.vec_id, c + 1].whitened == pytest.approx(r.whitened[c], abs=1e-9) for r in whole for c in range(4))


def test_awkward_vectors(spark):
    rng = np.random.default_rng(4)
    good = (rng.normal(size=(60, 5)) * [5, 3, 2, 1, 0.5]).astype(np.float32).tolist()
    data = [(i, v, 1) for i, v in enumerate([*good, *good[:7], *[good[0]] * 30])]
    bad = [None, [], [1.0, None, 2.0, 0.0, 0.0], [math.nan] * 5, [math.inf, 0.0, 0.0, 0.0, 0.0], [1.0, 2.0], [-0.0] * 4]
    rows = spark.createDataFrame(data + [(1000 + i, v, None) for i, v in enumerate(bad)], SCHEMA)
    found = whitening.whitened(rows.withColumn("n", F.lit("x")).withColumn("x", F.lit("y"))).collect()
    check(found, [d[0] for d in data], steps([d[1] for d in data]))
    assert whitening.whitened(rows.limit(0)).count() == 0
    assert whitening.whitened(rows.where("embedding IS NULL")).count() == 0


def test_low_rank_and_constant(spark):
    """Dimensions that follow from others, one that never changes, few rows, one row."""
    rng = np.random.default_rng(5)
    base = rng.integers(-20, 20, (50, 2))
    vectors = np.column_stack((base, base.sum(1), np.full(50, 3))) / 256
    rows = spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors.tolist())], SCHEMA)
    found = whitening.whitened(rows).collect()
    x = steps(vectors)
    values = np.linalg.eigvalsh(np.cov(np.unique(x, axis=0).T, bias=True))[::-1]
    assert all(r.whitened[2:] == [None, None] and r.explained[2:] == [0.0, 0.0] for r in found)
    assert np.allclose(found[0].explained[:2], values[:2] / values.sum()) and found[0].identity_error < 1e-9
    single = whitening.whitened(rows.limit(1)).first()
    assert (single.n, single.deviation, single.whitened, single.identity_error) == (1, 0, [None] * 4, None)
    two = whitening.whitened(rows.where("vec_id < 2")).collect()
    assert sorted(round(r.whitened[0], 9) for r in two) == [-1, 1] and two[0].whitened[1:] == [None] * 3


def test_ill_conditioned(spark):
    """Spreads from a million to one: the shifted passes keep small components exact."""
    rng = np.random.default_rng(6)
    x = np.rint(rng.normal(size=(400, 6)) * [1e6, 1e5, 1e4, 100, 10, 3] @ np.linalg.qr(rng.normal(size=(6, 6)))[0]).astype(np.int64)
    fit = spark.createDataFrame([(r,) for r in x.tolist()], "x array<long>")
    r = whitening.triangle(fit, len(x), x.mean(0))
    centred = x - x.mean(0)
    assert np.allclose(np.linalg.svd(r, compute_uv=False), np.linalg.svd(centred, compute_uv=False), rtol=1e-9)


def test_extreme_entries(spark):
    """Entries past the long range take its end, a deviation past it is null."""
    rows = spark.createDataFrame([(1, [3e38, 1.0]), (2, [-3e38, 0.0]), (3, [0.0, 0.5])], "vec_id long, embedding array<float>")
    found = {r.vec_id: r for r in whitening.whitened(rows).collect()}
    assert found[1].deviation is None and found[3].n == 3 and math.isfinite(found[1].whitened[0])


def test_solve_right():
    rng = np.random.default_rng(7)
    r = np.triu(rng.normal(size=(70, 70))) + 10 * np.eye(70)
    a = rng.normal(size=(30, 70))
    assert np.allclose(whitening.solve_right(a, r) @ r, a)
