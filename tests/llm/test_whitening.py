"""Whitening against dense linear algebra."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from storelens.llm import queries, whitening

SF_DIR = "/root/testdata/sf0.01"


def whole(v):
    return None if v is None or any(x is None or not math.isfinite(x) for x in v) else tuple(math.floor(64 * x) + 1_000_000 for x in v)


def check(rows, found, components=16):
    """``found`` against eigenvectors of the dense covariance; signs are free."""
    usable = [(own, whole(v)) for own, v in rows if v and whole(v)]
    fit = sorted({x for _, x in usable})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[n * a - s for a, s in zip(x, sums)] for x in fit], dtype=object).astype("f8") / n
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    count = min(components, int((values > 1e-12 * values[0]).sum()))
    assert len(found) == len(usable) * count
    by_row = {}
    for r in found:
        by_row.setdefault((r["vec_id"], r["deviation"]), {})[r["component"]] = r["whitened"]
        assert r["n"] == n and r["identity_error"] < 1e-9
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / values.sum(), rel=1e-9)
    turn = vectors[:, :count] / np.sqrt(values[:count])
    signs = None
    for own, x in usable:
        exact = [n * a - s for a, s in zip(x, sums)]
        got = by_row[own, sum(e * e for e in exact)]
        want = np.array(exact, dtype=object).astype("f8") / n @ turn
        got = np.array([got[c] for c in range(1, count + 1)])
        if signs is None and np.abs(want).min() > 1e-3:
            signs = np.sign(got * want)
    for own, x in usable:
        exact = [n * a - s for a, s in zip(x, sums)]
        got = by_row[own, sum(e * e for e in exact)]
        want = np.array(exact, dtype=object).astype("f8") / n @ turn * signs
        assert np.allclose([got[c] for c in range(1, count + 1)], want, atol=1e-8)


def test_jacobi_davidson_reaches_rounding():
    draw = np.random.default_rng(1)
    for size, scale in ((1, 1.0), (5, 1.0), (64, 1.0), (200, np.arange(1, 201) ** -1.0), (64, np.where(np.arange(64) < 3, 1.0, 0.0))):
        x = draw.standard_normal((1000, size)) * scale
        matrix = x.T @ x / len(x)
        values, vectors = whitening.jacobi_davidson(lambda block: matrix @ block, size, 16)  # noqa: B023
        assert np.allclose(values, np.linalg.eigvalsh(matrix)[::-1][:16], atol=1e-13 * values[0], rtol=0)
        assert np.abs(matrix @ vectors - vectors * values).max() < 1e-13 * values[0]
        assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-13


def test_equal_eigenvalues():
    values, vectors = whitening.jacobi_davidson(lambda block: 3.0 * block, 40, 16)
    assert np.allclose(values, 3.0) and np.abs(vectors.T @ vectors - np.eye(16)).max() < 1e-13


def test_minres_is_the_least_residual_of_its_space():
    draw = np.random.default_rng(2)
    x = draw.standard_normal((30, 30))
    matrix, inside = x + x.T, np.linalg.qr(draw.standard_normal((30, 2)))[0]
    project = np.eye(30) - inside @ inside.T
    right, shift, steps = draw.standard_normal((30, 1)), np.array([0.3]), 5
    got = whitening.minres(lambda block: matrix @ block, shift, inside, right, steps)
    system = project @ (matrix - 0.3 * np.eye(30)) @ project
    krylov = np.linalg.qr(np.column_stack([np.linalg.matrix_power(system, k) @ project @ right for k in range(steps)]))[0]
    weights = np.linalg.lstsq(system @ krylov, (project @ right)[:, 0], rcond=None)[0]
    assert np.allclose(got[:, 0], krylov @ weights, atol=1e-8)


def test_odd_vectors(spark):
    draw = np.random.default_rng(3)
    rows = [(n, [float(v) for v in draw.standard_normal(20)]) for n in range(300)]
    rows += [(1000 + n, rows[5][1]) for n in range(150)] + [(7, rows[8][1]), (7, rows[7][1]), (None, rows[9][1])]
    unusable = [(400, None), (401, [None] * 20), (402, [float("nan")] * 20), (403, [float("inf")] * 20), (404, []), (405, [1.0, 2.0])]
    frame = spark.createDataFrame(rows + unusable, "vec_id long, embedding array<double>").withColumns(
        {name: F.lit(1) for name in ("x_", "id_", "n", "component", "whitened", "place", "value", "size_")})
    found = whitening.whiten(frame, whitening.scaled(F.col("embedding"))).collect()
    check(rows, found)
    for empty in (frame.limit(0), frame.where("vec_id = 5"), frame.where("vec_id >= 400 and vec_id < 405")):
        assert whitening.whiten(empty, whitening.scaled(F.col("embedding"))).isEmpty()


def test_wide_range(spark):
    rows = [(n, [1e300 * (-1) ** n, float(n), 1e12 * n]) for n in range(50)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = whitening.whiten(frame, whitening.scaled(F.col("embedding"))).collect()
    assert found and all(r["deviation"] == 2**63 - 1 for r in found)


def test_query(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    check(rows, queries.queries()["op13_whitening"](spark, SF_DIR).collect())
