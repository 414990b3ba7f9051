"""Whitening: brute force on the small tables, the eigen solver on hard spectra, defined cases."""

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import types as T

from kickwx.llm.queries import op13_embedding_whitening
from kickwx.llm.whitening import leading_eigenpairs, positive_inertia, whiten_embeddings

SF = "/root/testdata/sf0.001"
TABLE = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("x", T.StringType()), T.StructField("component", T.StringType()), T.StructField("n", T.StringType()),
])


def brute(rows, count):
    kept = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, d = len(fit), len(fit[0])
    sums = [sum(x[j] for x in fit) for j in range(d)]
    gaps = np.array([[(n * x[j] - sums[j]) / n for j in range(d)] for x in fit])
    values, vectors = np.linalg.eigh(gaps.T @ gaps / n)
    values, vectors = values[::-1][:count], vectors[:, ::-1][:, :count]
    out = []
    for i, x in kept:
        deviation = sum((n * x[j] - sums[j]) ** 2 for j in range(d))
        gap = np.array([(n * x[j] - sums[j]) / n for j in range(d)])
        out.append((i, n, deviation, gap @ vectors / np.sqrt(values)))
    return out, values, float(np.trace(gaps.T @ gaps / n))


def test_matches_brute_force(spark):
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet'").fetchall()
    want, values, trace = brute(rows, 16)
    got = {}
    for r in op13_embedding_whitening(spark, SF).collect():
        got.setdefault(r["vec_id"], []).append(r)
    assert sorted(got) == sorted(i for i, *_ in want)
    ours = {i: np.array([r["whitened"] for r in sorted(rs, key=lambda r: r["component"])]) for i, rs in got.items()}
    signs = np.sign(sum(ours[i] * w for i, _, _, w in want))
    for i, n, deviation, white in want:
        assert {(r["n"], r["deviation"]) for r in got[i]} == {(n, deviation)}
        assert np.allclose(ours[i] * signs, white, rtol=1e-6, atol=1e-8)
    some = sorted(got[want[0][0]], key=lambda r: r["component"])
    assert [r["component"] for r in some] == list(range(1, 17))
    assert np.allclose([r["explained"] for r in some], values / trace, rtol=1e-9)
    assert some[0]["identity_error"] < 1e-9


@pytest.mark.parametrize("spectrum", [
    np.arange(40, 0, -1.0), np.r_[np.full(6, 5.0), np.full(34, 1.0)], 10.0 ** -np.arange(40), np.r_[3.0, np.zeros(39)],
    np.r_[2.0, 2.0 - 1e-12, 2.0 - 2e-12, np.linspace(1, 0, 37)], np.zeros(40), -np.arange(1, 41.0),
])
def test_solver_on_spectra(spectrum):
    basis = np.linalg.qr(np.random.default_rng(5).standard_normal((40, 40)))[0]
    matrix = basis * spectrum @ basis.T
    matrix = (matrix + matrix.T) / 2
    values, vectors = leading_eigenpairs(matrix, 16)
    norm = max(1.0, np.abs(spectrum).max())
    assert np.allclose(values, np.sort(spectrum)[::-1][:16], atol=1e-12 * norm)
    assert np.allclose(vectors.T @ vectors, np.eye(16), atol=1e-12)
    assert np.abs(matrix @ vectors - vectors * values).max() < 1e-12 * norm


def test_inertia():
    rng = np.random.default_rng(3)
    for size in (1, 2, 5, 17, 33):
        for _ in range(20):
            m = rng.standard_normal((size, size))
            m = m + m.T
            assert positive_inertia(m) == int((np.linalg.eigvalsh(m) > 0).sum())
    assert positive_inertia(np.array([[0.0, 1.0], [1.0, 0.0]])) == 1


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [0.5, -2.0]), (2, None), (3, [None, 1.0]), (4, [nan, 1.0]), (5, [inf, 0.0]),
            (6, []), (7, [1.0]), (8, [3.0, 0.25])]
    table = spark.createDataFrame([(i, v, "a", "b", "c") for i, v in rows], TABLE)
    got = whiten_embeddings(table).collect()
    assert sorted((r["vec_id"] or 0, r["component"]) for r in got) == [(0, 1), (0, 2), (1, 1), (1, 1), (1, 2), (1, 2), (8, 1), (8, 2)]
    assert {r["n"] for r in got} == {3} and all(r["identity_error"] < 1e-9 for r in got)
    assert whiten_embeddings(table.filter("false")).count() == 0
    assert whiten_embeddings(table.filter("vec_id IN (2, 3, 4, 5, 6)")).count() == 0
    flat = whiten_embeddings(table.filter("vec_id IN (1, 2)")).collect()  # one vector: no variance
    assert len(flat) == 4 and {(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in flat} == {(1, 0, None, 0.0, None)}


def test_numbers_beyond_64_bits(spark):
    rows = [(1, [3e38, 0.0], "", "", ""), (2, [-3e38, 1.0], "", "", ""), (3, [1e12, 2.0], "", "", ""), (4, [0.0, 3.0], "", "", "")]
    got = whiten_embeddings(spark.createDataFrame(rows, TABLE)).collect()
    assert len(got) == 8 and {r["deviation"] for r in got} == {None}
    assert all(math.isfinite(r["whitened"]) for r in got if r["component"] == 1)
