"""Whitening against a dense eigensolver, and its parts against plain counts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenureline.llm import whitening


def local_solver(matrix):
    def solve(solves, blocks):
        out = {i: np.zeros_like(x) for i, x in blocks.items()}
        for i, shift, weight in solves:
            out[i] += (weight * np.linalg.solve(shift * np.eye(len(matrix)) - matrix, blocks[i].astype(complex))).real
        return out

    return solve


def matrices():
    draw = np.random.default_rng(5)
    spectra = [draw.uniform(0, 9, 40), [5.0] * 10 + [1.0] * 2, [1.0] * 20, 10.0 ** -np.arange(12), [3.0], [4.0, 4.0 - 1e-9, 4.0 - 2e-9, 1.0, 0.0, 0.0]]
    for spectrum in spectra:
        q = np.linalg.qr(draw.normal(size=(len(spectrum),) * 2))[0]
        matrix = q * np.array(spectrum) @ q.T
        yield (matrix + matrix.T) / 2


@pytest.mark.parametrize("matrix", list(matrices()))
def test_eigenpairs_equal_the_dense_solver(matrix):
    values = np.linalg.eigvalsh(matrix)[::-1]
    k = min(4, len(matrix))
    intervals = whitening.leading_intervals(matrix, k)
    found, vectors = whitening.eigenpairs(matrix, intervals, local_solver(matrix))
    assert len(found) == sum(n for *_, n in intervals) >= k
    assert np.abs(found - values[: len(found)]).max() < 1e-13 * values[0] * len(matrix)
    assert np.abs(matrix @ vectors.T - vectors.T * found).max() < 1e-12 * values[0]
    assert np.abs(vectors @ vectors.T - np.eye(len(found))).max() < 1e-10


def test_inertia_counts_eigenvalues_below():
    draw = np.random.default_rng(6)
    for n in (1, 2, 3, 9, 30):
        for _ in range(20):
            x = draw.normal(size=(n, n)) * (draw.random((n, n)) < 0.5)
            matrix = x + x.T
            shift = float(draw.normal())
            assert whitening.below(matrix, shift) == int((np.linalg.eigvalsh(matrix) < shift).sum())


def test_whitening_equals_the_dense_solver(spark):
    draw = np.random.default_rng(7)
    x = draw.normal(size=(400, 9)) * np.linspace(0.2, 1, 9)
    data = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000 + i, x[3].tolist()) for i in range(300)]
    data += [(2000, None), (2001, [None] * 9), (2002, [float("nan")] * 9), (2003, [float("inf")] * 9), (2004, [0.5, -0.0]), (None, x[4].tolist())]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").withColumn("component", F.lit("x")).repartition(4)
    got = whitening.whitened_components(df).collect()
    whole = {i: np.floor(256 * np.array(v + [0.0] * (9 - len(v)))).astype(int) for i, v in data if v and None not in v and np.isfinite(v).all()}
    fit = np.unique(np.array(list(whole.values())), axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:4], vectors[:, ::-1][:, :4]
    assert len(got) == 4 * len(whole) and {r["n"] for r in got} == {n}
    for r in got:
        v, c = whole[r["vec_id"]], r["component"] - 1
        assert r["deviation"] == int(((n * v - sums) ** 2).sum())
        assert abs(abs(r["whitened"]) - abs((v - sums / n) @ vectors[:, c]) / np.sqrt(values[c])) < 1e-9
        assert abs(r["explained"] * np.trace(centred.T @ centred / n) / values[c] - 1) < 1e-9
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9
    of = {(r["vec_id"], r["component"]): r["whitened"] for r in got}
    assert all(of[3, c] == of[1000, c] for c in range(1, 5))


def test_as_many_components_as_the_vectors_span(spark):
    make = lambda data: spark.createDataFrame(data, "vec_id long, embedding array<float>")
    assert whitening.whitened_components(make([])).collect() == []
    assert whitening.whitened_components(make([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    assert whitening.whitened_components(make([(1, [])])).collect() == []
    line = whitening.whitened_components(make([(i, [float(i), 2.0 * i, 1.0]) for i in range(5)])).collect()
    assert {r["component"] for r in line} == {1} and abs(line[0]["explained"] - 1) < 1e-9
    with pytest.raises(Exception, match="64 bits"):
        whitening.whitened_components(make([(1, [1e30]), (2, [0.0])])).collect()


def test_deviations_are_exact_beyond_double_precision():
    model = whitening.Whitening(1.0, 3, [7, -5], 1.0, np.zeros(0), np.zeros((0, 2)))
    x = np.array([[400_000_001, 3], [0, 0]])
    assert model.deviations(x).tolist() == [(3 * 400_000_001 - 7) ** 2 + 14**2, 49 + 25]
    with pytest.raises(OverflowError):
        model.deviations(np.array([[2**40, 0]]))
