"""Eigenvectors against numpy's, and whitened vectors against a plain computation."""

import math
from fractions import Fraction

import numpy as np
import pytest

from tidelog.llm import eigen, whitening


def spectra():
    rng = np.random.default_rng(4)
    turn = lambda d: np.linalg.qr(rng.normal(size=(d, d)))[0]
    with_values = lambda v: (lambda q: q * v @ q.T)(turn(len(v)))
    yield "one", np.array([[3.0]])
    yield "two", np.array([[2.0, 1.0], [1.0, 2.0]])
    yield "spread", with_values(10.0 ** -np.arange(12))
    yield "cluster", with_values(np.append(80 + 1e-7 * np.arange(9), [5, 4, 3]))
    yield "equal", with_values(np.append(np.full(7, 2.0), np.full(6, 1.0)))
    yield "identity", np.eye(20)
    yield "zero", np.zeros((6, 6))
    yield "blocks", np.kron(np.eye(5), np.array([[2.0, 1.0, 0.0], [1.0, 2.0, 1.0], [0.0, 1.0, 2.0]]))
    yield "large", (lambda m: m @ m.T)(rng.normal(size=(150, 150)))
    yield "scaled", with_values(np.arange(1, 31) * 1e150)
    yield "negative", with_values(np.arange(-10.0, 10.0))


@pytest.mark.parametrize("name,matrix", list(spectra()))
def test_leading_pairs(name, matrix):
    matrix = (matrix + matrix.T) / 2
    count = min(9, len(matrix))
    values, axes = eigen.leading(matrix, count)
    norm = max(np.abs(matrix).sum(axis=1).max(), 1e-300)
    want = np.linalg.eigvalsh(matrix)[::-1][:count]
    assert np.abs(values - want).max() <= 1e-13 * norm
    assert np.abs(axes.T @ axes - np.eye(count)).max() < 1e-12
    assert np.abs(matrix @ axes - axes * values).max() <= 2e-13 * norm


def test_householder_keeps_the_matrix():
    rng = np.random.default_rng(9)
    matrix = rng.normal(size=(30, 30))
    matrix += matrix.T
    diagonal, off, reflectors = eigen.tridiagonal(matrix)
    small = np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1)
    turn = np.eye(30)
    for v in reflectors.T:
        turn -= np.outer(2 * (turn @ v), v)
    assert np.abs(turn @ small @ turn.T - matrix).max() < 1e-12


def plain(vectors, k=16):
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors]
    fit = np.array(sorted(set(map(tuple, x))), object)
    n, s = len(fit), fit.sum(axis=0)
    centred = np.array([[float(Fraction(int(v) * n - int(t), n)) for v, t in zip(row, s)] for row in fit])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    deviation = [sum((n * a - int(b)) ** 2 for a, b in zip(row, s)) for row in x]
    y = np.array([[float(Fraction(a * n - int(b), n)) for a, b in zip(row, s)] for row in x])
    return n, deviation, y @ axes / np.sqrt(values), values / (centred**2).sum(axis=1).mean()


@pytest.mark.parametrize("dims", [3, 24])
def test_whitening(spark, dims):
    rng = np.random.default_rng(dims)
    data = [(i, [float(np.float32(v)) for v in rng.normal(size=dims) * np.linspace(1, 3, dims)]) for i in range(400)]
    data += [(1_000 + i, data[3][1]) for i in range(300)] + [(None, data[5][1]), (5, data[6][1])]
    bad = [(2_000, None), (2_001, [None] + [1.0] * (dims - 1)), (2_002, [float("nan")] * dims), (2_003, [float("inf")] * dims), (2_004, [])]
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in data + bad], "vec_id long, embedding array<float>, n int, x string")
    got = whitening.whiten(frame).drop("length").collect()
    n, deviation, white, explained = plain([v for _, v in data])
    width = min(dims, 16)
    assert len(got) == len(data) * width and {r["n"] for r in got} == {n}
    errors = {r["identity_error"] for r in got}
    assert len(errors) == 1 and errors.pop() < 1e-9
    signs = {}
    rows = {}
    for r in got:
        rows.setdefault((r["vec_id"], r["deviation"]), {}).setdefault(r["component"], []).append(r)
    for (i, _), dev, line in zip(data, deviation, white):
        for c in range(1, width + 1):
            mine = rows[i, dev][c][0]
            sign = signs.setdefault(c, np.sign(mine["whitened"]) * np.sign(line[c - 1]))
            assert abs(mine["whitened"] - sign * line[c - 1]) < 1e-7
            assert abs(mine["explained"] / explained[c - 1] - 1) < 1e-9


def test_whitening_cases(spark):
    kinds = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], kinds)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 3, kinds)).count() == 0
    flat = [(i, [float(i), 2.0 * i, 5.0]) for i in range(10)]
    got = whitening.whiten(spark.createDataFrame(flat + [(50 + i, [float(i % 3)]) for i in range(6)], kinds)).collect()
    # One direction only; vectors of another length are whitened by themselves.
    assert {(r["component"], r["length"], r["n"]) for r in got} == {(1, 3, 10), (1, 1, 3)} and len(got) == 16
    assert all(abs(r["explained"] - 1) < 1e-12 for r in got)
    huge = [(i, [(-1.0) ** i * 3e38, float(i)]) for i in range(8)]
    got = whitening.whiten(spark.createDataFrame(huge, kinds)).collect()
    assert {r["deviation"] for r in got} == {None} and {abs(round(r["whitened"], 6)) for r in got if r["component"] == 1} == {1.0}
