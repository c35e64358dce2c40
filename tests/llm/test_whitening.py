"""Whitening, against a dense solution of the same covariance."""

import math
from fractions import Fraction

import numpy as np
import pytest

from tidewatch.llm import whitening
from tidewatch.llm.common import table

SHAPE = "vec_id long, embedding array<double>"


def _plain(rows, most=whitening.COMPONENTS):
    """n, exact deviations by vec_id, projections by vec_id, shares and eigenvalues."""
    usable = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max(len(v) for _, v in usable)
    levels = [(i, [math.floor(64 * c) + 1_000_000 for c in v] + [1_000_000] * (width - len(v))) for i, v in usable]
    fitted = sorted({tuple(x) for _, x in levels})
    n, sums = len(fitted), [sum(column) for column in zip(*fitted)]
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(x, sums)] for x in fitted])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    whole = (centred ** 2).sum() / n
    result = []
    for i, x in levels:
        own = np.array([float(Fraction(n * a - s, n)) for a, s in zip(x, sums)])
        result.append((i, sum((n * a - s) ** 2 for a, s in zip(x, sums)), own @ vectors / np.sqrt(np.maximum(values, 1e-300))))
    return n, result, values / whole, values


def _held(got, rows):
    n, wanted, shares, values = _plain(rows)
    k = len(shares)
    assert len(got) == len(wanted) * k
    by_row = {}
    for r in got:
        by_row.setdefault(r["vec_id"], []).append(r)
    signs = {}
    for i, deviation, white in wanted:
        own = sorted(by_row[i], key=lambda r: r["component"])
        assert {r["n"] for r in own} == {n} and {r["deviation"] for r in own} == {deviation}
        for place in range(k):
            r = own[place * (len(own) // k)]
            assert r["component"] == place + 1
            assert r["explained"] == pytest.approx(shares[place], rel=1e-9)
            sign = signs.setdefault(place, 1 if r["whitened"] * white[place] >= 0 else -1)
            assert r["whitened"] * sign == pytest.approx(white[place], abs=1e-7)
    assert all(r["identity_error"] < 1e-10 for r in got)


def test_given_vectors(spark):
    frame = table(spark, "/root/testdata/sf0.001", "embeddings")
    _held(whitening.whiten(frame).collect(), [tuple(r)[:2] for r in frame.collect()])


def test_copies_count_once_and_awkward_rows_have_defined_results(spark):
    draw = np.random.default_rng(4)
    rows = [(i, [float(c) for c in draw.normal(size=5) * [9, 5, 3, 2, 1]]) for i in range(60)]
    copies = [(100 + i, list(rows[0][1])) for i in range(40)]
    rest = [(200, None), (201, [1.0, None, 0.0, 0.0, 0.0]), (202, [math.nan] * 5), (203, [math.inf, 0.0, 0.0, 0.0, 0.0]),
            (204, [1.0, 2.0]), (205, []), (None, [0.5] * 5), (206, [-0.0] * 5)]
    frame = spark.createDataFrame(rows + copies + rest + rows[:1], SHAPE).selectExpr("*", "1 AS component", "2 AS n")
    got = whitening.whiten(frame)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    _held(got.collect(), rows + copies + rest + rows[:1])


def test_no_variance_and_no_rows(spark):
    same = spark.createDataFrame([(1, [2.0, 3.0]), (2, [2.0, 3.0]), (2, [2.0, 3.0])], SHAPE)
    got = whitening.whiten(same).collect()
    assert len(got) == 6
    assert {(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in got} == {(1, 0, None, 0, 0)}
    flat = whitening.whiten(spark.createDataFrame([(1, [2.0, 3.0]), (2, [4.0, 3.0])], SHAPE)).collect()
    assert {(r["component"], r["whitened"] is None, r["explained"]) for r in flat} == {(1, False, 1.0), (2, True, 0.0)}
    assert whitening.whiten(same.limit(0)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None), (2, [])], SHAPE)).count() == 0


def test_sums_beyond_a_long(spark):
    rows = [(i, [1e300 if i % 2 else -1e300, float(i)]) for i in range(4)]
    got = whitening.whiten(spark.createDataFrame(rows, SHAPE)).collect()
    assert {r["deviation"] for r in got} == {None}
    large = [(i, [float(i) * 9e4, 1.0]) for i in range(30)]
    _, wanted, _, _ = _plain(large)
    got = whitening.whiten(spark.createDataFrame(large, SHAPE)).collect()
    assert {(r["vec_id"], r["deviation"]) for r in got} == {(i, d) for i, d, _ in wanted}


@pytest.mark.parametrize("shape", [(400, 90), (30, 90), (400, 3), (2_000, 21)])
def test_pairs_equal_a_dense_solution(shape):
    draw = np.random.default_rng(7)
    rows = draw.normal(size=shape) * np.linspace(3, 1, shape[1])
    matrix = np.cov(rows.T, bias=True)
    values, vectors = whitening.leading_pairs(lambda p: matrix @ p, shape[1], min(16, shape[1]))
    wanted = np.linalg.eigvalsh(matrix)[::-1][:len(values)]
    assert np.abs(values - wanted).max() < 1e-13 * wanted[0]
    assert np.linalg.norm(matrix @ vectors - vectors * values, axis=0).max() < 1e-12 * wanted[0]
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-13


def test_minres_solves_shifted_systems():
    draw = np.random.default_rng(8)
    half = draw.normal(size=(30, 30))
    matrix, shifts = half + half.T, np.array([0.3, -1.0, 2.5])
    right = draw.normal(size=(30, 3))
    solved = whitening.minres(lambda p: matrix @ p - p * shifts, right, 60, enough=1e-12)
    assert np.abs(matrix @ solved - solved * shifts - right).max() < 1e-8


def test_small_parts_add_up(spark, monkeypatch):
    """Blocks of a few rows and few tasks give the same components."""
    frame = table(spark, "/root/testdata/sf0.001", "embeddings").limit(200)
    wanted = {(r["vec_id"], r["component"]): abs(r["whitened"]) for r in whitening.whiten(frame).collect()}
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 7)
    got = whitening.whiten(frame.repartition(9)).collect()
    assert all(abs(r["whitened"]) == pytest.approx(wanted[r["vec_id"], r["component"]], abs=1e-8) for r in got)
    assert len(got) == len(wanted)
