"""Contour integration against a dense eigensolver, and whitening against numpy."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from feedpulse.llm.whitening import count_below, leading_components, op13_whitening, whiten

VECTORS = "vec_id long, embedding array<float>, component int, n long, x long"


def plain(rows, components=16):
    """``{(vec_id, component): (n, deviation, |whitened|, explained)}`` by numpy's solver."""
    kept = [
        (i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v])
        for i, v in rows
        if v and all(c is not None and math.isfinite(c) for c in v)
    ]
    fit = sorted({tuple(x) for _, x in kept})
    n = len(fit)
    if n < 2:
        return {}
    sums = [sum(column) for column in zip(*fit)]
    off = np.array([[n * a - s for a, s in zip(x, sums)] for x in fit], float) / n
    values, vectors = np.linalg.eigh(off.T @ off / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = {}
    for i, x in kept:
        exact = [n * a - s for a, s in zip(x, sums)]
        white = np.array(exact, float) / n @ vectors
        for k in range(min(components, len(values))):
            if values[k] > values.sum() * 1e-12:
                out.setdefault((i, k + 1), []).append(
                    (
                        n,
                        sum(a * a for a in exact),
                        abs(white[k]) / math.sqrt(values[k]),
                        values[k] / values.sum(),
                    )
                )
    return out


def check(got, expected):
    found = {}
    for r in got:
        found.setdefault((r["vec_id"], r["component"]), []).append(
            (r["n"], r["deviation"], abs(r["whitened"]), r["explained"])
        )
        assert r["identity_error"] <= 1e-8
    assert found.keys() == expected.keys()
    for key, rows in expected.items():
        assert len(rows) == len(found[key])
        for a, b in zip(sorted(found[key]), sorted(rows)):
            assert a[:2] == b[:2]
            assert a[2:] == pytest.approx(b[2:], rel=1e-6, abs=1e-6)


def test_edges(make):
    rng = np.random.default_rng(3)
    rows = [(k, [float(c) for c in rng.standard_normal(5)]) for k in range(40)]
    rows += [(k, rows[0][1]) for k in range(100, 130)]  # copies count once
    rows += [(7, rows[3][1]), (None, rows[4][1])]
    bad = [
        (201, None),
        (202, []),
        (203, [1.0, None, 0.0, 0.0, 0.0]),
        (204, [1.0, float("nan"), 0.0, 0.0, 0.0]),
        (205, [1.0, float("-inf"), 0.0, 0.0, 0.0]),
    ]
    check(whiten(make(rows + bad, VECTORS)).collect(), plain(rows))


def test_directions_without_variance(make):
    """Three dimensions of which two vary: two components."""
    rows = [(k, [float(k), float(k * k % 7), 2.0]) for k in range(20)]
    got = whiten(make(rows, VECTORS)).collect()
    assert {r["component"] for r in got} == {1, 2}
    check(got, plain(rows))


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.5, 0.5])], [(1, [0.5]), (2, [0.5])]])
def test_nothing_varies(make, rows):
    assert whiten(make(rows, VECTORS)).collect() == []


def test_vectors_of_several_lengths(make):
    with pytest.raises(ValueError, match="vectors of 1 to 2 entries"):
        whiten(make([(1, [1.0]), (2, [1.0, 2.0])], VECTORS))


def test_whole_table(spark, small):
    import pyarrow.parquet as pq

    table = pq.read_table(f"{small}/embeddings.parquet").to_pylist()
    rows = [(r["vec_id"], r["embedding"]) for r in table]
    got = op13_whitening(spark, small)
    assert got.columns == [
        "vec_id",
        "component",
        "n",
        "deviation",
        "whitened",
        "explained",
        "identity_error",
    ]
    check(got.collect(), plain(rows))


def test_repeated_eigenvalues():
    """The space of equal eigenvalues is found whole, whatever basis it is given in."""
    turn, _ = np.linalg.qr(np.random.default_rng(5).standard_normal((30, 30)))
    own = np.array([5.0] * 9 + [4.999] * 3 + [2.0] * 10 + [0.0] * 8)
    values, vectors = leading_components(turn * own @ turn.T, 16)
    assert values == pytest.approx([5.0] * 9 + [4.999] * 3 + [2.0] * 4)
    top = turn[:, :9]
    assert vectors[:, :9] @ vectors[:, :9].T == pytest.approx(top @ top.T, abs=1e-9)
    assert vectors.T @ vectors == pytest.approx(np.eye(16), abs=1e-11)


@settings(max_examples=60, deadline=None)
@given(n=st.integers(1, 40), spread=st.floats(0.1, 4), seed=st.integers(0, 10_000))
def test_against_a_dense_solver(n, spread, seed):
    rng = np.random.default_rng(seed)
    factor = rng.standard_normal((n, n)) * np.exp(spread * rng.standard_normal(n))
    matrix = factor @ factor.T
    values, vectors = leading_components(matrix, 16)
    own = np.linalg.eigvalsh(matrix)[::-1][: len(values)]
    scale = own[0]
    assert np.abs(values - own).max() <= 1e-12 * scale
    assert np.abs(matrix @ vectors - vectors * values).max() <= 1e-12 * scale * n
    shift = float(own.mean()) * 1.01
    assert count_below(matrix, shift) == int((np.linalg.eigvalsh(matrix) < shift).sum())
