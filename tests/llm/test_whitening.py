"""Whitening against a dense eigendecomposition, and on odd vectors."""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from stratalake.llm import whitening
from stratalake.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>"


def expected(vectors: list[list[float]], scale: int = 256) -> tuple:
    """Whole vectors, sums of the distinct ones, their eigenvalues and eigenvectors."""
    whole = np.array([[math.floor(scale * c) for c in v] for v in vectors], np.int64)
    distinct = np.unique(whole, axis=0)
    apart = distinct - distinct.mean(axis=0)
    values, turn = np.linalg.eigh(apart.T @ apart / len(distinct))
    return whole, distinct, values[::-1], turn[:, ::-1]


def by_id(rows) -> dict:
    found = defaultdict(dict)
    for row in rows:
        found[row.vec_id][row.component] = row
    return found


def test_whole_table(spark):
    table = pq.read_table(f"{SF_DIR}/embeddings.parquet").to_pydict()
    whole, distinct, values, turn = expected(table["embedding"])
    rows = QUERIES["op11_embedding_whitening"](spark, SF_DIR).collect()
    assert len(rows) == 4 * len(whole)
    found, n, sums = by_id(rows), len(distinct), distinct.sum(axis=0).tolist()
    scores = (whole - distinct.mean(axis=0)) @ turn[:, :4] / np.sqrt(values[:4])
    ours = np.array([[found[i][k].whitened for k in range(1, 5)] for i in table["vec_id"]])
    sign = np.sign((ours * scores).sum(axis=0))
    assert np.abs(ours * sign - scores).max() < 1e-9
    for i, point in zip(table["vec_id"], whole.tolist()):
        for k in range(1, 5):
            row = found[i][k]
            assert (row.n, row.deviation) == (n, sum((n * x - s) ** 2 for x, s in zip(point, sums)))
            assert row.explained == pytest.approx(values[k - 1] / values.sum(), rel=1e-9)
            assert row.identity_error < 1e-9


@pytest.mark.parametrize("spectrum", [
    0.9 ** np.arange(120.0) * 50, np.concatenate([[1e6], np.linspace(1, 0.5, 119)]),
    np.concatenate([[5.0, 4, 3], np.zeros(117)]), np.ones(120), 1 / np.arange(1.0, 121)])
def test_subspace_finds_the_leading_pairs(spectrum):
    turn = np.linalg.qr(np.random.default_rng(5).standard_normal((120, 120)))[0]
    matrix = (turn * spectrum) @ turn.T
    vectors, values, residuals, passes = whitening.subspace(lambda q: matrix @ q, 120)
    assert values == pytest.approx(np.sort(spectrum)[::-1][:4], rel=1e-8, abs=1e-8 * spectrum[0])
    assert (residuals <= 1e-8 * np.maximum(values, 1e-6 * spectrum[0])).all()
    assert np.abs(vectors.T @ vectors - np.eye(4)).max() < 1e-12 and passes < 400


def test_the_filter_damps_what_lies_below_the_cut():
    matrix, calls = np.diag([10.0, 9, 8, 7, 2, 1.5, 1, 0.5]), []
    block = np.eye(8)

    def apply(q):
        calls.append(1)
        return matrix @ q

    left = np.abs(np.diag(whitening._filtered(apply, block, matrix @ block, 2.0, 10.0)))
    assert left[:4].min() > 1e3 * left[4:].max() and len(calls) < whitening.MAX_DEGREE


def test_odd_vectors(spark):
    good = [(k, [float(k % 5), float(k * k % 7), float(k % 3)]) for k in range(30)]
    odd = [(40, None), (41, [1.0, None, 2.0]), (42, [1.0, math.nan, 2.0]), (43, [math.inf, 0.0, 0.0])]
    extra = [(None, [1.0, 1.0, 1.0]), (3, good[3][1]), (3, good[3][1]), (50, [2.0])]
    frame = spark.createDataFrame(good + odd + extra, SCHEMA).withColumns(
        {name: F.lit("clash") for name in ("id", "x", "n", "component", "points", "cell")})
    rows = whitening.whitened(frame).collect()
    vectors = [v for _, v in good] + [[1.0, 1, 1], good[3][1], good[3][1], [2.0, 0, 0]]
    whole, distinct, values, turn = expected(vectors)
    assert len(rows) == 3 * len(vectors) and {r.n for r in rows} == {len(distinct)}
    assert sorted({r.vec_id for r in rows if r.vec_id is not None}) == [*range(30), 50]
    assert [r.explained for r in rows[:3]] == pytest.approx((values / values.sum()).tolist())


def test_no_variance_and_no_rows(spark):
    same = spark.createDataFrame([(k, [1.0, 2.0]) for k in range(3)], SCHEMA)
    assert whitening.whitened(same).count() == 0
    empty = whitening.whitened(same.limit(0))
    assert empty.count() == 0 and empty.columns == [
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert whitening.whitened(spark.createDataFrame([(1, [])], SCHEMA)).count() == 0


def test_huge_entries(spark):
    frame = spark.createDataFrame(
        [(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [0.0, 5.0]), (4, [1e12, 7.0])], SCHEMA)
    rows = whitening.whitened(frame).collect()
    assert len(rows) >= 4 and all(r.deviation is None for r in rows if r.vec_id in (1, 2))
    assert all(math.isfinite(r.whitened) for r in rows)
