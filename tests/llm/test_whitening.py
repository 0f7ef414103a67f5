"""Whitening against sums in Python's own integers."""

import math

import numpy as np
import pytest

from smoothway.llm import queries, whitening


def plain(vectors):
    """Exact n, S, deviations; covariance by fractions of integers; whitened by numpy from it."""
    x = [[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    total = [sum(row[i] for row in x) for i in range(d)]
    away = [[n * row[i] - total[i] for i in range(d)] for row in x]
    v = np.array([[sum(a[i] * a[j] for a in away) / n**3 for j in range(d)] for i in range(d)])
    e, q = np.linalg.eigh(v)
    return n, [sum(c * c for c in a) for a in away], np.array([[c / n for c in a] for a in away]), e[::-1], q[:, ::-1], np.trace(v)


def _agree(found, keys, vectors, components):
    n, far, away, e, q, trace = plain(vectors)
    rows = {(r["vec_id"], r["component"]): r for r in found}
    assert len(rows) == len(found) == n * components
    for c in range(components):
        z = away @ q[:, c] / math.sqrt(e[c])
        got = np.array([rows[k, c + 1]["whitened"] for k in keys])
        sign = np.sign(got @ z)
        assert np.allclose(got, sign * z, rtol=1e-7, atol=1e-9)
        for k, f in zip(keys, far, strict=True):
            r = rows[k, c + 1]
            assert (r["n"], int(r["deviation"])) == (n, f)
            assert r["explained"] == pytest.approx(e[c] / trace, rel=1e-9)
            assert r["identity_error"] < 1e-9


def test_query_against_plain_integers(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    _agree(queries.op11_whitening(spark, sf_dir).collect(), [r["vec_id"] for r in rows], [r["embedding"] for r in rows], 8)


@pytest.mark.parametrize("size", [1.0, 1e4, 1e12, 1e30])
def test_sums_are_exact_at_any_size(spark, size):
    rng = np.random.default_rng(3)
    vectors = (rng.normal(size=(40, 5)) * [9, 5, 3, 2, 1] * size + size).tolist()
    rows = spark.createDataFrame(list(enumerate(vectors)), "vec_id int, embedding array<double>").repartition(3)
    x = [[math.floor(1024 * c) + 100_000 for c in v] for v in vectors]
    shift = [int(c) for c in x[0]]
    told = whitening.scatter(rows, "embedding", 5, shift)
    total = [sum(c) for c in zip(*x, strict=True)]
    assert [s + 40 * a for s, a in zip(told.total, shift, strict=True)] == total
    assert told.centred().tolist() == [[40 * sum(r[i] * r[j] for r in x) - total[i] * total[j] for j in range(5)] for i in range(5)]
    if size < 1e12:
        _agree(whitening.whiten(rows).collect(), range(40), vectors, 5)
    else:  # deviations beyond 38 digits are null
        assert {r["deviation"] is None for r in whitening.whiten(rows).collect()} == {size > 1e12}


@pytest.mark.parametrize("most", [1, 2**20, 2**29, 2**40])
def test_products_never_round(most):
    x = np.random.default_rng(1).integers(-most, most + 1, size=(50, 3))
    assert whitening.products(x).tolist() == [[sum(int(r[i]) * int(r[j]) for r in x) for j in range(3)] for i in range(3)]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, []), (4, [None, 1.0]), (5, [nan, 1.0]), (6, [inf, 0.0]), (7, [-inf, 0.0]), (8, [1.0, 2.0, 3.0]), (None, [3.0, 2.5]), (9, [0.5, -1.0])]
    table = spark.createDataFrame([(k, v, 1) for k, v in rows], "vec_id long, embedding array<float>, component int")
    found = whitening.whiten(table).collect()
    assert sorted((r["vec_id"] or 0, r["component"]) for r in found) == [(0, 1), (0, 2), (1, 1), (1, 1), (1, 2), (1, 2), (9, 1), (9, 2)]
    assert {r["n"] for r in found} == {4}
    assert len({(r["component"], r["whitened"]) for r in found if r["vec_id"] == 1}) == 2
    for nothing in (table.limit(0), table.filter("vec_id in (2, 3)"), table.filter("vec_id = 1")):
        assert whitening.whiten(nothing).collect() == []  # copies of one vector don't vary


def test_dimensions_that_do_not_vary_add_no_component(spark):
    table = spark.createDataFrame([(k, [float(k), 7.0, float(k * k)]) for k in range(30)], "vec_id long, embedding array<double>")
    assert {r["component"] for r in whitening.whiten(table).collect()} == {1, 2}
