"""Whitening against exact arithmetic, top-k search against brute force."""

from __future__ import annotations

import math
from fractions import Fraction

import duckdb
import numpy as np
import pytest

from orderloom.llm import topk_search, whitening

SCHEMA = "vec_id long, embedding array<{}>, label int, id string, vector string, block int, score int"


def table(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, 0, "x", "y", 1, 2) for i, v in rows], SCHEMA.format(kind)).repartition(3)


def fine(v):
    return v is not None and None not in v and all(math.isfinite(x) for x in v)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(2)
    spread = np.linspace(0.4, 0.02, 12)
    vectors = (rng.normal(size=(150, 12)) * spread + 0.3).astype(np.float32).tolist()
    vectors += [vectors[0]] * 20
    odd = [None, [float("nan")] * 12, [None] * 12, [float("-inf")] + [0.0] * 11, [0.0] * 12]
    return [(10 * k, v) for k, v in enumerate([*odd, *vectors])] + [(10, vectors[3]), (None, vectors[4])]


# --- whitening ---------------------------------------------------------------------------------


def exact(rows):
    """Whole components, their sums and covariance by exact arithmetic."""
    x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v in rows if fine(v)]
    n, d = len(x), len(x[0])
    sums = [sum(v[k] for v in x) for k in range(d)]
    apart = [[Fraction(n * v[k] - sums[k], n) for k in range(d)] for v in x]
    return x, sums, np.array([[float(sum(a[i] * a[j] for a in apart) / n) for j in range(d)] for i in range(d)])


def test_whitening_equals_exact_arithmetic(spark, rows):
    x, sums, covariance = exact(rows)
    n, values, vectors = len(x), *np.linalg.eigh(covariance)
    result = whitening.whiten(table(spark, rows)).toPandas()
    assert len(result) == 8 * n and (result["n"] == n).all()
    assert result["identity_error"].nunique() == 1 and result["identity_error"][0] < 1e-10
    ids = [i for i, v in rows if fine(v)]
    deviation = {i: sum((n * c - s) ** 2 for c, s in zip(v, sums)) for i, v in zip(ids, x) if i != 10}
    for i, value in zip(result["vec_id"], result["deviation"]):
        assert i == 10 or math.isnan(i) or value == deviation[i]
    centred = np.array(x, float) - np.array([s / n for s in sums])
    for component in range(1, 9):
        part = result[result["component"] == component]
        value, vector = values[-component], vectors[:, -component]
        assert np.allclose(part["explained"], value / np.trace(covariance), rtol=1e-10)
        whitened = centred @ vector / math.sqrt(value)
        expected = {i: w for i, w in zip(ids, whitened)}
        apart = [(w, expected[i]) for i, w in zip(part["vec_id"], part["whitened"]) if not math.isnan(i) and i != 10]
        sign = np.sign(apart[0][0] * apart[0][1])
        assert all(abs(a - sign * b) < 1e-9 for a, b in apart)


def test_whitening_of_odd_tables(spark):
    assert whitening.whiten(table(spark, [])).count() == 0
    assert whitening.whiten(table(spark, [(1, None), (2, []), (3, [None])])).count() == 0
    one = whitening.whiten(table(spark, [(1, [0.5, 1.0])])).collect()
    assert [(r["component"], r["n"], r["deviation"], r["whitened"], r["explained"]) for r in one] == [(1, 1, 0, None, None), (2, 1, 0, None, None)]
    apart = whitening.whiten(table(spark, [(1, [1.0]), (2, [2.0]), (3, [1.0, 1.0]), (4, [3.0, 3.0])])).collect()
    assert {(r["vec_id"], r["component"], r["n"]) for r in apart} == {(1, 1, 2), (2, 1, 2), (3, 1, 2), (3, 2, 2), (4, 1, 2), (4, 2, 2)}
    assert all((r["whitened"] is None) == (r["component"] == 2) for r in apart)
    huge = whitening.whiten(table(spark, [(1, [1e300]), (2, [0.0]), (3, [-1e300])], "double")).collect()
    assert [r["deviation"] for r in sorted(huge, key=lambda r: r["vec_id"])] == [None, 0, None]
    assert abs(huge[0]["identity_error"]) < 1e-12


def test_deviation_is_exact_to_the_end_of_a_long():
    model = whitening.Whitener(3, np.zeros(2, np.int64), [0, 0], np.zeros((0, 2)), np.zeros(0))
    edge = math.isqrt(2**63 // 9)
    x = np.array([[edge, 0], [edge, 5000], [edge + 1, 0], [2**40, 0], [7, -3]])
    expected = [9 * (a * a + b * b) for a, b in x.tolist()]
    assert model.deviations(x) == [v if v < 2**63 else None for v in expected]


@pytest.mark.parametrize("dimension", [1, 2, 9, 40])
def test_spectrum_slices_equal_eigenvalues(dimension):
    rng = np.random.default_rng(dimension)
    for values in (rng.random(dimension), rng.integers(0, 3, dimension) + 0.1, 1.01 + 1e-13 * rng.random(dimension), np.zeros(dimension)):
        turn, _ = np.linalg.qr(rng.normal(size=(dimension, dimension)))
        matrix = turn @ np.diag(values) @ turn.T
        matrix = (matrix + matrix.T) / 2
        for shift in (-0.5, 0.3, 0.7, 1.5):  # none of the values but by chance
            assert whitening.above(matrix, shift) == (values > shift).sum()
        found, vectors = whitening.leading(matrix, 8)
        assert np.allclose(found, np.sort(values)[::-1][:8], atol=1e-12)
        assert np.allclose(vectors @ vectors.T, np.eye(len(vectors)), atol=1e-12)
        assert np.allclose(matrix @ vectors.T, vectors.T * found, atol=1e-11)


def test_products_are_exact():
    z = np.random.default_rng(1).integers(-(2**53), 2**53, size=(40, 3))
    columns = [[int(a) for a in z[:, k]] for k in range(3)]
    assert whitening.products(z).tolist() == [[sum(a * b for a, b in zip(p, q)) for q in columns] for p in columns]


# --- search ------------------------------------------------------------------------------------


def brute(rows, k=5):
    whole = [(i, [math.floor(256 * c) for c in v]) for i, v in rows if i is not None and fine(v)]
    out = []
    for query, q in whole:
        if query % 50 == 0:
            scored = [(-sum(a * b for a, b in zip(q, v)), i) for i, v in whole if i != query and len(v) == len(q)]
            out += [(query, rank, i, -score) for rank, (score, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def search(spark, rows, kind="float", **options):
    vectors = table(spark, rows, kind)
    result = topk_search.search(vectors, vectors.filter("vec_id % 50 = 0"), **options)
    assert result.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(tuple(r) for r in result.collect())


@pytest.mark.parametrize("block", [256, 6])
def test_search_equals_brute_force(spark, rows, block, monkeypatch):
    for name in ("BLOCK", "CHUNK", "PACK"):
        monkeypatch.setattr(topk_search, name, block)
    monkeypatch.setattr(topk_search, "BUFFER", 4 * block)
    assert search(spark, rows, rounds=(1, 3), sample=64) == brute(rows)


def test_search_of_odd_tables(spark):
    assert search(spark, []) == [] and search(spark, [(50, [1.0])]) == []
    rows = [(0, []), (50, []), (100, [1.0]), (150, [-2.0]), (3, [1.5]), (4, [1.0, 1.0]), (5, None), (6, [1.5]), (-50, [0.1])]
    assert search(spark, rows) == brute(rows)
    equal = [(k, [0.25, 0.5]) for k in range(40, 120)] + [(50, [0.25, 0.5])] * 2
    assert search(spark, equal) == brute(equal)
    huge = [(0, [1e300, 1.0]), (1, [1e12, 1.0]), (2, [-1e12, 3.0]), (50, [1e7, 2.0])]
    found = search(spark, huge, "double")
    assert (0, 1, 1, 2**63 - 1) in found and (0, 3, 2, -(2**63)) in found
    large = [(0, [1e6, 1.0]), (1, [1e6, 3.0]), (2, [-1e6, 2.0]), (50, [1e5, 2.0])]
    assert search(spark, large, "double") == brute(large)


def test_bounds_are_never_below_a_score():
    rng = np.random.default_rng(5)
    for size in (2**8, 2**40, 2**53):
        q, x = (rng.integers(-size, size, size=(9, 7)) for _ in range(2))
        bound = topk_search.bounds(q, x.max(0)[None], x.min(0)[None])[:, 0]
        best = [max(sum(int(a) * int(b) for a, b in zip(one, row)) for row in x) for one in q]
        assert all(b >= s for b, s in zip(bound, best))


def test_search_sql_equals_brute_force(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", rows)
    result = con.execute(topk_search.ORACLE_SQL)
    assert sorted(result.fetchall()) == brute(rows)
