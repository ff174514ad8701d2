"""Whitening against NumPy's eigenvectors and Python's integers."""

from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry
from conftest import SF_SMALL
from ridgeway.llm import whitening


def brute(vectors, k=4, scale=256):
    """(n, S, V, eigenvalues, components) of the distinct integer vectors."""
    x = sorted({tuple(int(np.floor(scale * float(c))) for c in v) for v in vectors})
    n, d = len(x), len(x[0])
    s = [sum(v[i] for v in x) for i in range(d)]
    centred = np.array([[float(Fraction(n * v[i] - s[i], n)) for i in range(d)] for v in x])
    v = centred.T @ centred / n
    e, u = np.linalg.eigh(v)
    return n, s, v, e[::-1][:k], u[:, ::-1][:, :k]


def check(rows, ids_and_vectors, k=4):
    n, s, v, e, u = brute([x for _, x in ids_and_vectors], k)
    assert len(rows) == k * len(ids_and_vectors)
    by = {}
    for r in rows:
        by.setdefault(r.vec_id, []).append(r)
    signs = None
    for i, vec in ids_and_vectors:
        x = [int(np.floor(256 * float(c))) for c in vec]
        own = sorted(by[i], key=lambda r: r.component)
        assert [r.component for r in own] == list(range(1, k + 1))
        assert {r.n for r in own} == {n} and {r.deviation for r in own} == {sum((n * a - b) ** 2 for a, b in zip(x, s))}
        want = np.array([float(Fraction(n * a - b, n)) for a, b in zip(x, s)]) @ u / np.sqrt(e)
        got = np.array([r.whitened for r in own])
        if signs is None and np.abs(got).min() > 1e-3:
            signs = np.sign(got) * np.sign(want)
        if signs is not None:
            np.testing.assert_allclose(got, signs * want, atol=1e-8)
        np.testing.assert_allclose([r.explained for r in own], e / np.trace(v), rtol=1e-9)
        assert {r.identity_error for r in own} == {own[0].identity_error} and own[0].identity_error < 1e-10


def test_query_whole_table(spark):
    rows = entry.queries()["op13_embedding_whitening"](spark, SF_SMALL).collect()
    table = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()
    check(rows, [(r.vec_id, r.embedding) for r in table])


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 9), st.integers(1, 12), st.integers(0, 2**31), st.sampled_from([0, 3, 8]))
def test_factor_and_rotations(d, n, seed, grade):
    rng = np.random.default_rng(seed)
    b = rng.standard_normal((d, n)) * 10.0 ** -(grade * np.arange(d) / max(1, d - 1))[:, None]
    a = b @ b.T
    g = whitening.pivoted_cholesky(a)
    assert g.shape[1] <= min(d, n)
    np.testing.assert_allclose(g @ g.T, a, atol=1e-12 * np.abs(a).max())
    t = whitening.one_sided_jacobi(g)
    np.testing.assert_allclose(t @ t.T, a, atol=1e-12 * np.abs(a).max())
    gram = t.T @ t
    norm = np.sqrt(np.diag(gram))
    assert np.all(np.diff(norm) <= 0)
    assert np.abs(gram / np.outer(norm, norm) - np.eye(len(norm))).max(initial=0) < 1e-13
    np.testing.assert_allclose(norm[:1] ** 2, np.linalg.eigvalsh(a)[::-1][: min(1, len(norm))], rtol=1e-12)


def test_small_eigenvalues_keep_their_digits():
    """A graded matrix: forming and diagonalising it loses what the factor keeps."""
    scale = 10.0 ** -np.arange(0, 28, 4.0)
    q = np.linalg.qr(np.random.default_rng(0).standard_normal((7, 7)))[0]
    a = scale[:, None] * (q @ np.diag(np.arange(1.0, 8)) @ q.T) * scale
    t = whitening.one_sided_jacobi(whitening.pivoted_cholesky(a))
    assert t.shape[1] == 7
    # products of the leading eigenvalues are, in such a matrix, the leading minors
    minors = [np.linalg.det(a[:k, :k] / np.outer(scale[:k], scale[:k])) * np.prod(scale[:k]) ** 2 for k in range(1, 7)]
    np.testing.assert_allclose(np.cumprod((t * t).sum(0))[:6], minors, rtol=1e-6)


def test_far_from_the_origin(spark):
    """A common offset of millions leaves the components of the small differences intact."""
    rng = np.random.default_rng(5)
    x = rng.integers(-9, 9, (60, 5)) * [1, 2, 3, 5, 8] / 256.0
    vectors = [(i, [float(c) for c in v + 3.0e6]) for i, v in enumerate(x)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    check(whitening.whiten(df, whitening.fit(df)).collect(), vectors)


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(1)
    good = [(i, [float(c) for c in rng.standard_normal(6)]) for i in range(20)]
    good += [(100 + i, good[0][1]) for i in range(40)]  # copies count once
    bad = [(200, None), (201, [1.0] * 5 + [None]), (202, [nan] + [0.0] * 5), (203, [inf] * 6), (204, [-inf] + [0.0] * 5), (205, [1.0, 2.0]), (206, [])]
    df = spark.createDataFrame(good + bad, "vec_id long, embedding array<double>").selectExpr("*", "1 AS component", "2 AS x", "3 AS n")
    got = whitening.whiten(df, whitening.fit(df)).collect()
    check(got, good)
    nobody = df.limit(0)
    assert whitening.fit(nobody) is None and whitening.whiten(nobody, None).collect() == []
    same = spark.createDataFrame([(1, [1.0, 2.0])] * 5, "vec_id long, embedding array<float>")
    assert whitening.whiten(same, whitening.fit(same)).collect() == []  # no spread, no component
    line = spark.createDataFrame([(None, [0.0, 0.0]), (2, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [2.0, 4.0])], "vec_id long, embedding array<double>")
    got = whitening.whiten(line, whitening.fit(line)).collect()
    assert sorted((r.vec_id is None, r.vec_id or 0, r.component, r.n) for r in got) == [(False, 2, 1, 3), (False, 2, 1, 3), (False, 3, 1, 3), (True, 0, 1, 3)]
    assert got[0].explained == pytest.approx(1.0) and sum(r.whitened for r in {r.vec_id: r for r in got}.values()) == pytest.approx(0, abs=1e-12)


def test_deviation_beyond_64_bits_in_between(spark):
    """Sums of squares are exact integers however large; what passes 63 bits is null."""
    vectors = [(1, [1.0e6, 0.0]), (2, [-1.0e6, 1.0]), (3, [0.0, 5.0]), (4, [1.0e12, 1.0])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    got = {r.vec_id: r.deviation for r in whitening.whiten(df, whitening.fit(df)).where("component = 1").collect()}
    x = {i: [int(np.floor(256 * c)) for c in v] for i, v in vectors}
    s = [sum(v[j] for v in x.values()) for j in range(2)]
    want = {i: sum((4 * v[j] - s[j]) ** 2 for j in range(2)) for i, v in x.items()}
    assert got == {i: w if w < 1 << 63 else None for i, w in want.items()}
    m = whitening.Whitening(3, [10**14, -5], np.eye(2)[:, :1], np.ones(1), 1.0)
    exact, _ = m.centred(np.array([[10**13, 7]]))
    assert [int(v) for v in exact[0]] == [3 * 10**13 - 10**14, 26]


def test_large_copies_group_and_many_partitions(spark):
    rng = np.random.default_rng(2)
    base = [[float(c) for c in rng.standard_normal(5)] for _ in range(30)]
    rows = [(i, base[i % 30] if i % 3 else base[0]) for i in range(900)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(17)
    check(whitening.whiten(df, whitening.fit(df)).collect(), rows)
