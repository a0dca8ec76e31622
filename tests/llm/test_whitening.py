from fractions import Fraction

import numpy as np
import pytest
from llm_cases import SF

from vigil.llm import whitening
from vigil.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, component int"


def plain(vectors, k=16):
    """Exact means and sums by fractions, components by an eigendecomposition of the exact covariance."""
    x = [[int(np.floor(64 * np.float64(np.float32(c)))) + 1_000_000 for c in v] for v in vectors]
    fit = sorted(set(map(tuple, x)))
    n, d = len(fit), len(fit[0])
    s = [sum(col) for col in zip(*fit, strict=True)]
    far = [sum((n * a - b) ** 2 for a, b in zip(row, s, strict=True)) for row in x]
    c = np.array([[float(Fraction(n * a - b, n)) for a, b in zip(row, s, strict=True)] for row in fit])
    e, v = np.linalg.eigh(c.T @ c / n)
    e, v = e[::-1], v[:, ::-1]
    keep = [i for i in range(d) if e[i] > 1e-11 * e[0]][:k]
    all_ = np.array([[float(Fraction(n * a - b, n)) for a, b in zip(row, s, strict=True)] for row in x])
    return n, far, all_ @ v[:, keep] / np.sqrt(e[keep]), e[keep] / e.sum()


def check(got, vectors, ids):
    n, far, w, explained = plain(vectors)
    k = w.shape[1]
    assert len(got) == len(ids) * k
    at = {}
    for r in got:
        at.setdefault((r.vec_id, r.component), []).append(r)
    for j in range(k):
        sign = None
        for i, vec_id in enumerate(ids):
            rows = at[vec_id, j + 1]
            r = min(rows, key=lambda r, i=i: abs(r.deviation - far[i]))
            assert r.n == n and r.deviation == far[i] and r.identity_error < 1e-9
            assert r.explained == pytest.approx(explained[j], rel=1e-5)
            assert abs(r.whitened) == pytest.approx(abs(w[i, j]), rel=1e-5, abs=1e-5)
            if abs(w[i, j]) > 1e-3 and len(rows) == 1:
                own = np.sign(r.whitened * w[i, j])
                assert sign in (None, own)
                sign = own


def test_query_against_exact_covariance(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    got = QUERIES["op11_embedding_whitening"](spark, SF)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(got.collect(), [r.embedding for r in rows], [r.vec_id for r in rows])


def test_directions_without_variance_and_of_very_different_size(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(300, 4)) * np.array([1e4, 100, 1, 0.2])
    v = np.concatenate([base, base[:, :1] + 0, np.full((300, 1), 3.25)], axis=1).astype(np.float32)
    rows = [(i, [float(c) for c in r], 0, 9) for i, r in enumerate(v)]
    got = whitening.whitened(spark.createDataFrame(rows, SCHEMA).repartition(7)).collect()
    assert {r.component for r in got} == {1, 2, 3, 4}
    check(got, v.tolist(), [r[0] for r in rows])


def test_odd_rows_copies_and_shared_ids(spark):
    rng = np.random.default_rng(2)
    good = [(i, rng.normal(size=3).tolist()) for i in range(40)]
    copies = [(100 + i, good[0][1]) for i in range(30)] + [(5, good[1][1])]
    odd = [(200, None), (201, [1.0, None, 2.0]), (202, [1.0, float("nan"), 2.0]), (203, [float("inf"), 0.0, 0.0]),
           (204, []), (205, [1.0, 2.0]), (206, [1e30, 0.0, 0.0])]
    frame = spark.createDataFrame([(i, v, 0, 1) for i, v in good + copies + odd], SCHEMA)
    got = whitening.whitened(frame).collect()
    assert {r.vec_id for r in got} == {i for i, _ in good + copies}
    check(got, [v for _, v in good + copies], [i for i, _ in good + copies])
    for rows in ([], [(1, None, 0, 1)], [(1, [1.0, 2.0], 0, 1)], [(1, [1.0], 0, 1), (2, [1.0], 0, 1)]):
        assert whitening.whitened(spark.createDataFrame(rows, SCHEMA)).count() == 0


def test_codes_and_exact_sums():
    x = np.array([[1_000_000, 999_990], [1_000_000 + 300, 5], [1_000_000 + (1 << 40), 0], [1_000_127, 999_872]])
    codes = whitening.encode(x)
    assert [c[0] for c in codes] == [2 - 1, 4, 8, 1] and (whitening.decode(codes, 2) == x).all()
    big = np.array([[1 << 45, 0], [0, 1 << 45], [7, 7]])
    c, far = whitening.centred(big, 3, [int(v) for v in big.sum(axis=0)])
    s = [int(v) for v in big.sum(axis=0)]
    assert far == [sum((3 * int(a) - b) ** 2 for a, b in zip(r, s, strict=True)) for r in big]
    assert np.allclose(c, big - big.mean(axis=0), rtol=1e-12)


def test_triangular_solve():
    rng = np.random.default_rng(3)
    r = np.triu(rng.normal(size=(6, 6))) + 4 * np.eye(6)
    a = rng.normal(size=(10, 6))
    assert np.allclose(whitening.solve(a, r) @ r, a)
