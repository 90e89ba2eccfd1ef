import numpy as np
import pytest

from quarry.llm import whitening as wh


def brute(vectors, top):
    """Eigenvalues and projections from the covariance itself."""
    x = np.floor(1024 * np.asarray(vectors, np.float32).astype(np.float64)) + 100000
    c = x - x.mean(axis=0)
    values, vecs = np.linalg.eigh(c.T @ c / len(x))
    values, vecs = values[::-1][:top], vecs[:, ::-1][:, :top]
    return x.astype(np.int64), values, np.trace(c.T @ c / len(x)), (c @ vecs) / np.sqrt(values)


def rows_of(spark, data, **kw):
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    return wh.whiten(df, **kw).collect()


def test_equals_the_eigenvectors_of_the_covariance(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(0, 1, (300, 12)) @ np.diag(np.geomspace(2, 0.05, 12)) @ rng.normal(0, 1, (12, 12))
    vectors = [[float(v) for v in np.float32(row)] for row in base]
    got = rows_of(spark, list(enumerate(vectors)))
    x, values, trace, white = brute(vectors, 8)
    n, sums = len(x), [int(v) for v in x.sum(axis=0)]
    assert len(got) == 300 * 8
    found = np.zeros((300, 8))
    for r in got:
        found[r["vec_id"], r["component"] - 1] = r["whitened"]
        assert r["n"] == n and r["identity_error"] < 1e-9
        assert r["deviation"] == sum((n * int(a) - s) ** 2 for a, s in zip(x[r["vec_id"]], sums))
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / trace, rel=1e-9)
    sign = np.sign((found * white).sum(axis=0))
    assert np.abs(found * sign - white).max() < 1e-8


def test_defined_cases(spark):
    inf, nan = float("inf"), float("nan")
    assert rows_of(spark, []) == []
    assert rows_of(spark, [(1, None), (2, [nan, 1.0]), (3, [inf]), (4, [None, 1.0])]) == []
    assert rows_of(spark, [(1, [0.5, 0.5]), (2, [0.5, 0.5])]) == []        # no variance
    assert rows_of(spark, [(1, []), (2, [])]) == []
    # a repeated row counts twice, a null id stays, a short vector is padded with zero
    got = rows_of(spark, [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [0.0]), (7, [nan, 0.0])])
    assert sorted((r["vec_id"] or 0, r["component"], r["n"]) for r in got) == [(0, 1, 3), (1, 1, 3), (1, 1, 3)]
    assert all(abs(r["explained"] - 1) < 1e-12 and r["identity_error"] < 1e-12 for r in got)
    large = {r["vec_id"]: r["deviation"] for r in rows_of(spark, [(1, [9e5]), (2, [-9e5]), (3, [0.0])])}
    assert large == {1: (3 * 1024 * 900_000) ** 2, 2: (3 * 1024 * 900_000) ** 2, 3: 0}
    beyond = {r["vec_id"]: r["deviation"] for r in rows_of(spark, [(1, [1e6]), (2, [-1e6]), (3, [0.0])])}
    assert beyond == {1: None, 2: None, 3: 0}       # 9.4e18 is no long


def test_extra_columns_with_the_same_names_are_ignored(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], "a", 5), (2, [3.0, -2.0], "b", 6)],
                               "vec_id long, embedding array<double>, y string, n int")
    assert sorted(r["vec_id"] for r in wh.whiten(df).collect()) == [1, 2]


@pytest.mark.parametrize("values", [
    np.ones(9), [3, 3, 3, 2, 2, 1, 1, 1e-3], [5, 1, 1 + 1e-13, 1 - 1e-13, 1e-9, 0, 0], np.geomspace(1, 1e-12, 30)])
def test_values_and_directions_of_given_triangles(values):
    rng = np.random.default_rng(1)
    d = len(values)
    left, right = (np.linalg.qr(rng.normal(size=(d, d)))[0] for _ in range(2))
    r = np.linalg.qr(left @ np.diag(values) @ right, mode="r")
    found, vecs = wh.directions(r, d)
    real = np.sort(np.asarray(values, float))[::-1]
    real = real[real > 8 * d * 2.3e-16 * real[0]]
    assert len(found) >= len(real[real > 1e-12])
    assert np.allclose(found[:len(real)], real[:len(found)], rtol=1e-9, atol=1e-15)
    assert np.abs(vecs.T @ vecs - np.eye(len(found))).max() < 1e-10
    keep = found > 1e-6 * found[0]
    assert np.abs(np.linalg.norm(r @ vecs[:, keep], axis=0) - found[keep]).max() < 1e-9


def test_dqds_keeps_the_digits_of_small_values():
    a, b = np.array([1.0, 1e-8, 1e-3, 1e-10]), np.array([1e-5, 1e-4, 1e-9])
    m = np.diag(a) + np.diag(b, 1)
    assert np.prod(wh.dqds(a, b)) == pytest.approx(np.prod(a), rel=1e-12)
    assert np.allclose(wh.dqds(a, b)[:2], np.linalg.svd(m, compute_uv=False)[:2], rtol=1e-12)


def test_directions_of_many_random_triangles():
    rng = np.random.default_rng(9)
    for d in (1, 2, 3, 5, 17, 64):
        r = np.linalg.qr(rng.normal(size=(4 * d, d)) * rng.gamma(1, 1, d), mode="r")
        found, vecs = wh.directions(r, 8)
        assert np.allclose(found, np.linalg.svd(r, compute_uv=False)[:8], rtol=1e-12)
        assert np.abs(vecs.T @ vecs - np.eye(len(found))).max() < 1e-12
        assert np.abs(r.T @ (r @ vecs) - vecs * found ** 2).max() < 1e-12 * found[0] ** 2
