import math

import numpy as np

from lotwise.llm import whitening as wh


def _brute(vectors, wanted=16):
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors], object)
    fit = np.unique(x.astype(np.int64), axis=0)
    n, s = len(fit), fit.sum(axis=0)
    c = fit - s / n
    e, v = np.linalg.eigh(c.T @ c / n)
    e, v = e[::-1], v[:, ::-1]
    deviation = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(r, s)) for r in x]
    return n, deviation, e[:wanted] / e.sum(), (x.astype(float) - s / n) @ v[:, :wanted] / np.sqrt(e[:wanted])


def _check(got, ids, vectors, wanted=16):
    n, deviation, explained, white = _brute(vectors, wanted)
    by = {(r.vec_id, r.component): r for r in got}
    k = min(wanted, len(explained))
    assert len(got) == len(ids) * k
    for j in range(k):
        col = np.array([by[i, j + 1].whitened for i in ids])
        sign = np.sign(col @ white[:, j])
        assert np.allclose(col, sign * white[:, j], atol=1e-7)
        assert abs(by[ids[0], j + 1].explained / explained[j] - 1) < 1e-9
    assert [by[i, 1].deviation for i in ids] == deviation
    assert {r.n for r in got} == {n} and max(r.identity_error for r in got) < 1e-10


def test_equals_eigh_on_distinct_vectors(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((400, 20)) * np.linspace(3, 0.2, 20)
    vectors = [*base, *base[:50], *[base[0]] * 200]  # a third and more are copies
    rows = [(i, v.tolist(), "x") for i, v in enumerate(vectors)]
    bad = [(None, None, "x"), (900, None, "x"), (901, [float("nan")] * 20, "x"), (902, [float("inf")] + [0.0] * 19, "x"),
           (903, [None] + [0.0] * 19, "x"), (904, [1.0] * 3, "x"), (905, [], "x")]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, component string").repartition(6)
    _check(wh.whiten(df).collect(), list(range(len(vectors))), vectors)


def test_few_dimensions_and_rows(spark):
    schema = "vec_id long, embedding array<float>"
    assert wh.whiten(spark.createDataFrame([], schema)).count() == 0
    assert wh.whiten(spark.createDataFrame([(1, [1.0, 2.0])], schema)).count() == 0
    assert wh.whiten(spark.createDataFrame([(1, [])], schema)).count() == 0
    vectors = [[1.0, 2.0], [3.0, -1.0], [0.5, 0.25], [7.0, 7.0]]
    _check(wh.whiten(spark.createDataFrame(list(enumerate(vectors)), schema)).collect(), [0, 1, 2, 3], vectors)
    flat = [[float(i), 2.0 * i, 5.0] for i in range(9)]  # one direction only
    got = wh.whiten(spark.createDataFrame(list(enumerate(flat)), schema)).collect()
    assert {r.component for r in got} == {1} and abs(got[0].explained - 1) < 1e-12


def test_large_entries_are_limited_not_wrong(spark):
    df = spark.createDataFrame([(i, [3.0e38 * (-1) ** i, float(i)]) for i in range(6)], "vec_id long, embedding array<float>")
    got = wh.whiten(df).collect()
    assert len(got) == 6 and all(r.deviation is None and abs(abs(r.whitened) - 1) < 1e-6 for r in got)  # the other direction is lost in rounding


def test_solver_on_close_equal_and_missing_eigenvalues():
    rng = np.random.default_rng(5)
    for values in ([5, 5, 5, 2, 2, 0, 0], [1, 1 + 1e-9, 3, 3 + 1e-12, 1e-6], [4, 3, 2, 1], [2, 2, 2], [1e9, 1, 1e-3]):
        d = len(values)
        q, _ = np.linalg.qr(rng.standard_normal((d, d)))
        a = q @ np.diag(np.array(values, float)) @ q.T
        a = (a + a.T) / 2
        e, v = wh.principal_components(a, d)
        want = np.sort(np.array(values, float))[::-1]
        want = want[want > 1e-13 * want[0]]
        assert np.allclose(e, want, rtol=1e-6, atol=1e-14 * want[0] * d)
        assert np.abs(a @ v - v * e).max() < 1e-13 * want[0] * d and np.abs(v.T @ v - np.eye(len(e))).max() < 1e-12


def test_polar_factor():
    a = np.random.default_rng(1).standard_normal((8, 8))
    a = a + a.T
    u = wh.polar_factor(a)
    w, q = np.linalg.eigh(a)
    assert np.abs(u - (q * np.sign(w)) @ q.T).max() < 1e-12
