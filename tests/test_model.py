import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotwise.operators import clusters as CL
from lotwise.operators import encode as E
from lotwise.operators import knn
from lotwise.operators import model as M
from lotwise.operators.quantiles import exact_quantiles
from lotwise.operators.signature_index import SignatureIndex
from lotwise.operators.tile_search import TileIndex
from lotwise.operators.selltime import weibull_scale, weibull_shape


def _bisect_shape(x):
    x = np.asarray(x, float)
    lx = np.log(x)

    def f(k):
        w = x ** k
        return (w * lx).sum() / w.sum() - 1.0 / k - lx.mean()
    lo, hi = 0.02, 200.0
    for _ in range(200):
        mid = (lo + hi) / 2
        if f(mid) > 0:
            hi = mid
        else:
            lo = mid
    k = (lo + hi) / 2
    return k, (np.mean(x ** k)) ** (1 / k)


def test_weibull_matches_bisection(spark):
    rnd = random.Random(7)
    samples = [[rnd.uniform(1, 200) for _ in range(rnd.randint(3, 22))] for _ in range(20)]
    samples.append([3.0, 9.0, 27.0, 44.0, 96.0, 144.0, 12.0])
    df = spark.createDataFrame([(s,) for s in samples], "xs array<double>")
    df = df.withColumn("k", weibull_shape(F.col("xs")))
    got = df.withColumn("lam", weibull_scale(F.col("xs"), F.col("k"))).collect()
    for r in got:
        k, lam = _bisect_shape(r["xs"])
        assert math.isclose(r["k"], k, rel_tol=1e-6) and math.isclose(r["lam"], lam, rel_tol=1e-6)


def brute(qv, qc, cv, cc, k):
    d = np.sqrt(((qv[:, None, :] - cv[None, :, :]) ** 2).sum(-1) + np.where(qc[:, None, :] == cc[None, :, :], 0, 2 - (qc[:, None, :] < 0) - (cc[None, :, :] < 0)).sum(-1))
    return [sorted(range(len(cv)), key=lambda j: (round(d[i, j], 9), j))[:k] for i in range(len(qv))]


@pytest.mark.parametrize("cell,block,broadcast", [(2000, 4096, 10 ** 6), (2000, 4096, 0), (20, 16, 0)])
def test_knn_matches_brute_force(spark, monkeypatch, cell, block, broadcast):
    monkeypatch.setattr(knn, "CELL", cell)
    monkeypatch.setattr(knn, "BLOCK", block)
    monkeypatch.setattr(knn, "BROADCAST_NUMBERS", broadcast)
    rnd = np.random.default_rng(3)
    v = rnd.normal(size=(300, 4))
    c = rnd.integers(-1, 3, size=(300, 3))
    v[:100], c[:100] = v[0], c[0]  # a third of the points are one point
    rows = [(i, [float(x) for x in a], [int(x) for x in b]) for i, (a, b) in enumerate(zip(v, c))]
    df = spark.createDataFrame(rows + [(999, None, [0, 0, 0])], "id long, vec array<double>, codes array<int>")
    q, n = df.withColumnRenamed("id", "qid"), df.withColumnRenamed("id", "nid")
    for self_too in (True, False):
        mine = {}
        for r in knn.knn_join(q, n, 5, codes="codes", exclude_self=not self_too).collect():
            mine.setdefault(r["qid"], []).append((r["rank"], r["nid"]))
        want = brute(v, c, v, c, 6)
        for i in range(300):
            order = want[i][:5] if self_too else [j for j in want[i] if j != i][:5]
            assert [x for _, x in sorted(mine[i])] == order
        assert 999 not in mine
    few = knn.knn_join(q.where("qid < 3"), n.where("nid >= 298 AND nid < 300"), 5, codes="codes").collect()
    assert sorted((r["qid"], r["rank"]) for r in few) == [(i, r) for i in range(3) for r in (1, 2)]
    assert knn.knn_join(q, n.where("nid < 0"), 5, codes="codes").count() == 0


@pytest.mark.parametrize("n,dims,columns,values", [(400, 3, 4, 3), (3000, 5, 9, 6), (500, 8, 0, 1), (200, 0, 5, 2), (1, 2, 2, 2), (600, 2, 130, 3)])
def test_signature_index_finds_the_nearest_by_bounds(n, dims, columns, values):
    rnd = np.random.default_rng(n)
    v = np.round(rnd.normal(size=(n, dims)), 1)  # many equal distances
    c = rnd.integers(-1, values, size=(n, columns)).astype(np.int32)
    v[:n // 3], c[:n // 3] = v[0], c[0]
    order = rnd.permutation(n)
    index, pairs = SignatureIndex(v, c, order, leaf=8), 0
    for i in range(0, n, max(1, n // 40)):
        code = c[i].copy()
        code[:1] = 99  # a code that no point has
        d2 = ((v - v[i]) ** 2).sum(1) + np.where(c == code, 0, 2 - (c < 0) - (code < 0)).sum(1)
        want = np.lexsort((order, np.round(np.sqrt(d2), 9)))[:7]
        at, d, m = index.search(v[i], code, 7)
        assert np.allclose(np.sort(d2[want]), np.sort(d ** 2), atol=1e-9)
        assert set(at[d < d[-1] - 1e-9]) == set(want[np.sqrt(d2[want]) < d[-1] - 1e-9])
        near = index.search(v[i], code, 7, limit=float(d[-1]))
        assert list(near[0]) == list(at) and len(index.search(v[i], code, 7, limit=float(d[0]) / 2 - 1e-6)[0]) == 0
        pairs += m
    if n == 3000:
        assert pairs < 0.2 * n * 41


def test_signature_index_compares_halves_of_the_codes():
    """A query looks at far fewer signatures and candidates than there are points."""
    rnd = np.random.default_rng(7)
    v, c = rnd.normal(size=(20_000, 3)), rnd.integers(0, 9, size=(20_000, 6)).astype(np.int32)
    index, seen = SignatureIndex(v, c, np.arange(20_000)), []
    assert len(index.a.size) <= 729 and len(index.b.size) <= 729 and index.a.size.sum() == index.b.size.sum() == 20_000
    within = index._within
    index._within = lambda *a: seen.append(len((got := within(*a))[0])) or got
    for i in range(0, 20_000, 1000):
        d2 = ((v - v[i]) ** 2).sum(1) + 2.0 * (c != c[i]).sum(1)
        assert list(index.search(v[i], c[i], 5)[0]) == list(np.argsort(d2, kind="stable")[:5])
    assert sum(seen) < 0.1 * 20 * 20_000


@pytest.mark.parametrize("n,dims,columns,values,indicators", [(5000, 5, 9, 6, 512), (3000, 12, 0, 1, 512), (2000, 0, 5, 3, 512), (3000, 3, 4, 700, 32), (1, 2, 2, 2, 512), (2500, 2, 130, 3, 512)])
def test_tile_search_finds_the_nearest(n, dims, columns, values, indicators):
    rnd = np.random.default_rng(n)
    v = np.round(rnd.normal(size=(n, dims)) * 3 + 1000, 1)  # many equal distances, far from 0
    c = rnd.integers(-1, values, size=(n, columns)).astype(np.int32)
    v[:n // 3], c[:n // 3] = v[0], c[0]
    order, at = rnd.permutation(n), np.arange(0, n, max(1, n // 300))
    codes = c[at].copy()
    codes[:, :1] = np.where(at[:, None] % 2, 999, codes[:, :1])  # a code that no point has
    d2 = ((v[at][:, None] - v[None]) ** 2).sum(-1) + np.where(codes[:, None] == c[None], 0, 2 - (codes[:, None] < 0) - (c[None] < 0)).sum(-1)
    want = [np.lexsort((order, np.round(x, 9)))[:7].tolist() for x in d2]
    index = TileIndex(v, c, order, tile=256, small=16, indicators=indicators)
    q, p, d, _ = index.search(v[at], codes, 7)
    for i in range(len(at)):
        own = q == i
        assert np.allclose(d[own] ** 2, d2[i][want[i]], atol=1e-9)
        assert set(p[own][d[own] < d[own].max() - 1e-9]) == set(j for j in want[i] if np.sqrt(d2[i][j]) < d[own].max() - 1e-9)
    limit = np.array([d[q == i].max() if i % 2 else 0.0 for i in range(len(at))])
    q, p, d, _ = index.search(v[at], codes, 7, limit)
    assert (d <= limit[q]).all() and all((q == i).sum() == min(7, n) for i in range(1, len(at), 2))


def test_tile_search_rules_tiles_out():
    rnd = np.random.default_rng(7)
    v, c = rnd.normal(size=(20_000, 3)), rnd.integers(0, 4, size=(20_000, 6)).astype(np.int32)
    q, p, d, pairs = TileIndex(v, c, np.arange(20_000)).search(v[:500], c[:500], 5)
    for i in range(0, 500, 50):
        d2 = ((v - v[i]) ** 2).sum(1) + 2.0 * (c != c[i]).sum(1)
        assert list(p[q == i]) == list(np.argsort(d2, kind="stable")[:5])
    assert pairs < 0.3 * 500 * 20_000


@pytest.mark.parametrize("broadcast", [10 ** 6, 0])
def test_knn_in_tiles_equals_one_by_one(spark, monkeypatch, broadcast):
    rnd = np.random.default_rng(9)
    rows = [(i, [float(x) for x in np.round(rnd.normal(size=3), 1)], [int(x) for x in rnd.integers(-1, 5, size=4)]) for i in range(1500)]
    rows.append((5000, [1e20, 0.0, 0.0], [0, 0, 0, 0]))
    df = spark.createDataFrame(rows, "id long, vec array<double>, codes array<int>")
    found = []
    for few, cell in ((10 ** 6, 2000), (0, 300)):
        for name, x in (("FEW", few), ("CELL", cell), ("BROADCAST_NUMBERS", broadcast), ("QUERIES", 400), ("BLOCK", 200)):
            monkeypatch.setattr(knn, name, x)
        asked, known = df.withColumnRenamed("id", "qid"), df.where("id < 5000").withColumnRenamed("id", "nid")
        found.append(sorted((r.qid, r["rank"], r.nid, round(r.dist, 9)) for r in knn.knn_join(asked, known, 6, codes="codes").collect()))
    assert found[0] == found[1] and len(found[0]) == 9006


def test_knn_counts_the_pairs_it_evaluates(spark):
    rnd = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rnd.normal(size=3)], [int(x) for x in rnd.integers(0, 9, size=6)]) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, vec array<double>, codes array<int>")
    seen = spark.sparkContext.accumulator(0)
    got = knn.knn_join(df.withColumnRenamed("id", "qid"), df.withColumnRenamed("id", "nid"), 5, codes="codes", evaluated=seen)
    assert got.count() == 10_000 and 10_000 <= seen.value < 0.2 * 2000 ** 2


def listings(spark, n=200, seed=1, makes=("Aa", "Bb", "Cc", None)):
    rnd = random.Random(seed)
    rows = [(f"V{seed}-{i}", *[rnd.choice([None, 2000.0 + i % 20, float(i)]) for _ in M.NUMERIC], *[rnd.choice(makes) for _ in M.CATEGORICAL],
             rnd.choice([None, 0.0, 3.0, 40.0, 90.0])) for i in range(n)]
    return spark.createDataFrame(rows, ", ".join(["VIN string"] + [f"`{c}` double" for c in M.NUMERIC] + [f"`{c}` string" for c in M.CATEGORICAL] + ["`Listed Days` double"]))


@pytest.fixture(scope="module")
def fitted(spark):
    return listings(spark), M.fit_model(listings(spark))


def test_codes_nulls_and_one_hot(spark, fitted):
    df, model = fitted
    codes = {(r["column"], r["value"]): r["code"] for r in model.encoding.codes.collect()}
    assert {v: codes[("State", v)] for v in ("Aa", "Bb", "Cc", None)} == {"Aa": 0, "Bb": 1, "Cc": 2, None: 3}
    hot, width = E.one_hot(df, M.CATEGORICAL, model.encoding.codes)
    assert width == 36 and all(len(r.hot) == 9 and r.hot == sorted(r.hot) for r in hot.collect())


def test_svd_equals_dense_and_clusters_are_nearest(spark, fitted):
    _, model = fitted
    rows = model.catalogue.collect()
    x = np.zeros((len(rows), 6 + model.encoding.width))
    for i, r in enumerate(rows):
        x[i, :6] = [*r.z, r.z_time]
        for j, c in enumerate(r.codes):
            x[i, 6 + model.encoding.offsets[M.CATEGORICAL[j]] + c] = 1
    v = model.components
    assert np.allclose(v.T @ v, np.eye(15), atol=1e-9)
    assert np.allclose(np.linalg.norm(x @ v, axis=0)[:10], np.linalg.svd(x, compute_uv=False)[:10], rtol=1e-2)
    svd = np.array([r.svd for r in rows])
    assert np.allclose(svd, x @ v)
    centres = np.array(model.kmeans.clusterCenters())
    assert [r.cluster for r in rows] == ((svd[:, None] - centres[None]) ** 2).sum(-1).argmin(1).tolist()
    days = {}
    for r in rows:
        days.setdefault(r.cluster, []).append(r["Listed Days"])
    for r in model.stats.collect():
        assert r["count"] == len(days[r.cluster]) and r["median"] == np.median(days[r.cluster])


def test_many_categories_take_the_other_way_with_equal_results(spark, fitted, monkeypatch):
    df, model = fitted
    monkeypatch.setattr(E, "BROADCAST_CODES", 0)
    codes = E.category_codes(df, M.CATEGORICAL)
    assert sorted(map(str, codes.collect())) == sorted(map(str, model.encoding.codes.collect()))
    other = M.encode(df, model.encoding)
    assert sorted(map(str, other.collect())) == sorted(map(str, model.catalogue.select(other.columns).collect()))
    monkeypatch.setattr(M, "SQUARED_FEATURES", 5)
    v = M.truncated_svd(other, model.encoding)
    table = np.zeros(model.components.shape)
    for r in v.collect():
        table[r.feature] = r.v
    assert np.allclose(np.abs((table * model.components).sum(axis=0))[:10], 1, atol=1e-6)
    placed = {r.VIN: r.svd for r in M.project(other, model.encoding, v).collect()}
    assert all(np.allclose(placed[r.VIN][:10], r.svd[:10], atol=1e-5) for r in model.catalogue.collect())


def test_refits_give_equal_labels_whatever_the_order_of_the_rows(spark, fitted):
    _, model = fitted
    want = {r.VIN: r.cluster for r in model.catalogue.collect()}
    placed = model.catalogue.drop("cluster")
    again = M.kmeans_fit(placed.orderBy(F.desc("VIN")).repartition(7))
    assert {r.VIN: r.cluster for r in M.kmeans_cluster(placed, again).collect()} == want
    mixed = CL.Clusters(model.kmeans.centres[::-1] + 0.01)
    like = M.kmeans_fit(placed, like=mixed)  # a refit takes the labels of the centres it matches
    assert {r.VIN: 7 - r.cluster for r in M.kmeans_cluster(placed, like).collect()} == want
    none = CL.fit_clusters(placed.limit(0), 3, 1, "svd", "VIN")
    assert M.kmeans_cluster(placed, none).where("cluster IS NOT NULL").count() == 0


def test_best_matching_equals_all_permutations():
    rnd = np.random.default_rng(4)
    for n in (1, 2, 4, 6):
        for _ in range(5):
            cost = np.round(rnd.random((n, n)), 1)
            got = CL.best_matching(cost)
            assert sorted(got) == list(range(n))
            assert math.isclose(cost[np.arange(n), got].sum(), min(cost[np.arange(n), list(p)].sum() for p in itertools.permutations(range(n))))


def test_new_listings_use_the_fitted_state(spark, fitted):
    df, model = fitted
    new = listings(spark, 30, seed=2, makes=("Bb", "Zz"))
    rows = {r.VIN: r for r in M.encode(new, model.encoding).collect()}
    raw = {r.VIN: r for r in new.collect()}
    for vin, r in rows.items():
        assert r.codes == [1 if raw[vin][c] == "Bb" else -1 for c in M.CATEGORICAL]
    scored = {r.VIN: r for r in M.score_new(new, model).collect()}
    assert len(scored) == 30 and all(r.current_listing_days == 0 and r.similar_cars_count == 20 for r in scored.values())
    again = {r.VIN: r.asDict() for r in M.score_new(new.limit(7), model).collect()}
    assert all(again[v] == scored[v].asDict() for v in again)  # nothing depends on the other new rows
    same = {r.VIN: r for r in M.score_new(df.where("`Listed Days` = 0"), model).collect()}
    inside = {r.VIN: r for r in M.score_all(df, model=model).collect()}
    assert same and all(same[v].cluster == inside[v].cluster and same[v].days_to_sell_median == inside[v].days_to_sell_median for v in same)


def test_score_fields_follow_the_closed_forms(spark, fitted):
    df, model = fitted
    for r in M.score_all(df, model=model).collect():
        t, k, lam = r.current_listing_days, r.weibull_shape, r.weibull_scale
        if k is None:
            assert r.probability_sold_30days == 0.5 and math.isclose(r.days_to_sell_25p, 0.7 * r.days_to_sell_median)
        else:
            sf = lambda x, k=k, lam=lam: math.exp(-((x / lam) ** k))
            assert math.isclose(r.probability_sold_30days, 1 - sf(t + 30) / sf(t), abs_tol=1e-9)
            q = lam * math.log(2) ** (1 / k)
            assert math.isclose(r.days_to_sell_median, max(0.0, q - t), abs_tol=1e-6)
        assert math.isclose(r.expected_days_to_sell, 0.7 * r.days_to_sell_median + 0.3 * r.similar_cars_median_days, abs_tol=1e-9)


def test_exact_quantiles(spark):
    rnd = np.random.default_rng(2)
    x = np.round(rnd.normal(size=500), 1)
    g = rnd.integers(0, 3, 500)
    df = spark.createDataFrame([(int(a), float(b), None) for a, b in zip(g, x)] + [(None, 1.0, None), (7, None, None)], "g int, x double, none double")
    got = {(r.grp, r.q): r.value for r in exact_quantiles(df, ["x", "none"], [0, 0.25, 0.5, 0.9, 1], "g").collect()}
    assert len(got) == 20 and got[(None, 0.5)] == 1.0
    for h in range(3):
        for q in (0, 0.25, 0.5, 0.9, 1):
            assert math.isclose(got[(h, q)], np.quantile(x[g == h], q), abs_tol=1e-12)
