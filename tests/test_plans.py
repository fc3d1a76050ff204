"""The scale plans against brute force."""

import numpy as np
import pytest

from raresight.functions import hash_hex
from raresight.plans import cumulative_by_value, exact_knn, exact_quantiles, hash_rank, hash_rank_cutoffs


@pytest.mark.parametrize("limit", [1 << 20, 50, 2])
@pytest.mark.parametrize("descending", [True, False])
def test_cumulative_matches_numpy(spark, limit, descending):
    """With small limits the sums go through buckets of buckets, on two and on three levels."""
    rng = np.random.default_rng(1)
    close = 0.75 + np.arange(400) * 1e-12  # all in one cell
    vals = np.unique(np.concatenate([np.round(rng.exponential(1, 1500), 4), -np.round(rng.exponential(5, 500), 2), [0.0, 1e300, -1e300, 5e-324, np.inf, -np.inf], close, -close]))
    w = rng.integers(0, 5, len(vals))
    df = spark.createDataFrame([(float(v), int(x), None if i % 2 else "g") for i, (v, x) in enumerate(zip(vals, w))], "v double, w long, g string")
    got = {r["v"]: (r["cum_w"], r["next_v"]) for r in cumulative_by_value(df, "v", ["w"], ["g"], descending=descending, next_value=True, limit=limit).collect()}
    for part in (0, 1):
        own, weights = vals[part::2], w[part::2]
        order = np.argsort(-own if descending else own)
        cum = np.cumsum(weights[order])
        for i, idx in enumerate(order):
            assert got[own[idx]] == (cum[i], own[order[i + 1]] if i + 1 < len(order) else None)


def test_exact_quantiles_match_numpy_linear(spark):
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(0, 1, 20000), 3)
    df = spark.createDataFrame([(float(v), int(i % 2)) for i, v in enumerate(x)], "x double, g long")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {(r["g"], r["qi"]): r["value"] for r in exact_quantiles(df, "x", probs, ["g"], cells=64).collect()}
    for g in (0, 1):
        xs = x[np.arange(len(x)) % 2 == g]
        for i, q in enumerate(probs):
            assert got[(g, i)] == pytest.approx(np.percentile(xs, q * 100), abs=1e-12)


@pytest.mark.parametrize("grouped", [True, False])
def test_exact_quantiles_two_rounds_match_numpy(spark, grouped):
    rng = np.random.default_rng(9)
    x = np.concatenate([np.round(rng.exponential(1, 30000), 4), np.full(15000, 0.5)])  # a hot value
    g = np.arange(len(x)) % 3
    df = spark.createDataFrame([(float(v), int(k)) for v, k in zip(x, g)], "x double, g long")
    probs = [0.01, 0.25, 0.5, 0.9]
    by = ["g"] if grouped else []
    got = exact_quantiles(df, "x", probs, by, cells=16).collect()
    for r in got:
        xs = x[g == r["g"]] if grouped else x
        assert r["value"] == pytest.approx(np.percentile(xs, probs[r["qi"]] * 100), abs=1e-12)


def test_hash_rank_and_cutoffs_match_sort(spark):
    df = spark.range(5000).withColumn("h", hash_hex(42, "id"))
    pdf = df.toPandas().sort_values("h").reset_index(drop=True)
    ranks = {r["id"]: r["rank"] for r in hash_rank(df, "h", prefix_len=2).collect()}
    assert all(ranks[i] == k for k, i in enumerate(pdf["id"]))
    cut = hash_rank_cutoffs(df, "h", [0.2, 0.5], prefix_len=3).collect()
    got = {r["j"]: (r["need"], r["cutoff"]) for r in cut}
    assert got[0] == (1000, pdf["h"][999]) and got[1] == (2500, pdf["h"][2499])


def test_exact_knn_matches_brute_force(spark):
    rng = np.random.default_rng(4)
    X = rng.normal(0, 1, (300, 4))
    df = spark.createDataFrame([(i, *map(float, X[i])) for i in range(300)], "k long, a double, b double, c double, d double")
    got = exact_knn(df, "k", ["a", "b", "c", "d"], 5, block_size=64).collect()
    nn = {}
    for r in got:
        nn.setdefault(r["k"], {})[r["j"]] = r["nn_k"]
    D = np.sqrt(((X[:, None, :] - X[None, :, :]) ** 2).sum(-1))
    np.fill_diagonal(D, np.inf)
    for i in range(300):
        want = list(np.lexsort((np.arange(300), D[i]))[:5])
        assert [nn[i][j] for j in range(5)] == want


def test_exact_knn_with_duplicates_and_ties(spark):
    rng = np.random.default_rng(11)
    X = rng.integers(-4, 5, (200, 3)).astype(float)  # integer coordinates: ties are exact
    X[100:140] = X[:40]  # exact duplicate points: distance 0 ties
    df = spark.createDataFrame([(i, *map(float, X[i])) for i in range(200)], "k long, a double, b double, c double")
    got = exact_knn(df, "k", ["a", "b", "c"], 5, block_size=50).collect()
    nn = {}
    for r in got:
        nn.setdefault(r["k"], {})[r["j"]] = r["nn_k"]
    D = np.sqrt(((X[:, None, :] - X[None, :, :]) ** 2).sum(-1))
    np.fill_diagonal(D, np.inf)
    for i in range(200):
        assert [nn[i][j] for j in range(5)] == list(np.lexsort((np.arange(200), D[i]))[:5])


def test_exact_knn_skips_most_cells_of_clustered_points(spark):
    """1e5 points in 50 clusters: nearly all (point, cell) pairs are ruled out, and the neighbours are the exact ones."""
    from raresight.plans import neighbours as N

    rng = np.random.default_rng(5)
    centres = rng.normal(0, 100, (50, 3))
    X = centres[np.arange(100_000) % 50] + rng.normal(0, 0.5, (100_000, 3))
    df = spark.createDataFrame([(i, *map(float, x)) for i, x in enumerate(X)], "k long, a double, b double, c double").repartition(8)
    _, cells, _, visits = N._plan(df, "k", ["a", "b", "c"], 5, 1024, 42)
    assert visits.count() < 0.15 * 100_000 * cells.count()
    got = {}
    for r in exact_knn(df, "k", ["a", "b", "c"], 5, block_size=1024).filter("k % 5000 = 0").collect():
        got.setdefault(r["k"], {})[r["j"]] = r["nn_k"]
    for i, near in got.items():
        d = np.sqrt(((X - X[i]) ** 2).sum(1))
        d[i] = np.inf
        assert [near[j] for j in range(5)] == list(np.lexsort((np.arange(len(X)), d))[:5])
    assert len(got) == 20
