"""Profiling operators against numpy on small fixtures."""

import datetime as dt
import math

import numpy as np
import pytest

from raresight.operators import monitor as D
from raresight.operators import profile as P


def frame(spark, x, y):
    return spark.createDataFrame([(float(a), int(b)) for a, b in zip(x, y)], "x double, Class long")


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(31)
    x, y = rng.exponential(50, 3000), rng.integers(0, 2, 3000)
    got = {(r["Class"], r["bin"]): r["n"] for r in P.grouped_histogram(frame(spark, x, y), "x", "Class", 50).collect()}
    lo, hi = x.min(), x.max()
    w = (hi - lo) / 50
    b = np.minimum(np.floor((x - lo) / w), 49).astype(int)
    want = {}
    for c, k in zip(y, b):
        want[(int(c), int(k))] = want.get((int(c), int(k)), 0) + 1
    assert got == want


def test_box_stats_match_numpy(spark):
    rng = np.random.default_rng(32)
    x = np.concatenate([rng.normal(0, 1, 1000), [15.0, -12.0]])
    y = np.zeros(len(x), int)
    df = frame(spark, x, y).withColumnRenamed("x", "V1")
    r = P.box_stats(df, ["V1"], "Class").first()
    q1, med, q3 = np.percentile(x, [25, 50, 75])
    lf, uf = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    assert (r["q1"], r["median"], r["q3"]) == pytest.approx((q1, med, q3), abs=1e-12)
    assert r["whisker_lo"] == x[x >= lf].min() and r["whisker_hi"] == x[x <= uf].max()
    assert r["n_outliers"] == int(((x < lf) | (x > uf)).sum())


def test_density_matches_gaussian_kde_formula(spark):
    rng = np.random.default_rng(33)
    x = np.round(rng.normal(10, 3, 400), 1)
    y = np.zeros(400, int)
    rows = P.class_density(frame(spark, x, y), "x", "Class", 50, 3.0).orderBy("j").collect()
    h = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min() - 3 * h, x.max() + 3 * h, 50)
    dens = np.exp(-0.5 * ((grid[:, None] - x[None, :]) / h) ** 2).sum(1) / (len(x) * h * math.sqrt(2 * math.pi))
    assert [r["x"] for r in rows] == pytest.approx(list(grid), abs=1e-12)
    assert [r["density"] for r in rows] == pytest.approx(list(dens), rel=1e-9)


def test_windowed_psi_matches_numpy(spark):
    rng = np.random.default_rng(34)
    base = dt.datetime(2024, 1, 1)
    ref_x = rng.normal(0, 1, 2000)
    cur_x = np.concatenate([rng.normal(0, 1, 500), rng.normal(1, 1, 500)])
    cur_t = [base + dt.timedelta(days=int(i >= 500), hours=int(i % 24)) for i in range(1000)]
    ref = spark.createDataFrame([(float(v),) for v in ref_x], "x double")
    cur = spark.createDataFrame([(t, float(v)) for t, v in zip(cur_t, cur_x)], "ts timestamp_ntz, x double")
    got = {r["window_start"]: r["value"] for r in D.windowed_psi(ref, cur, "ts", "x", "1 day", 10).collect()}
    edges = np.percentile(ref_x, np.arange(10, 100, 10))
    rb = np.bincount(np.searchsorted(edges, ref_x, side="left"), minlength=10) / len(ref_x)
    for day in (0, 1):
        xs = cur_x[day * 500:(day + 1) * 500]
        cb = np.bincount(np.searchsorted(edges, xs, side="left"), minlength=10) / len(xs)
        c, r = np.maximum(cb, 1e-4), np.maximum(rb, 1e-4)
        assert got[base + dt.timedelta(days=day)] == pytest.approx(float(np.sum((c - r) * np.log(c / r))), rel=1e-9)
    assert got[base + dt.timedelta(days=1)] > 0.1 > got[base]


def test_column_psi_two_columns_match_numpy(spark):
    rng = np.random.default_rng(35)
    ra, rb_ = rng.normal(0, 1, 3000), rng.exponential(2, 3000)
    ca, cb_ = rng.normal(0.5, 1, 2000), rng.exponential(2, 2000)
    ref = spark.createDataFrame([(float(a), float(b)) for a, b in zip(ra, rb_)], "a double, b double")
    cur = spark.createDataFrame([(float(a), float(b)) for a, b in zip(ca, cb_)], "a double, b double")
    got = {r["column"]: r["psi"] for r in D.column_psi(ref, cur, ["a", "b"], 10).collect()}
    for name, rx, cx in (("a", ra, ca), ("b", rb_, cb_)):
        edges = np.percentile(rx, np.arange(10, 100, 10))
        r = np.maximum(np.bincount(np.searchsorted(edges, rx, side="left"), minlength=10) / len(rx), 1e-4)
        c = np.maximum(np.bincount(np.searchsorted(edges, cx, side="left"), minlength=10) / len(cx), 1e-4)
        assert got[name] == pytest.approx(float(np.sum((c - r) * np.log(c / r))), rel=1e-9)
    assert got["a"] > got["b"]
