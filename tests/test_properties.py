"""Property-based checks (hypothesis) of the threshold operators against brute force on
random small inputs with many ties."""

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from raresight.operators import evaluate as E

pairs = st.lists(st.tuples(st.integers(0, 1), st.integers(0, 20)), min_size=1, max_size=60)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def frame(spark, rows):
    return spark.createDataFrame([(int(a), b / 20.0) for a, b in rows], "y long, p double")


def brute_ap(y, p):
    P = y.sum()
    if P == 0:
        return 0.0
    return sum((y[p == s].sum() / P) * (y[p >= s].sum() / (p >= s).sum()) for s in np.unique(p)[::-1])


@SETTINGS
@given(rows=pairs)
def test_average_precision_property(spark, rows):
    y = np.array([a for a, _ in rows])
    p = np.array([b / 20.0 for _, b in rows])
    assert abs(E.average_precision(frame(spark, rows)).first()["pr_auc"] - brute_ap(y, p)) < 1e-12


@SETTINGS
@given(rows=pairs, cfp=st.sampled_from([1.0, 4.0, 1000.0]), cfn=st.sampled_from([1.0, 137.0, 1000.0]))
def test_cost_threshold_property(spark, rows, cfp, cfn):
    y = np.array([a for a, _ in rows])
    p = np.array([b / 20.0 for _, b in rows])
    best = None
    for t in np.linspace(0.01, 0.99, 99):
        pred = p >= t
        c = (pred & (y == 0)).sum() * cfp + (~pred & (y == 1)).sum() * cfn
        if best is None or c < best[1]:
            best = (float(t), float(c))
    r = E.cost_optimal_threshold(frame(spark, rows), cfp, cfn).first()
    assert (r["threshold"], r["expected_cost"]) == best


@SETTINGS
@given(rows=pairs)
def test_f1_threshold_property(spark, rows):
    y = np.array([a for a, _ in rows])
    p = np.array([b / 20.0 for _, b in rows])
    P = y.sum()
    best = None
    for t in np.unique(p):  # ascending: the first maximum is the lowest threshold
        pred = p >= t
        tp = (pred & (y == 1)).sum()
        prec = tp / pred.sum()
        rec = tp / P if P else 1.0
        f1 = 2 * prec * rec / (prec + rec + 1e-9)
        if best is None or f1 > best[1]:
            best = (float(t), float(f1))
    r = E.f1_optimal_threshold(frame(spark, rows)).first()
    assert r["threshold"] == best[0] and abs(r["f1"] - best[1]) < 1e-12


@SETTINGS
@given(sizes=st.lists(st.integers(0, 40), min_size=1, max_size=4), frac=st.sampled_from([0.2, 0.25, 0.5]))
def test_split_counts_property(spark, sizes, frac):
    from pyspark.sql import functions as F

    from raresight.operators import prepare as T
    rows = [(k * 1000 + i, k) for k, n in enumerate(sizes) for i in range(n)]
    if not rows:
        return
    df = spark.createDataFrame(rows, "key long, Class long")
    got = {(r["Class"], r["split"]): r["n"] for r in T.stratified_split(df, ["key"], "Class", frac, 7)
           .groupBy("Class", "split").agg(F.count("*").alias("n")).collect()}
    for k, n in enumerate(sizes):
        if n:
            assert got.get((k, "test"), 0) == int(np.floor(n * frac)) and got.get((k, "train"), 0) == n - int(np.floor(n * frac))


@SETTINGS
@given(vals=st.lists(st.integers(-5, 5), min_size=1, max_size=80),
       q=st.lists(st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]), min_size=1, max_size=3, unique=True))
def test_exact_quantiles_property(spark, vals, q):
    from raresight.plans import exact_quantiles
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    got = {r["qi"]: r["value"] for r in exact_quantiles(df, "x", q, cells=3).collect()}
    for i, p in enumerate(q):
        assert abs(got[i] - np.percentile(np.array(vals, float), p * 100)) < 1e-12
