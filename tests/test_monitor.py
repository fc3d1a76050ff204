"""Drift tests from the reference design (shifted vs stable pairs), empty current data,
and the statistics against brute force."""

import numpy as np
import pytest

from raresight.functions.stats import chi2_sf, norm_sf
from raresight.operators import monitor as D


def frame(spark, a, b):
    return spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)], "f1 double, f2 double")


def test_drift_detected_on_shifted_pair(spark):
    rng = np.random.default_rng(0)
    ref = frame(spark, rng.normal(0, 1, 500), rng.normal(0, 1, 500))
    cur = frame(spark, rng.normal(5, 1, 500), rng.normal(5, 1, 500))
    assert D.dataset_drift(D.drift_report(ref, cur, ["f1", "f2"])).first()["drift_share"] > 0.5


def test_no_drift_on_stable_pair(spark):
    rng = np.random.default_rng(0)
    ref = frame(spark, rng.normal(0, 1, 500), rng.normal(0, 1, 500))
    cur = frame(spark, rng.normal(0, 1, 500), rng.normal(0, 1, 500))
    assert D.dataset_drift(D.drift_report(ref, cur, ["f1", "f2"])).first()["drift_share"] < 0.5


def test_empty_current_means_no_drift(spark):
    rng = np.random.default_rng(0)
    ref = frame(spark, rng.normal(0, 1, 50), rng.normal(0, 1, 50))
    cur = ref.limit(0)
    assert D.detect_drift(ref, cur, ["f1", "f2"]).first()["dataset_drift"] is False


def test_ks_and_wasserstein_match_brute_force(spark):
    rng = np.random.default_rng(5)
    a, b = np.round(rng.normal(0, 1, 700), 2), np.round(rng.normal(0.3, 1.2, 400), 2)
    ref = spark.createDataFrame([(float(x),) for x in a], "x double")
    cur = spark.createDataFrame([(float(x),) for x in b], "x double")
    r = D.numeric_drift(ref, cur, ["x"]).first()
    grid = np.union1d(a, b)
    Fa = np.searchsorted(np.sort(a), grid, side="right") / len(a)
    Fb = np.searchsorted(np.sort(b), grid, side="right") / len(b)
    assert r["ks_stat"] == pytest.approx(np.abs(Fa - Fb).max(), abs=1e-12)
    w1 = np.sum(np.abs(Fa - Fb)[:-1] * np.diff(grid))
    assert r["wasserstein_norm"] == pytest.approx(w1 / np.std(a), rel=1e-9)


def test_tail_probabilities():
    assert chi2_sf(3.841458820694124, 1) == pytest.approx(0.05, abs=1e-9)
    assert chi2_sf(11.070497693516351, 5) == pytest.approx(0.05, abs=1e-9)
    assert norm_sf(1.959963984540054) == pytest.approx(0.025, abs=1e-12)


def test_categorical_drift_statistics(spark):
    ref = spark.createDataFrame([("a",)] * 50 + [("b",)] * 50, "c string")
    cur = spark.createDataFrame([("a",)] * 90 + [("b",)] * 10, "c string")
    r = D.categorical_drift(ref, cur, ["c"]).first()
    assert r["chi2_stat"] == pytest.approx((90 - 50) ** 2 / 50 + (10 - 50) ** 2 / 50)
    p, q = np.array([0.5, 0.5]), np.array([0.9, 0.1])
    m = (p + q) / 2
    js = np.sqrt(0.5 * np.sum(p * np.log(p / m)) + 0.5 * np.sum(q * np.log(q / m)))
    assert r["js_distance"] == pytest.approx(js, rel=1e-12)
    assert r["z_p_value"] < 1e-6


def test_contributions_top_k(spark):
    df = spark.createDataFrame([(1, 1.0, 10.0, -3.0)], "k long, a double, b double, c double")
    out = D.linear_contributions(df, ["k"], {"a": 1.0, "b": 0.1, "c": 1.0}, {"a": 0.0, "b": 0.0, "c": 0.0}, 2).collect()
    assert [(r["rank"], r["feature"]) for r in out] == [(1, "c"), (2, "a")]


def test_resampled_injection_is_n_3_2_and_detected(spark):
    from conftest import SF01
    from raresight.sources import tables as S
    feat = S.feature_table(spark, SF01, n_features=4)
    cols = ["V1", "V2", "V3", "V4"]
    inj = D.inject_drift(feat, ["vec_id"], cols, None, None, seed=0, mode="resample")
    from pyspark.sql import functions as F
    st = inj.agg(*[F.avg(c) for c in cols]).first()
    assert all(2.6 < v < 3.4 for v in st)
    assert D.detect_drift(feat, inj, cols).first()["dataset_drift"] is True


def test_ks_p_value_series_matches_reference(spark):
    import math
    from pyspark.sql import functions as F

    def q(lam):
        return min(1.0, max(0.0, sum(2 * (-1) ** (j - 1) * math.exp(-2 * j * j * lam * lam) for j in range(1, 101))))

    rows = [(d, 400.0, 300.0) for d in (0.02, 0.05, 0.08, 0.1, 0.15, 0.2, 0.3)]
    df = spark.createDataFrame(rows, "d double, n double, m double")
    got = df.select("d", D.ks_p_value(F.col("d"), F.col("n"), F.col("m")).alias("p")).collect()
    for r in got:
        en = math.sqrt(400 * 300 / 700)
        lam = (en + 0.12 + 0.11 / en) * r["d"]
        want = 1.0 if lam < 0.3 else q(lam)
        assert r["p"] == pytest.approx(want, abs=1e-15)


def test_delayed_label_quality_without_groups(spark):
    pred = spark.createDataFrame([(1, 0.9), (2, 0.2), (3, 0.7)], "k long, p double")
    lab = spark.createDataFrame([(1, 1), (2, 0)], "k long, y long")
    r = D.delayed_label_quality(pred, lab, "k", 0.5).first()
    assert (r["tp"], r["tn"], r["n_unlabelled"], r["pr_auc"]) == (1, 1, 1, 1.0)
