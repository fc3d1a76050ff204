"""Threshold and metric tests: the reference's direction tests, published arithmetic,
and brute-force numpy checks of the distributed plans."""

import numpy as np
from pyspark.sql import functions as F
import pytest

from raresight.errors import EvaluationError
from raresight.operators import evaluate as E

F1_Y, F1_P = [0, 0, 1, 1, 0, 1], [0.1, 0.2, 0.9, 0.8, 0.3, 0.6]
OV_Y, OV_P = [0, 0, 1, 1], [0.3, 0.6, 0.4, 0.7]


def scored(spark, y, p):
    return spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)], "y long, p double")


def brute_ap(y, p):
    y, p = np.asarray(y), np.asarray(p)
    P = y.sum()
    if P == 0:
        return 0.0
    ap = 0.0
    for s in np.unique(p)[::-1]:
        sel = p >= s
        tps = y[sel].sum()
        prec = tps / sel.sum()
        ap += (y[p == s].sum() / P) * prec
    return ap


def brute_cost(y, p, cfp, cfn):
    y, p = np.asarray(y), np.asarray(p)
    best = None
    for t in np.linspace(0.01, 0.99, 99):
        pred = p >= t
        cost = ((pred & (y == 0)).sum() * cfp + (~pred & (y == 1)).sum() * cfn)
        if best is None or cost < best[1]:
            best = (float(t), float(cost))
    return best


def test_f1_threshold_in_range(spark):
    r = E.f1_optimal_threshold(scored(spark, F1_Y, F1_P)).first()
    assert 0.0 <= r["threshold"] <= 1.0 and 0.0 <= r["f1"] <= 1.0
    assert r["threshold"] == 0.6  # all three positives, no false alarm


def test_cost_threshold_moves_with_asymmetry(spark):
    lo = E.cost_optimal_threshold(scored(spark, OV_Y, OV_P), 1, 1000).first()
    hi = E.cost_optimal_threshold(scored(spark, OV_Y, OV_P), 1000, 1).first()
    assert lo["threshold"] < 0.4 and hi["threshold"] > 0.6 and lo["threshold"] < hi["threshold"]
    assert lo["threshold"] == pytest.approx(0.31) and lo["expected_cost"] == 1.0
    assert hi["threshold"] == pytest.approx(0.61) and hi["expected_cost"] == 1.0


@pytest.mark.parametrize("cfp,cfn", [(0, 10), (10, 0), (-1, 10), (10, -1)])
def test_non_positive_costs_rejected(spark, cfp, cfn):
    with pytest.raises(EvaluationError, match="must be positive"):
        E.cost_optimal_threshold(scored(spark, [0, 1], [0.4, 0.6]), cfp, cfn)


def test_published_confusion_arithmetic(spark):
    # FP 70, FN 11, TP 87 -> precision 0.554140, recall 0.887755, F1 0.682353 (published)
    c = spark.createDataFrame([(87, 70, 11, 0)], "tp long, fp long, fn long, tn long")
    r = E.with_rates(c).first()
    assert round(r["precision"], 6) == 0.554140 and round(r["recall"], 6) == 0.887755
    assert round(r["f1"], 6) == 0.682353
    for fp, fn, cost in [(70, 11, 1787), (12, 16, 2240), (2, 21, 2885), (1461, 8, 6940)]:
        assert fp * 4 + fn * 137 == cost


def test_average_precision_matches_brute_force_with_ties(spark):
    rng = np.random.default_rng(7)
    y = rng.integers(0, 2, 3000)
    p = np.round(rng.random(3000) * 0.6 + y * 0.3, 2)  # many ties
    got = E.average_precision(scored(spark, y, p)).first()["pr_auc"]
    assert got == pytest.approx(brute_ap(y, p), rel=1e-12)


def test_average_precision_no_positives_is_zero(spark):
    assert E.average_precision(scored(spark, [0, 0, 0], [0.1, 0.5, 0.9])).first()["pr_auc"] == 0.0


def test_cost_sweep_matches_linspace_loop(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 2000)
    p = rng.random(2000)
    p[:50] = np.linspace(0.01, 0.99, 99)[:50]  # scores exactly on candidates: inclusive >=
    r = E.cost_optimal_threshold(scored(spark, y, p), 4.0, 137.0).first()
    t, c = brute_cost(y, p, 4.0, 137.0)
    assert (r["threshold"], r["expected_cost"]) == (t, c)


def test_pr_curve_has_end_point_and_roc_auc(spark):
    rows = E.pr_curve(scored(spark, OV_Y, OV_P)).collect()
    assert any(r["threshold"] is None and r["precision"] == 1.0 and r["recall"] == 0.0 for r in rows)
    assert len(rows) == 5
    auc = E.roc_auc(scored(spark, OV_Y, OV_P)).first()["roc_auc"]
    assert auc == pytest.approx(0.75)


def test_promote_only_on_strictly_better(spark):
    cand = spark.createDataFrame([("a", 0.8), ("b", 0.9)], "slot string, pr_auc double")
    inc = spark.createDataFrame([("a", 0.8)], "slot string, pr_auc double")
    got = {r["slot"]: r["promote"] for r in E.promote_if_better(cand, inc).collect()}
    assert got == {"a": False, "b": True}


def test_quality_gate(spark):
    m = spark.createDataFrame([("x", 0.74), ("y", 0.75)], "model_id string, pr_auc double")
    got = {r["model_id"]: r["passed"] for r in E.quality_gate(m, 0.75).collect()}
    assert got == {"x": False, "y": True}


def test_operating_points_match_brute_force(spark):
    rng = np.random.default_rng(21)
    y = rng.integers(0, 2, 1500)
    p = np.round(rng.random(1500), 3)
    ts = [0.03, 0.5, 0.9921, 0.5]  # duplicates collapse
    got = {r["threshold"]: r for r in E.operating_points(scored(spark, y, p), ts, 4.0, 137.0).collect()}
    assert sorted(got) == [0.03, 0.5, 0.9921]
    for t, r in got.items():
        pred = p >= t
        fp, fn = int((pred & (y == 0)).sum()), int((~pred & (y == 1)).sum())
        assert (r["fp"], r["fn"], r["cost"]) == (fp, fn, fp * 4.0 + fn * 137.0)


def test_matched_recall_matches_brute_force(spark):
    rng = np.random.default_rng(22)
    y = rng.integers(0, 2, 800)
    p = np.round(rng.random(800) * 0.7 + y * 0.2, 2)
    r = E.matched_recall_point(scored(spark, y, p).withColumn("model_id", F.lit("m")), 0.8, 4.0, 137.0).first()
    best = None
    for t in np.unique(p):
        pred = p >= t
        rec = (pred & (y == 1)).sum() / y.sum()
        if rec >= 0.8:
            cost = (pred & (y == 0)).sum() * 4.0 + (~pred & (y == 1)).sum() * 137.0
            if best is None or cost < best[1] or (cost == best[1] and t < best[0]):
                best = (t, cost)
    assert (r["threshold"], r["cost"]) == (best[0], best[1])


def test_roc_auc_tie_aware_rank_sum(spark):
    rng = np.random.default_rng(23)
    y = rng.integers(0, 2, 2000)
    p = np.round(rng.random(2000) * 0.8 + y * 0.1, 2)
    pos, neg = p[y == 1], p[y == 0]
    want = np.mean([(a > b) + 0.5 * (a == b) for a in pos[:300] for b in neg[:300]])
    sub = scored(spark, np.concatenate([np.ones(300, int), np.zeros(300, int)]), np.concatenate([pos[:300], neg[:300]]))
    assert E.roc_auc(sub).first()["roc_auc"] == pytest.approx(want, abs=1e-12)


def test_best_model_and_ranking(spark):
    m = spark.createDataFrame([("a", 0.7), ("b", 0.9), ("c", 0.9)], "model_id string, pr_auc double")
    assert E.best_model(m).first()["model_id"] == "b"  # ties: first by key
    assert [r["model_id"] for r in E.rank_models(m).orderBy("rank", "model_id").collect()] == ["b", "c", "a"]


def test_champion_challenger_arms_are_stable(spark):
    from raresight.operators import monitor as D
    df = spark.range(20000).withColumnRenamed("id", "k")
    a = {r["k"] for r in D.assign_arm(df, ["k"], 0.1, 42).filter("arm = 'challenger'").collect()}
    b = {r["k"] for r in D.assign_arm(df.repartition(7), ["k"], 0.1, 42).filter("arm = 'challenger'").collect()}
    assert a == b and 1700 < len(a) < 2300
