"""Edge cases listed as worth adding in FIXTURES.md: all negatives, all positives, one
row, empty frame, tiny classes, constant values."""

import pytest
from pyspark.sql import functions as F

from raresight.operators import evaluate as E
from raresight.operators import prepare as T
from raresight.operators import profile as P
from raresight.plans import exact_quantiles


def scored(spark, rows):
    return spark.createDataFrame(rows, "y long, p double")


def test_all_negatives(spark):
    df = scored(spark, [(0, 0.1), (0, 0.7)])
    assert E.average_precision(df).first()["pr_auc"] == 0.0
    assert E.roc_auc(df).first()["roc_auc"] is None
    r = E.cost_optimal_threshold(df, 4.0, 137.0).first()
    # linspace(0.01, 0.99, 99)[69] is 0.7000000000000001: already above the 0.7 score
    assert r["fp"] == 0 and r["fn"] == 0 and r["threshold"] == 0.7000000000000001
    m = E.classification_metrics(df, 0.5).first()
    assert (m["precision"], m["recall"], m["f1"]) == (0.0, 0.0, 0.0)


def test_all_positives(spark):
    df = scored(spark, [(1, 0.2), (1, 0.9), (1, 0.9)])
    assert E.average_precision(df).first()["pr_auc"] == 1.0
    assert E.roc_auc(df).first()["roc_auc"] is None
    assert E.f1_optimal_threshold(df).first()["threshold"] == 0.2


def test_one_row_and_empty(spark):
    one = scored(spark, [(1, 0.4)])
    assert E.average_precision(one).first()["pr_auc"] == 1.0
    assert [r["threshold"] for r in E.pr_curve(one).collect()].count(None) == 1
    empty = scored(spark, [])
    assert E.average_precision(empty).first()["pr_auc"] == 0.0
    assert E.confusion_counts(empty, 0.5).first()["tp"] == 0
    assert P.imbalance(spark.createDataFrame([], "Class long")).first()["pos_rate_pct"] is None


def test_split_with_tiny_classes(spark):
    df = spark.createDataFrame([(i, 0) for i in range(20)] + [(100, 1), (101, 2), (102, 2)], "k long, Class long")
    sp = {(r["Class"], r["split"]): r["n"] for r in
          T.stratified_split(df, ["k"], "Class", 0.2, 42).groupBy("Class", "split").agg(F.count("*").alias("n")).collect()}
    assert sp == {(0, "test"): 4, (0, "train"): 16, (1, "train"): 1, (2, "train"): 2}
    folds = T.stratified_folds(df, ["k"], "Class", 5, 42).filter("Class = 1").first()["fold"]
    assert 0 <= folds < 5


def test_constant_and_single_value_quantiles(spark):
    df = spark.createDataFrame([(5.0, 0)] * 7 + [(1.0, 1)], "x double, g long")
    got = {(r["g"], r["qi"]): r["value"] for r in exact_quantiles(df, "x", [0.25, 0.5], ["g"]).collect()}
    assert got == {(0, 0): 5.0, (0, 1): 5.0, (1, 0): 1.0, (1, 1): 1.0}
    d = P.describe(df, ["x"], by=["g"]).filter("g = 1").first()
    assert d["count"] == 1 and d["std"] is None or d["std"] != d["std"]


def test_describe_approximate_option_is_close(spark):
    import numpy as np
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, 5000)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    ex = P.describe(df, ["x"]).first()
    ap = P.describe(df, ["x"], exact=False, accuracy=10000).first()
    assert ex["count"] == ap["count"] == 5000
    for c in ("p25", "p50", "p75"):
        rank = np.searchsorted(np.sort(x), ap[c])  # approximate value's rank within 1/accuracy of exact
        assert abs(rank / 5000 - {"p25": 0.25, "p50": 0.5, "p75": 0.75}[c]) <= 1e-3 + 1 / 5000
        assert ex[c] == pytest.approx(float(np.percentile(x, {"p25": 25, "p50": 50, "p75": 75}[c])), abs=1e-12)


def test_bad_scores_and_labels_fail_by_name(spark):
    """Null and NaN scores and null labels fail in every evaluation operator instead of being counted."""
    from raresight.operators import evaluate as E

    for rows, name in (([(1, 0.5), (0, None)], "score column p"), ([(1, float("nan")), (0, 0.1)], "score column p"), ([(None, 0.5), (0, 0.1)], "label column y")):
        df = spark.createDataFrame(rows, "y long, p double")
        for run in (lambda: E.confusion_counts(df, 0.5), lambda: E.average_precision(df), lambda: E.cost_optimal_threshold(df, 1, 2), lambda: E.roc_auc(df)):
            with pytest.raises(Exception, match=name):
                run().collect()


def test_null_groups_are_groups(spark):
    from raresight.operators import evaluate as E

    df = spark.createDataFrame([("a", 1, 0.9), ("a", 0, 0.1), (None, 1, 0.8), (None, 0, 0.7)], "g string, y long, p double")
    for out in (E.average_precision(df, by=["g"]), E.cost_optimal_threshold(df, 1, 2, by=["g"]), E.model_metrics(df, 0.5, by=["g"]), E.roc_auc(df, by=["g"])):
        assert {r["g"] for r in out.collect()} == {"a", None}


def test_roc_auc_of_many_rows_does_not_overflow(spark):
    from raresight.operators import evaluate as E

    n = 4_000_000_000
    curve = spark.createDataFrame([(0.9, n, 0, n, 0, n, n), (0.1, 0, n, n, n, n, n)], "threshold double, n_pos long, n_neg long, tps long, fps long, P long, N long")
    assert E.roc_auc(None, curve=curve).first()["roc_auc"] == 1.0


def test_csv_is_read_by_name(spark, tmp_path):
    from pyspark.sql import types as T
    from raresight.errors import IngestError
    from raresight.sources import read_csv

    schema = T.StructType([T.StructField("Time", T.DoubleType()), T.StructField("Amount", T.DoubleType())])
    (tmp_path / "a.csv").write_text("Amount,Time\n1.0,2.0\n")
    assert read_csv(spark, str(tmp_path / "a.csv"), schema).collect() == [(2.0, 1.0)]
    (tmp_path / "b.csv").write_text("Amount,When\n1.0,2.0\n")
    with pytest.raises(IngestError, match="missing \\['Time'\\], unexpected \\['When'\\]"):
        read_csv(spark, str(tmp_path / "b.csv"), schema)


def test_split_ties_and_null_times_fail(spark):
    from raresight.operators import prepare as T

    same = spark.createDataFrame([(7, 0)] * 10, "k long, Class long")
    with pytest.raises(Exception, match="not unique"):
        T.stratified_split(same, ["k"], "Class", 0.2).collect()
    nulls = spark.createDataFrame([(i, None if i % 3 else 0) for i in range(30)], "k long, Class long")
    got = T.stratified_split(nulls, ["k"], "Class", 0.2).groupBy("Class", "split").count().collect()
    assert {(r["Class"], r["split"]): r["count"] for r in got} == {(0, "test"): 2, (0, "train"): 8, (None, "test"): 4, (None, "train"): 16}
    times = spark.createDataFrame([(1.0,), (None,), (3.0,)], "t double")
    with pytest.raises(Exception, match="time column t"):
        T.temporal_split(times, "t", 0.5).collect()


def test_drift_of_a_frame_against_itself_is_zero(spark):
    from raresight.functions import ntz_to_instant  # noqa: F401  (the window needs a timestamp)
    from raresight.operators import monitor as D

    nan = float("nan")
    x = spark.createDataFrame([(float(i),) for i in range(50)] + [(nan,)] * 50 + [(None,)] * 5, "x double")
    assert D.column_psi(x, x, ["x"]).first()["psi"] == 0.0
    c = spark.createDataFrame([("a",), ("b",), (None,)], "c string").selectExpr("c", "timestamp'2024-01-01 00:00:00' as ts")
    assert D.windowed_js(c, c, "ts", "c").first()["value"] == pytest.approx(0.0, abs=1e-9)


def test_delayed_labels_keep_unlabelled_groups(spark):
    from raresight.operators import monitor as D

    pred = spark.createDataFrame([(1, "x", 0.9), (2, "x", 0.2), (3, "z", 0.4)], "k long, g string, p double")
    lab = spark.createDataFrame([(1, 1), (2, 0)], "k long, y long")
    got = {r["g"]: r for r in D.delayed_label_quality(pred, lab, "k", by=["g"]).collect()}
    assert got["z"]["n_unlabelled"] == 1 and got["z"]["tp"] == 0 and got["x"]["tp"] == 1 and got["x"]["n_unlabelled"] == 0
    with pytest.raises(Exception, match="more than one label"):
        D.delayed_label_quality(pred, lab.union(lab), "k", by=["g"]).collect()


def test_correlation_is_pairwise_complete(spark):
    from raresight.operators import profile as P

    rows = [(float(i), float(i * i % 7), None if i % 4 else float(i % 5), 3.0) for i in range(40)] + [(float("nan"), 1.0, 2.0, 3.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    got = {(r["a"], r["b"]): r["r"] for r in P.correlation_matrix(df, ["a", "b", "c", "d"]).collect()}
    clean = df.replace(float("nan"), None)
    for x, y in (("a", "b"), ("a", "c"), ("b", "c")):
        want = clean.filter(f"{x} is not null and {y} is not null").selectExpr(f"corr({x}, {y}) as r").first()["r"]
        assert got[(x, y)] == pytest.approx(want, abs=1e-12) and got[(y, x)] == got[(x, y)]
    assert got[("a", "a")] == 1.0 and got[("d", "d")] is None and got[("a", "d")] is None


def test_smote_needs_more_positives_than_neighbours(spark):
    from raresight.errors import ModelConfigError
    from raresight.operators import train as M

    df = spark.createDataFrame([(i, float(i), 1 if i < 5 else 0) for i in range(30)], "vec_id long, V1 double, Class long")
    with pytest.raises(ModelConfigError, match="more than 5 positive"):
        M.smote(df, ["V1"], "Class", "vec_id", 5)
