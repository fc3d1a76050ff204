"""Invariants of the preparation operators on the given tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF01
from raresight.operators import prepare as T
from raresight.sources import tables as S


def test_stratified_split_exact_disjoint_complete(spark):
    tx = S.transaction_table(spark, SF01)
    sp = T.stratified_split(tx, ["event_id"], "Class", 0.2, 42)
    c = {(r["Class"], r["split"]): r["n"] for r in sp.groupBy("Class", "split").agg(F.count("*").alias("n")).collect()}
    tot = {r["Class"]: r["n"] for r in tx.groupBy("Class").agg(F.count("*").alias("n")).collect()}
    for k, n in tot.items():
        assert c[(k, "test")] == int(np.floor(n * 0.2)) and c[(k, "test")] + c[(k, "train")] == n
    assert sp.select("event_id").distinct().count() == tx.count()
    again = T.stratified_split(tx.repartition(3), ["event_id"], "Class", 0.2, 42)
    assert sp.filter("split = 'test'").select("event_id").subtract(
        again.filter("split = 'test'").select("event_id")).count() == 0


def test_folds_balanced_per_class(spark):
    tx = S.transaction_table(spark, SF01)
    f = T.stratified_folds(tx, ["event_id"], "Class", 5, 42)
    sizes = f.groupBy("Class", "fold").count().collect()
    for cls in (0, 1):
        s = [r["count"] for r in sizes if r["Class"] == cls]
        assert len(s) == 5 and max(s) - min(s) <= 1


def test_standardised_train_has_mean_0_and_population_std_1(spark):
    tx = S.transaction_table(spark, SF01)
    sp = T.stratified_split(tx, ["event_id"], "Class", 0.2, 42)
    train = sp.filter("split = 'train'")
    out = T.apply_standardizer(train, T.fit_standardizer(train, ["Time", "Amount"]))
    r = out.agg(F.avg("Time"), F.stddev_pop("Time"), F.avg("Amount"), F.stddev_pop("Amount")).first()
    assert r[0] == pytest.approx(0, abs=1e-9) and r[1] == pytest.approx(1, rel=1e-9)
    assert r[2] == pytest.approx(0, abs=1e-9) and r[3] == pytest.approx(1, rel=1e-9)
    assert out.columns[:2] == ["Time", "Amount"]


def test_constant_column_std_becomes_one(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    p = T.fit_standardizer(df, ["x"]).first()
    assert p["std"] == 1.0 and T.apply_standardizer(df, [p]).first()["x"] == 0.0


def test_dedupe_keeps_every_positive(spark):
    df = spark.createDataFrame([(1, 0), (1, 0), (2, 1), (2, 1), (3, 0)], "a long, Class long")
    out = sorted(tuple(r) for r in T.drop_duplicates_keep_positives(df, "Class").collect())
    assert out == [(1, 0), (2, 1), (2, 1), (3, 0)]


def test_temporal_split_is_earlier_vs_later(spark):
    o = S.load(spark, SF01, "orders")
    sp = T.temporal_split(o, "o_orderdate", 0.2)
    r = sp.groupBy("split").agg(F.min("o_orderdate").alias("mn"), F.max("o_orderdate").alias("mx")).collect()
    d = {x["split"]: x for x in r}
    assert d["train"]["mx"] < d["test"]["mn"]


def test_repeatable_sample_size_and_stability(spark):
    tx = S.transaction_table(spark, SF01)
    a = {r["event_id"] for r in T.repeatable_sample(tx, 100, ["event_id"], 42).collect()}
    b = {r["event_id"] for r in T.repeatable_sample(tx.repartition(5), 100, ["event_id"], 42).collect()}
    assert len(a) == 100 and a == b


def test_folds_reject_k_below_two(spark):
    from raresight.errors import EvaluationError
    with pytest.raises(EvaluationError, match="at least 2"):
        T.stratified_folds(spark.range(5).withColumn("Class", F.lit(0)), ["id"], "Class", 1)
