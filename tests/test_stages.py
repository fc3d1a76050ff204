"""End-to-end stages on the stand-in tables: validate -> preprocess -> train, and the threshold study."""

from pyspark.sql import functions as F

from conftest import SF01
from raresight import stages as ST
from raresight.operators import contracts as V
from raresight.session import scratch_path
from raresight.sources import tables as S


def test_validate_and_preprocess_stages(spark):
    paths = ST.StagePaths(scratch_path(spark, "stages"))
    tx = S.transaction_table(spark, SF01)
    rep = ST.validate_stage(tx.drop("event_id"), paths, V.raw_transaction_contract(features=())).first()
    assert rep["status"] == "passed" and rep["n_rows"] == 10000
    summ = {r["split"]: r for r in ST.preprocess_stage(
        tx, paths, ["event_id"], processed=V.Contract("p", (V.Rule("Time"), V.Rule("Amount"),
                                                            V.Rule("Class", "bigint", isin=(0, 1))), strict=False)
    ).collect()}
    assert summ["train"]["n_rows"] + summ["test"]["n_rows"] == 10000
    assert abs(summ["train"]["pos_rate_pct"] - summ["test"]["pos_rate_pct"]) < 0.1
    train = spark.read.parquet(paths.splits).filter("split = 'train'")
    m = train.agg(F.avg("Amount"), F.stddev_pop("Amount")).first()
    assert abs(m[0]) < 1e-9 and abs(m[1] - 1) < 1e-9


def test_train_stage_and_threshold_study(spark):
    paths = ST.StagePaths(scratch_path(spark, "stages-train"))
    feat = S.feature_table(spark, SF01, n_features=8)
    cols = [f"V{i}" for i in range(1, 9)]
    ST.preprocess_stage(feat, paths, ["vec_id"], scale_columns=(),
                        processed=V.Contract("p", tuple(V.Rule(c) for c in cols), strict=False))
    params = {"model": "logistic_regression", "max_iter": 100, "threshold": 0.5, "resampling": "smote",
              "random_state": 42}
    rep = ST.train_stage(spark, paths, cols, params, "Class", "vec_id").first()
    assert 0.0 <= rep["pr_auc"] <= 1.0 and 0.0 <= rep["recall"] <= 1.0
    assert spark.read.json(paths.metrics_report).count() == 1
    scored = feat.select(F.col("Class").alias("y"), (F.col("V1") - F.col("V2")).alias("p"))
    study = ST.threshold_stage(scored.withColumn("p", F.least(F.greatest(F.col("p") + 0.5, F.lit(0.0)), F.lit(1.0))))
    assert study.count() >= 2
