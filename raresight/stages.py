"""The reference's three stages (validate, preprocess, train) and its threshold study,
as functions over Spark frames and paths in the shared folder.

Each stage reads its inputs, runs the operators, and writes its outputs; nothing is
collected except the one-row reports.  Defaults are the reference's parameters.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from raresight.operators import contracts as V
from raresight.operators import evaluate as E
from raresight.operators import prepare as T
from raresight.operators import train as M
from raresight.sources import files as IO

# fixed values: the reference's parameters
TEST_SIZE = 0.2
RANDOM_STATE = 42
SCALE_COLUMNS = ("Time", "Amount")
TRAIN_PARAMS = {"model": "xgboost", "threshold": 0.03, "resampling": "none", "random_state": 42,
                "n_estimators": 300, "max_depth": 5, "learning_rate": 0.1, "scale_pos_weight": 577.29}
COST_FP, COST_FN, CV_FOLDS = 4.0, 137.0, 5


@dataclass
class StagePaths:
    root: str

    @property
    def validation_report(self) -> str:
        return f"{self.root}/reports/validation"

    @property
    def splits(self) -> str:
        return f"{self.root}/processed/splits"

    @property
    def standardizer(self) -> str:
        return f"{self.root}/processed/standardizer"

    @property
    def metrics_report(self) -> str:
        return f"{self.root}/reports/metrics"

    @property
    def model(self) -> str:
        return f"{self.root}/models/model"


def validate_stage(raw: DataFrame, paths: StagePaths, contract: V.Contract | None = None,
                   label: str = "Class") -> DataFrame:
    """Stage 1: lazy contract (every failure) -> gate -> health report -> JSON."""
    contract = contract or V.raw_transaction_contract()
    V.enforce(raw, contract, "raw")
    report = V.health_report(raw, contract, label)
    IO.write_report(report, paths.validation_report)
    return report


def preprocess_stage(raw: DataFrame, paths: StagePaths, key_cols, label: str = "Class",
                     scale_columns=SCALE_COLUMNS, test_size: float = TEST_SIZE, seed: int = RANDOM_STATE,
                     processed: V.Contract | None = None) -> DataFrame:
    """Stage 2: exact stratified split -> fit the standardiser on train only -> apply to
    both -> processed contract on each split -> one parquet dataset partitioned by split,
    plus the fitted parameter table.  Returns the split summary."""
    split = T.stratified_split(raw, list(key_cols), label, test_size, seed)
    scaled = split
    if scale_columns:  # features such as PCA components may need no scaling at all
        params = T.fit_standardizer(split.filter(F.col("split") == "train"), list(scale_columns))
        T.save_standardizer(params, paths.standardizer)
        scaled = T.apply_standardizer(split, T.load_standardizer(raw.sparkSession, paths.standardizer).collect())
    contract = processed or V.processed_transaction_contract()
    for name in ("train", "test"):
        V.enforce(scaled.filter(F.col("split") == name).drop("split", *key_cols), contract, f"processed {name}")
    IO.write_splits(scaled, paths.splits)
    return T.split_summary(IO.read_split(raw.sparkSession, paths.splits, label), label)


def train_stage(spark: SparkSession, paths: StagePaths, features, params: dict | None = None,
                label: str = "Class", key: str = "vec_id") -> DataFrame:
    """Stage 3: read both splits -> strategy (weights or SMOTE) -> fit -> probability and
    decision at the versioned threshold -> precision, recall, F1, PR-AUC -> JSON report."""
    params = dict(TRAIN_PARAMS if params is None else params)
    train = IO.read_split(spark, paths.splits, label, split="train").drop("split")
    test = IO.read_split(spark, paths.splits, label, split="test").drop("split")
    model = M.fit_model(train, list(features), params, label, key)
    model.write().overwrite().save(paths.model)
    scored = M.score(model, test, float(params["threshold"]))
    sc = scored.select(F.col(label).alias("y"), F.col("fraud_probability").alias("p"))
    report = E.classification_metrics(sc, float(params["threshold"])).select("precision", "recall", "f1") \
        .withColumn("pr_auc", E.average_precision(sc).select("pr_auc").scalar())  # one-row report
    IO.write_report(report, paths.metrics_report)
    return report


def threshold_stage(scored: DataFrame, cost_fp: float = COST_FP, cost_fn: float = COST_FN,
                    label: str = "y", score: str = "p") -> DataFrame:
    """The threshold study: F1-optimal and cost-optimal thresholds and the operating
    points at both and at 0.5, one table."""
    f1 = E.f1_optimal_threshold(scored, label, score).first()
    cost = E.cost_optimal_threshold(scored, cost_fp, cost_fn, label, score).first()
    pts = [0.5] + [x for x in (f1["threshold"], cost["threshold"]) if x is not None]
    return E.operating_points(scored, pts, cost_fp, cost_fn, label, score)
