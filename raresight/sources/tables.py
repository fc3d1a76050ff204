"""Readers for the given parquet tables and the stand-in views built on them.

The reference works on one card-transaction table (Time, V1..V28, Amount, Class).
It is not available here, so the operators run on stand-ins derived by Spark from
the given tables:

* transactions = ``events``: Time = seconds since ``min(ts)``, Amount = ``value``,
  Class = ``event_type = 'error'``, key ``event_id``;
* features = ``embeddings``: V1..V64 = its elements, Class = ``label = 0``, key ``vec_id``;
* returns = ``lineitem``: Class = ``l_returnflag = 'R'``; it has no key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from raresight.functions import label_flag, seconds_between

V_COLUMNS = [f"V{i}" for i in range(1, 29)]  # the card table's features
E_COLUMNS = [f"V{i}" for i in range(1, 65)]  # the stand-in's: every element of an embedding


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def transaction_table(spark: SparkSession, sf_dir: str, keep_ts: bool = False, extra=()) -> DataFrame:
    """``events`` as a transaction table: (event_id, Time, Amount, Class[, ts]).

    ``min(ts)`` is a scalar subquery (one tiny aggregate job), not a driver round trip.
    """
    ev = load(spark, sf_dir, "events")
    first = ev.select(F.min("ts")).scalar()
    cols = [
        F.col("event_id"),
        seconds_between(first, F.col("ts")).alias("Time"),
        F.col("value").alias("Amount"),
        label_flag(F.col("event_type") == "error").alias("Class"),
    ]
    if keep_ts:
        cols.append(F.col("ts"))
    cols += [F.col(c) for c in extra]
    return ev.select(*cols)


def thin_positives(df: DataFrame, key: str, label: str = "Class", below: str = "01") -> DataFrame:
    """Extreme imbalance from a milder table: keep a positive only when ``md5(key) < below``
    (about 1/256 of them for '01'), deterministically and identically in SQL."""
    keep = F.md5(F.col(key).cast("string")) < F.lit(below)
    return df.withColumn(label, label_flag((F.col(label) == 1) & keep))


def feature_table(spark: SparkSession, sf_dir: str, n_features: int = len(E_COLUMNS)) -> DataFrame:
    """``embeddings`` as a PCA-feature table: (vec_id, V1..Vn, Class)."""
    emb = load(spark, sf_dir, "embeddings")
    return emb.select(
        "vec_id",
        *[F.col("embedding")[i].cast("double").alias(f"V{i + 1}") for i in range(n_features)],
        label_flag(F.col("label") == 0).alias("Class"),
    )


def returns_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` with Class = returned (``l_returnflag = 'R'``)."""
    li = load(spark, sf_dir, "lineitem")
    return li.withColumn("Class", label_flag(F.col("l_returnflag") == "R"))


# Stand-in models: deterministic scores in [0, 1] built from table columns, so the
# evaluation operators can be checked against SQL without a trained model.
# name -> (column expression text, as used by both Spark and the SQL oracle)
SCORE_MODELS = {
    "discount": "l_discount * 10.0",
    "tax": "l_tax / 0.08",
    "quantity": "l_quantity / 50.0",
}


def scored_models(spark: SparkSession, sf_dir: str, models=None) -> DataFrame:
    """lineitem scored by several stand-in models, long form: (model_id, y, p).

    One scan, one narrow Expand per model (``unpivot``), no union of scans.
    """
    models = models or list(SCORE_MODELS)
    li = returns_table(spark, sf_dir)
    wide = li.select(F.col("Class").alias("y"),
                     *[F.expr(SCORE_MODELS[m]).cast("double").alias(m) for m in models])
    return wide.unpivot(["y"], models, "model_id", "p")
