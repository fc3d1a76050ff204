"""Preparation (T1-T11): projection, exact stratified split and folds, leak-free
standardisation, split summary, duplicate policy, derived features, temporal split,
repeatable sample."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from raresight.errors import EvaluationError
from raresight.functions import hash_hex, hour_of_day, micros_between, null_safe_join
from raresight.plans import exact_quantiles, hash_rank_cutoffs
from raresight.session import stored


# T1 -------------------------------------------------------------------------
def features_and_target(df: DataFrame, label: str = "Class", key_cols=()) -> tuple[DataFrame, DataFrame]:
    """Drop the target from the features and keep it apart; the key keeps them aligned."""
    key_cols = list(key_cols)
    feats = [c for c in df.columns if c != label]
    return df.select(*feats), df.select(*key_cols, label)


# T2 -------------------------------------------------------------------------
def stratified_split(df: DataFrame, key_cols, label: str = "Class", test_size: float = 0.2, seed: int = 42,
                     split_col: str = "split") -> DataFrame:
    """Exact stratified split: per class, the floor(n_c * test_size) rows with the
    smallest ``md5(seed|key)`` go to test.  Same rows every run, on any partitioning; a null
    class is a class.  ``key_cols`` must tell rows apart: equal keys that straddle a cut-off
    fail the job.

    The per-class cut-off comes from the hash-prefix plan (no global sort).  The cut-offs are
    stored once (one row per class), and the join to the rows is sized by what is stored.
    """
    if not 0.0 < test_size < 1.0:
        raise ValueError(f"test_size must be in (0, 1), got {test_size}")
    withh = df.withColumn("_h", hash_hex(seed, *key_cols))
    hashes = stored(withh.select(label, "_h"), "row-hashes")  # the rows are hashed once for the cut-offs, whatever the key
    cut = stored(hash_rank_cutoffs(hashes, "_h", [test_size], [label]).select(label, F.col("cutoff").alias("_cut")), "split-cutoffs")
    out = null_safe_join(withh, cut, [label], "left")
    is_test = F.col("_cut").isNotNull() & (F.col("_h") <= F.col("_cut"))
    return out.withColumn(split_col, F.when(is_test, F.lit("test")).otherwise(F.lit("train"))) \
        .select(*df.columns, split_col)


def stratified_folds(df: DataFrame, key_cols, label: str = "Class", k: int = 5, seed: int = 42,
                     fold_col: str = "fold") -> DataFrame:
    """Stratified k folds: per class, hash rank r (0-based) goes to fold f with
    floor(n_c*f/k) <= r < floor(n_c*(f+1)/k), so class ratios hold in every fold."""
    if k < 2:
        raise EvaluationError(f"k must be at least 2, got {k}")
    withh = df.withColumn("_h", hash_hex(seed, *key_cols))
    fr = [j / k for j in range(1, k)]
    cut = hash_rank_cutoffs(stored(withh.select(label, "_h"), "row-hashes"), "_h", fr, [label],
                            ranks_from_counts=lambda tot, j: F.floor(tot * (j + 1) / F.lit(k)))
    cuts = cut.groupBy(label).agg(F.collect_list("cutoff").alias("_cuts"))  # <= k-1 per class
    out = null_safe_join(withh, stored(cuts, "fold-cutoffs"), [label], "left")
    # fold = number of cut-offs at or below the row's rank; a class too small to reach a
    # cut-off (need 0) has no row for it, so count the cut-offs *above* the hash instead.
    above = F.size(F.filter(F.coalesce(F.col("_cuts"), F.array().cast("array<string>")),
                            lambda c: c >= F.col("_h")))
    fold = F.lit(k - 1) - above
    return out.withColumn(fold_col, fold.cast("int")).select(*df.columns, fold_col)


# T3 / T4 / T5 ---------------------------------------------------------------
def fit_standardizer(train: DataFrame, cols) -> DataFrame:
    """Mean and *population* std per column, on the rows given (train only).
    A zero std becomes 1 (the column is then only centred)."""
    cols = list(cols)
    agg = train.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                    *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)])
    args = ", ".join(f"'{c}', m{i}, s{i}" for i, c in enumerate(cols))
    long = agg.selectExpr(f"stack({len(cols)}, {args}) AS (column, mean, std)")
    return long.withColumn("std", F.when(F.col("std") == 0, F.lit(1.0)).otherwise(F.col("std")))


def apply_standardizer(df: DataFrame, params: DataFrame | list) -> DataFrame:
    """(x - mean) / std for the fitted columns (scaled columns first, the rest unchanged).

    The fitted params are a handful of numbers: they are fetched once and projected
    as literals, so the transform is a narrow, codegen'd projection that works on
    batch and streaming frames alike and never refits.
    """
    rows = params.collect() if isinstance(params, DataFrame) else params
    fitted = {r["column"]: (float(r["mean"]), float(r["std"])) for r in rows}
    cols = [c for c in fitted if c in df.columns]
    scaled = [((F.col(c) - F.lit(fitted[c][0])) / F.lit(fitted[c][1])).alias(c) for c in cols]
    return df.select(*scaled, *[c for c in df.columns if c not in fitted])


def save_standardizer(params: DataFrame, path: str) -> str:
    params.coalesce(1).write.mode("overwrite").parquet(path)
    return path


def load_standardizer(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


# T6 -------------------------------------------------------------------------
def split_summary(df: DataFrame, label: str = "Class", split_col: str = "split") -> DataFrame:
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n_rows"),
                                     F.sum(F.col(label).cast("long")).alias("n_pos"),
                                     (F.avg(F.col(label).cast("double")) * 100).alias("pos_rate_pct"))


# T7 -------------------------------------------------------------------------
def drop_duplicates_keep_positives(df: DataFrame, label: str = "Class") -> DataFrame:
    """Exact duplicates of negatives collapse to one row; every positive row is kept.

    Positives pass through untouched (no shuffle); negatives go through
    ``dropDuplicates``, a partial (map-side) aggregate, so even a group of identical
    rows holding a third of the table is collapsed before the shuffle.
    """
    pos = df.filter(F.col(label) == 1)
    neg = df.filter(~(F.col(label) == 1) | F.col(label).isNull()).dropDuplicates()
    return pos.unionByName(neg)


# T8 / T9 --------------------------------------------------------------------
def add_cyclical_hour(df: DataFrame, time_col: str = "Time", prefix: str = "hour") -> DataFrame:
    h = hour_of_day(time_col).cast("double")
    ang = F.lit(2 * math.pi) * h / F.lit(24.0)
    return df.withColumn(f"{prefix}_sin", F.sin(ang)).withColumn(f"{prefix}_cos", F.cos(ang))


def add_log_amount(df: DataFrame, col: str = "Amount", out: str | None = None) -> DataFrame:
    return df.withColumn(out or f"log_{col}", F.log1p(F.col(col)))


# T10 ------------------------------------------------------------------------
def temporal_split(df: DataFrame, time_col: str, test_size: float = 0.2, split_col: str = "split",
                   accuracy: int = 10000) -> DataFrame:
    """Train on the earlier ``1 - test_size`` of time, test on the rest.

    The cut is the exact ``1 - test_size`` quantile (linear interpolation) of the time
    column, found with the bracketed exact-quantile plan; rows at or after it are test.
    Timestamps are compared as epoch microseconds of their wall-clock value.  A null time
    fails the job (it has no place in time).
    """
    t = F.col(time_col)
    dtype = dict(df.dtypes)[time_col]
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    num = micros_between(epoch, t).cast("double") if dtype.startswith("timestamp") else t.cast("double")
    withnum = df.withColumn("_t", F.when(t.isNull(), F.raise_error(F.lit(f"time column {time_col} holds null")).cast("double")).otherwise(num))
    cut = exact_quantiles(withnum, "_t", [1.0 - test_size]).select("value").scalar()  # scalar subquery
    return withnum.withColumn(split_col, F.when(F.col("_t") >= cut, "test").otherwise("train")) \
        .select(*df.columns, split_col)


# T11 ------------------------------------------------------------------------
def repeatable_sample(df: DataFrame, n: int, key_cols, seed: int = 42) -> DataFrame:
    """The n rows with the smallest ``md5(seed|key)``: a TakeOrdered of n rows per task,
    merged once — the limit is the feature (a fixed-size reference sample)."""
    return df.withColumn("_h", hash_hex(seed, *key_cols)).orderBy("_h").limit(n).drop("_h")
