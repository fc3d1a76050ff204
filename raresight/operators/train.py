"""Imbalance handling and training (M1-M9) with Spark ML.

Class weights and the positive weight are columns joined from per-class counts;
SMOTE synthesises minority rows from exact minority neighbours (blocked kNN plan),
with hash-derived randomness so the same rows come out on any partitioning.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raresight.errors import ModelConfigError
from raresight.functions import hash_hex, hash_uniform
from raresight.operators import evaluate as E
from raresight.operators import prepare as T
from raresight.plans import BoostedTrees, LogisticFit, boosted_trees, exact_knn, hash_rank, newton_logistic
from raresight.session import checkpoint_dir, stored

REQUIRED = {
    "logistic_regression": ("max_iter", "random_state"),
    "xgboost": ("n_estimators", "max_depth", "learning_rate", "scale_pos_weight", "random_state"),
}
ALIASES = {"gbt": "xgboost"}
STRATEGIES = ("none", "smote")


# M1 / M2 -------------------------------------------------------------------------
def with_balanced_weights(df: DataFrame, label: str = "Class", weight_col: str = "weight") -> DataFrame:
    """weight of class c = n / (n_classes * n_c), all from one count per class (stored, so the join is sized by it)."""
    counts = stored(df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc")), "class-counts")
    total = counts.select(F.struct(F.sum("_nc").alias("n"), F.count(label).alias("k"))).scalar()
    w = counts.select(label, (total["n"] / (total["k"] * F.col("_nc"))).alias(weight_col))
    return df.join(w, label, "left")


def positive_weight_value(df: DataFrame, label: str = "Class"):
    """negatives / positives as a scalar-subquery column (e.g. 227,451 / 394 = 577.29 in the reference)."""
    r = df.select((F.count_if(F.col(label) != 1) / F.nullif(F.count_if(F.col(label) == 1), F.lit(0))))
    return r.scalar()


def with_positive_weight(df: DataFrame, label: str = "Class", weight: float | None = None,
                         weight_col: str = "weight") -> DataFrame:
    w = F.lit(float(weight)) if weight is not None else positive_weight_value(df, label)
    return df.withColumn(weight_col, F.when(F.col(label) == 1, w).otherwise(F.lit(1.0)))


# M5 --------------------------------------------------------------------------
def smote(df: DataFrame, features, label: str = "Class", key: str = "vec_id", k: int = 5, seed: int = 42,
          block_size: int = 2048, flag_col: str = "synthetic") -> DataFrame:
    """Oversample the positive class to the size of the negative class.

    Each synthetic row lies on the segment from a positive row x to one of its k
    nearest positive neighbours: x + u * (nn - x).  The n_neg - n_pos new rows are
    spread evenly over the positives (by hash rank); neighbour choice and u come from
    seeded hashes.  Output: the input rows plus the synthetic ones (key null,
    ``synthetic`` true).  Training rows only — never call it on test data.  More than k
    positives are needed; fewer raise, as the resampling asked for can't be done.
    """
    features = list(features)
    cnt = df.agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) != 1).alias("n")).first()
    n_pos, n_neg = int(cnt["p"]), int(cnt["n"])
    orig = df.withColumn(flag_col, F.lit(False))
    n_new = n_neg - n_pos
    if n_pos <= k:
        raise ModelConfigError(f"smote with k={k} needs more than {k} positive rows, got {n_pos}")
    if n_new <= 0:
        return orig
    kk = k
    pos = df.filter(F.col(label) == 1)
    nn = exact_knn(pos, key, features, kk, block_size, seed)
    ranked = hash_rank(pos.select(key, hash_hex(seed, key).alias("_h")), "_h")
    per, extra = divmod(n_new, n_pos)
    alloc = ranked.select(key, (F.lit(per) + F.when(F.col("rank") < extra, 1).otherwise(0)).alias("_c")) \
        .filter(F.col("_c") > 0)
    # A positive may own millions of new rows (few positives, many negatives): cut each
    # allocation into chunks of at most `chunk` rows and spread the chunks over tasks
    # before expanding them, so no single task generates one positive's whole share.
    chunk = 100_000
    chunks = alloc.select(key, "_c", F.explode(F.sequence(F.lit(0), F.floor((F.col("_c") - 1) / chunk).cast("int")))
                          .alias("_ci"))
    chunks = chunks.select(key, (F.col("_ci") * chunk + 1).alias("_lo"),
                           F.least(F.col("_c"), F.col("_ci") * chunk + chunk).alias("_hi"))
    n_chunks = max(1, -(-n_new // chunk))
    # a chunk row carries its point and its k neighbours, so the new rows are made where the chunk is: no join per new row
    vector = F.array(*[F.col(c).cast("double") for c in features])
    ends = pos.select(F.col(key).alias(f"nn_{key}"), vector.alias("_n"))
    near = nn.select(key, "j", f"nn_{key}").join(ends, f"nn_{key}").groupBy(key).agg(F.array_sort(F.collect_list(F.struct("j", "_n"))).alias("_near"))  # k entries
    whole = chunks.join(near, key).join(pos.select(key, vector.alias("_x")), key)
    whole = whole.repartition(min(n_chunks, df.sparkSession.sparkContext.defaultParallelism * 4), key, "_lo")
    samples = whole.select(key, "_x", "_near", F.explode(F.sequence(F.col("_lo"), F.col("_hi"))).alias("_s"))
    samples = samples.select(
        "_x", F.col("_near")[F.floor(hash_uniform(seed, F.lit("nn"), F.col(key), F.col("_s")) * kk).cast("int")]["_n"].alias("_n"),
        hash_uniform(seed, F.lit("gap"), F.col(key), F.col("_s")).alias("_u"))
    syn_rows = samples.select(*[(F.col("_x")[i] + F.col("_u") * (F.col("_n")[i] - F.col("_x")[i])).alias(c) for i, c in enumerate(features)])
    syn_rows = syn_rows.withColumn(label, F.lit(1).cast(dict(df.dtypes)[label])).withColumn(flag_col, F.lit(True))
    for c in df.columns:
        if c not in syn_rows.columns:
            syn_rows = syn_rows.withColumn(c, F.lit(None).cast(dict(df.dtypes)[c]))
    return orig.unionByName(syn_rows.select(*orig.columns))


# M7 --------------------------------------------------------------------------
def check_params(params: dict) -> tuple[str, dict]:
    name = params.get("model")
    name = ALIASES.get(name, name)
    if name not in REQUIRED:
        raise ModelConfigError(f"Unsupported model: {params.get('model')!r}")
    for h in REQUIRED[name]:
        if h not in params:
            raise ModelConfigError(f"Missing required hyperparameter for {name}: {h!r}")
    return name, params


def build_model(params: dict, label: str = "Class", features_col: str = "features",
                weight_col: str | None = None, reg_param: float = 0.0):
    """Spark ML estimator for ``logistic_regression`` (L2, C=1 -> regParam = 1/(C * sum of
    weights), no internal standardisation) or boosted trees (``xgboost``/``gbt`` ->
    GBTClassifier: same family, not the same numbers)."""
    name, p = check_params(params)
    seed = int(p["random_state"])
    if name == "logistic_regression":
        est = LogisticRegression(featuresCol=features_col, labelCol=label, maxIter=int(p["max_iter"]),
                                 regParam=reg_param, elasticNetParam=0.0, standardization=False, tol=1e-6)
    else:
        est = GBTClassifier(featuresCol=features_col, labelCol=label, maxIter=int(p["n_estimators"]),
                            maxDepth=int(p["max_depth"]), stepSize=float(p["learning_rate"]), seed=seed)
    if weight_col:
        est.setWeightCol(weight_col)
    return est


# M6 --------------------------------------------------------------------------
def training_frame(train: DataFrame, params: dict, features, label: str = "Class", key: str = "vec_id",
                   weight_col: str = "weight") -> tuple[DataFrame, str | None]:
    """One strategy per run: ``none`` -> class weights (balanced for logistic regression,
    positive weight for boosted trees); ``smote`` -> resampled frame and no weights
    (so the imbalance is never corrected twice)."""
    name, p = check_params(params)
    strategy = p.get("resampling")
    if strategy is None:
        raise ModelConfigError("Missing required param: resampling (one of none, smote)")
    if strategy not in STRATEGIES:
        raise ModelConfigError(f"Unsupported resampling {strategy!r}: choose one of {STRATEGIES}")
    if strategy == "smote":
        # the resampled frame has a long lineage (kNN cogroup, allocation, joins) and is read
        # by the fit's passes: cut it with a reliable checkpoint in the shared folder
        checkpoint_dir(train.sparkSession)
        return smote(train, features, label, key, seed=int(p["random_state"])).checkpoint(eager=True), None
    if name == "logistic_regression":
        return with_balanced_weights(train, label, weight_col), weight_col
    return with_positive_weight(train, label, p.get("scale_pos_weight"), weight_col), weight_col


# M3 / M4 ------------------------------------------------------------------------
def fit_model(train: DataFrame, features, params: dict, label: str = "Class", key: str = "vec_id") -> PipelineModel:
    features = list(features)
    frame, wcol = training_frame(train, params, features, label, key)
    frame = frame.withColumn(label, F.col(label).cast("double"))
    reg = 0.0
    name, _ = check_params(params)
    if name == "logistic_regression":
        c = float(params.get("C", 1.0))
        sw = frame.select(F.sum(F.col(wcol)) if wcol else F.count(F.lit(1))).first()[0]
        reg = 1.0 / (c * float(sw))
    est = build_model(params, label, "features", wcol, reg)
    pipe = Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features", handleInvalid="error"), est])
    return pipe.fit(frame)


def fit_logistic(train: DataFrame, features, params: dict, label: str = "Class", key: str = "vec_id", scale_cols=()) -> LogisticFit:
    """M3 by Newton steps: the exact optimum of the same objective (L2, C, balanced weights or SMOTE) as ``fit_model``'s."""
    name, p = check_params(params)
    if name != "logistic_regression":
        raise ModelConfigError(f"fit_logistic fits logistic regression, not {name!r}")
    frame, wcol = training_frame(train, params, features, label, key)
    narrow = stored(frame.select(*features, label, *([wcol] if wcol else [])), "newton-rows")  # read once a step
    return newton_logistic(narrow, features, label, c=float(p.get("C", 1.0)), balanced=False, weight=wcol, scale=scale_cols, max_iter=int(p["max_iter"]))[0]


def fit_boosted_trees(train: DataFrame, features, params: dict, label: str = "Class", key: str = "vec_id", bins: int | None = 256) -> BoostedTrees:
    """M4 from gradient histograms: second-order boosting with the reference's trees, depth, rate and positive weight."""
    name, p = check_params(params)
    if name != "xgboost":
        raise ModelConfigError(f"fit_boosted_trees fits boosted trees, not {name!r}")
    frame, wcol = training_frame(train, params, features, label, key)
    return boosted_trees(frame, features, label, wcol, int(p["n_estimators"]), int(p["max_depth"]), float(p["learning_rate"]), bins=bins)


# M8 / D1 ------------------------------------------------------------------------
def score(model: PipelineModel | LogisticFit | BoostedTrees, df: DataFrame, threshold: float, prob_col: str = "fraud_probability",
          decision_col: str = "is_fraud") -> DataFrame:
    """Positive-class probability and the decision ``p >= threshold`` (inclusive).  ``model`` is a pipeline, a
    ``LogisticFit`` (one projection) or ``BoostedTrees``."""
    keep = [c for c in df.columns]
    if isinstance(model, LogisticFit):
        out, p = df, model.probability()
    elif isinstance(model, BoostedTrees):
        out, p = model.score(df, "_p"), F.col("_p")
    else:
        out, p = model.transform(df), vector_to_array(F.col("probability"))[1]
    return out.select(*keep, p.alias(prob_col), (p >= F.lit(float(threshold))).cast("int").alias(decision_col))


def raw_to_decision(raw: DataFrame, scaler_params, model: PipelineModel | LogisticFit | BoostedTrees, threshold: float) -> DataFrame:
    """D1: raw rows -> fitted standardiser -> probability -> decision; batch or stream."""
    return score(model, T.apply_standardizer(raw, scaler_params), threshold)


# M9 --------------------------------------------------------------------------
def cross_validated_scores(df: DataFrame, features, params: dict, label: str = "Class", key: str = "vec_id",
                           k: int = 5, seed: int = 42, scale_cols=()) -> DataFrame:
    """(key, label, fold, p): every row scored by the model that was trained without its fold.

    Logistic regression with class weights: all k models are fitted together (one pass a step) and all rows scored in
    one projection.  Other models and SMOTE are refitted fold by fold; scaling and resampling stay inside the fold's
    training part either way."""
    features = list(features)
    # the folds are read by every step or fit: stored once in the shared folder
    folds = stored(T.stratified_folds(df, [key], label, k, seed).select(key, label, "fold", *features), "cv-folds")
    name, p = check_params(params)
    if name == "logistic_regression" and p.get("resampling") == "none":
        fits = newton_logistic(folds, features, label, "fold", k, float(p.get("C", 1.0)), scale=scale_cols, max_iter=int(p["max_iter"]))
        prob = F.lit(None).cast("double")
        for f, fit in enumerate(fits):
            prob = F.when(F.col("fold") == f, fit.probability()).otherwise(prob)
        return folds.select(key, label, "fold", prob.alias("p"))
    out = None
    for f in range(k):
        tr, te = folds.filter(F.col("fold") != f), folds.filter(F.col("fold") == f)
        if scale_cols:
            prm = T.fit_standardizer(tr, scale_cols).collect()
            tr, te = T.apply_standardizer(tr, prm), T.apply_standardizer(te, prm)
        scored = score(fit_model(tr.drop("fold"), features, params, label, key), te, 0.5).select(key, label, "fold", F.col("fraud_probability").alias("p"))
        out = scored if out is None else out.unionByName(scored)
    return out


def cross_validate_pr_auc(df: DataFrame, features, params: dict, label: str = "Class", key: str = "vec_id",
                          k: int = 5, seed: int = 42, scale_cols=(), digits: int | None = None) -> DataFrame:
    """Stratified k-fold PR-AUC: one row per fold, with the mean and the population std of all folds.  ``digits``
    rounds the scores first, so that sums in another order make no other ties."""
    scored = cross_validated_scores(df, features, params, label, key, k, seed, scale_cols)
    p = F.round("p", digits) if digits else F.col("p")
    ap = stored(E.average_precision(scored.select("fold", F.col(label).alias("y"), p.alias("p")), by=["fold"]), "cv-scores")  # k rows
    of_all = ap.select(F.struct(F.avg("pr_auc").alias("mean"), F.stddev_pop("pr_auc").alias("std"))).scalar()
    return ap.select("fold", "pr_auc", of_all["mean"].alias("mean_pr_auc"), of_all["std"].alias("std_pr_auc"))
