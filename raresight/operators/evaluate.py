"""Evaluation operators (E1-E12) on a scored frame ``(y, p)`` with optional group columns.

Everything is an aggregate over the scored rows; the only ordered computations
(PR curve, average precision, ROC-AUC) run over *distinct scores* through the
bucketed running-sum plan, never a single-task global window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from raresight.errors import EvaluationError
from raresight.functions import linspace_value, null_safe_join, safe_div
from raresight.plans import cumulative_by_value

F1_EPS = 1e-9


def _pos(label: str):
    return F.col(label) == 1


def checked(scored: DataFrame, label: str = "y", score: str = "p") -> DataFrame:
    """The one rule for bad input, before every operator: a null or NaN score and a null label fail the job by
    name.  Group keys may be null; null is a group of its own."""
    bad_score = F.col(score).isNull() | F.isnan(F.col(score).cast("double"))
    return scored.withColumns({
        score: F.when(bad_score, F.raise_error(F.lit(f"score column {score} holds null or NaN")).cast("double")).otherwise(F.col(score)),
        label: F.when(F.col(label).isNull(), F.raise_error(F.lit(f"label column {label} holds null")).cast("double")).otherwise(F.col(label))})


# E1 ------------------------------------------------------------------------
def confusion_counts(scored: DataFrame, threshold: float, label: str = "y", score: str = "p",
                     by: Sequence[str] = ()) -> DataFrame:
    """TP, FP, FN, TN at ``p >= threshold`` (inclusive), one aggregate pass."""
    scored = checked(scored, label, score)
    pred = F.col(score) >= F.lit(float(threshold))
    pos = _pos(label)
    return scored.groupBy(*by).agg(
        F.count_if(pred & pos).alias("tp"), F.count_if(pred & ~pos).alias("fp"),
        F.count_if(~pred & pos).alias("fn"), F.count_if(~pred & ~pos).alias("tn"))


# E2 ------------------------------------------------------------------------
def with_rates(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 from tp/fp/fn; an undefined value is 0."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select(
        "*", safe_div(tp, tp + fp).alias("precision"), safe_div(tp, tp + fn).alias("recall"),
        safe_div(2 * tp, 2 * tp + fp + fn).alias("f1"))


def classification_metrics(scored: DataFrame, threshold: float, label="y", score="p", by=()) -> DataFrame:
    return with_rates(confusion_counts(scored, threshold, label, score, by))


# curve shared by E3, E4, E5, E8, E12 -----------------------------------------
def score_curve(scored: DataFrame, label: str = "y", score: str = "p", by: Sequence[str] = ()) -> DataFrame:
    """One row per (group, distinct score): n_pos, n_neg at that score, tps/fps = positives /
    negatives scored at or above it, and the group totals P, N."""
    by = list(by)
    scored = checked(scored, label, score)
    pos = _pos(label)
    distinct = scored.groupBy(*by, F.col(score).cast("double").alias("threshold")).agg(
        F.count_if(pos).alias("n_pos"), F.count_if(~pos).alias("n_neg"))
    cum = cumulative_by_value(distinct, "threshold", ["n_pos", "n_neg"], by, descending=True)
    cols = [*by, "threshold", "n_pos", "n_neg", F.col("cum_n_pos").alias("tps"), F.col("cum_n_neg").alias("fps")]
    # group totals: an aggregate joined back (one row per group), never a window over all scores
    if by:
        totals = scored.groupBy(*by).agg(F.count_if(pos).alias("P"), F.count_if(~pos).alias("N"))
        return null_safe_join(cum.select(*cols), totals, by)
    totals = scored.agg(F.count_if(pos).alias("P"), F.count_if(~pos).alias("N"))
    return cum.select(*cols, totals.select("P").scalar().alias("P"), totals.select("N").scalar().alias("N"))


def _curve_precision_recall(curve: DataFrame) -> DataFrame:
    return curve.withColumn("precision", F.col("tps") / (F.col("tps") + F.col("fps"))) \
        .withColumn("recall", F.when(F.col("P") == 0, F.lit(1.0)).otherwise(F.col("tps") / F.col("P")))


# E3 ------------------------------------------------------------------------
def average_precision(scored: DataFrame, label="y", score="p", by=(), curve: DataFrame | None = None) -> DataFrame:
    """Step-wise area under the PR curve: sum over distinct scores (descending) of
    (R_i - R_{i-1}) * P_i; tied scores are one step.  No positives -> 0.0."""
    curve = curve if curve is not None else score_curve(scored, label, score, by)
    return curve.groupBy(*by).agg(
        F.coalesce(F.sum(F.col("n_pos") * (F.col("tps") / (F.col("tps") + F.col("fps"))))
                   / F.nullif(F.max("P"), F.lit(0)), F.lit(0.0)).alias("pr_auc"))


# E4 ------------------------------------------------------------------------
def pr_curve(scored: DataFrame, label="y", score="p", by=(), curve: DataFrame | None = None) -> DataFrame:
    """(threshold, precision, recall) per distinct score, plus the end point
    (threshold null, precision 1, recall 0) once per group."""
    by = list(by)
    curve = curve if curve is not None else score_curve(scored, label, score, by)
    pts = _curve_precision_recall(curve).select(*by, "threshold", "precision", "recall")
    ends = curve.select(*by).distinct().select(
        *by, F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"))
    return pts.unionByName(ends)


# E5 ------------------------------------------------------------------------
def f1_optimal_threshold(scored: DataFrame, label="y", score="p", by=(), curve: DataFrame | None = None) -> DataFrame:
    """Arg max of 2PR/(P+R+1e-9) over the curve points (end point excluded); ties
    go to the lowest threshold.  A per-group aggregate, not a global sort."""
    curve = curve if curve is not None else score_curve(scored, label, score, by)
    pts = _curve_precision_recall(curve).withColumn(
        "f1", 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + F.lit(F1_EPS)))
    best = F.min_by(F.struct("threshold", "f1"), F.struct((-F.col("f1")).alias("k1"), F.col("threshold").alias("k2")))
    return pts.groupBy(*by).agg(best.alias("_b")).select(*by, "_b.threshold", "_b.f1")


# E6 / E7 ----------------------------------------------------------------------
def _check_costs(cost_fp: float, cost_fn: float) -> None:
    if cost_fp <= 0 or cost_fn <= 0:
        raise EvaluationError(f"both error costs must be positive (false positive {cost_fp}, false negative {cost_fn})")


def _sweep(scored: DataFrame, k_expr, n_thr: int, threshold_of, label: str, score: str, by: list[str]) -> DataFrame:
    """Shared threshold sweep: each row falls in bucket k = number of thresholds <= p
    (so it is predicted positive at thresholds 0..k-1).  One aggregate to
    (group, k) counts, then running sums over at most n_thr+1 rows per group."""
    scored = checked(scored, label, score)
    pos = _pos(label)
    counts = scored.groupBy(*by, k_expr.alias("k")).agg(
        F.count_if(pos).alias("n_pos"), F.count_if(~pos).alias("n_neg"))
    totals = counts.groupBy(*by).agg(F.sum("n_pos").alias("P"), F.sum("n_neg").alias("N"))
    grid = totals.select(*by, "P", "N", F.explode(F.sequence(F.lit(0), F.lit(n_thr - 1))).alias("i"))
    dense = null_safe_join(grid, counts.withColumnRenamed("k", "i"), [*by, "i"], "left").fillna(0, ["n_pos", "n_neg"])
    w = Window.partitionBy(*by).orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    # bucket i holds rows with exactly i thresholds <= p: below threshold i -> negative prediction
    swept = dense.select(*by, "i", "P", "N",
                         F.sum("n_pos").over(w).alias("fn"), F.sum("n_neg").over(w).alias("tn"))
    return swept.select(*by, "i", threshold_of(F.col("i")).alias("threshold"),
                        (F.col("P") - F.col("fn")).alias("tp"), (F.col("N") - F.col("tn")).alias("fp"),
                        "fn", "tn")


def linspace_bucket(p, start: float, stop: float, num: int):
    """Number of ``linspace(start, stop, num)`` values <= p, computed arithmetically then
    corrected by comparing with the exact grid values (so float edges agree with numpy)."""
    step = (stop - start) / (num - 1)
    guess = F.least(F.greatest(F.floor((p - F.lit(start)) / F.lit(step)) + 1, F.lit(0)), F.lit(num)).cast("int")
    t_at = lambda i: linspace_value(i, start, stop, num)
    up = F.when((guess < num) & (t_at(guess) <= p), guess + 1).otherwise(guess)
    return F.when((up > 0) & (t_at(up - 1) > p), up - 1).otherwise(up)


def cost_curve(scored: DataFrame, cost_fp: float, cost_fn: float, label="y", score="p", by=(),
               start: float = 0.01, stop: float = 0.99, num: int = 99) -> DataFrame:
    """FP, FN and cost at every candidate of ``linspace(start, stop, num)``: one pass over
    the rows instead of one pass per candidate."""
    _check_costs(cost_fp, cost_fn)
    by = list(by)
    k = linspace_bucket(F.col(score).cast("double"), start, stop, num)
    swept = _sweep(scored, k, num, lambda i: linspace_value(i, start, stop, num), label, score, by)
    return swept.withColumn("cost", F.col("fp") * F.lit(float(cost_fp)) + F.col("fn") * F.lit(float(cost_fn)))


def cost_optimal_threshold(scored: DataFrame, cost_fp: float, cost_fn: float, label="y", score="p", by=(),
                           start: float = 0.01, stop: float = 0.99, num: int = 99) -> DataFrame:
    """Arg min of FP*cost_fp + FN*cost_fn over the candidates; first (lowest) on ties."""
    by = list(by)
    curve = cost_curve(scored, cost_fp, cost_fn, label, score, by, start, stop, num)
    best = F.min_by(F.struct("threshold", "cost", "fp", "fn", "tp", "tn"),
                    F.struct(F.col("cost").alias("k1"), F.col("i").alias("k2")))
    return curve.groupBy(*by).agg(best.alias("_b")).select(
        *by, "_b.threshold", F.col("_b.cost").alias("expected_cost"), "_b.fp", "_b.fn", "_b.tp", "_b.tn")


def operating_points(scored: DataFrame, thresholds: Sequence[float], cost_fp: float, cost_fn: float,
                     label="y", score="p", by=()) -> DataFrame:
    """E7: threshold, FP, FN, precision, recall, cost for a short list of named thresholds."""
    _check_costs(cost_fp, cost_fn)
    ts = sorted({float(t) for t in thresholds})
    p = F.col(score).cast("double")
    k = sum((F.when(p >= F.lit(t), 1).otherwise(0) for t in ts), F.lit(0))
    arr = F.array(*[F.lit(t) for t in ts])
    swept = _sweep(scored, k, len(ts), lambda i: F.element_at(arr, i + 1), label, score, list(by))
    return with_rates(swept).withColumn(
        "cost", F.col("fp") * F.lit(float(cost_fp)) + F.col("fn") * F.lit(float(cost_fn))).drop("i")


# E8 ------------------------------------------------------------------------
def matched_recall_point(scored: DataFrame, min_recall: float, cost_fp: float, cost_fn: float,
                         label="y", score="p", by=("model_id",)) -> DataFrame:
    """Cheapest curve point of each model whose recall is at least ``min_recall``
    (lowest threshold on equal cost)."""
    _check_costs(cost_fp, cost_fn)
    by = list(by)
    pts = _curve_precision_recall(score_curve(scored, label, score, by)).withColumn(
        "cost", F.col("fps") * F.lit(float(cost_fp)) + (F.col("P") - F.col("tps")) * F.lit(float(cost_fn)))
    ok = pts.filter(F.col("recall") >= F.lit(float(min_recall)))
    best = F.min_by(F.struct("threshold", "precision", "recall", "cost"),
                    F.struct(F.col("cost").alias("k1"), F.col("threshold").alias("k2")))
    return ok.groupBy(*by).agg(best.alias("_b")).select(*by, "_b.threshold", "_b.precision", "_b.recall", "_b.cost")


# E9 / E10 / E11 --------------------------------------------------------------
def model_metrics(scored: DataFrame, threshold: float, label="y", score="p", by=("model_id",)) -> DataFrame:
    """Precision, recall, F1 at a threshold and PR-AUC, per model: two aggregates joined on the model key."""
    by = list(by)
    rates = classification_metrics(scored, threshold, label, score, by)
    ap = average_precision(scored, label, score, by)
    return null_safe_join(rates, ap, by)


def quality_gate(metrics: DataFrame, min_pr_auc: float = 0.75, metric: str = "pr_auc") -> DataFrame:
    passed = F.col(metric) >= F.lit(float(min_pr_auc))
    return metrics.withColumn("passed", passed).withColumn(
        "message", F.when(passed, F.lit("passed")).otherwise(
            F.format_string(f"blocked: {metric} %.4f below minimum {min_pr_auc}", F.col(metric))))


def rank_models(metrics: DataFrame, metric: str = "pr_auc", key: str = "model_id") -> DataFrame:
    """Rank models by the metric (descending, then key).  The frame has one row per
    model, so the un-partitioned window runs over a handful of rows."""
    w = Window.orderBy(F.col(metric).desc(), F.col(key).asc())
    return metrics.withColumn("rank", F.rank().over(w))


def best_model(metrics: DataFrame, metric: str = "pr_auc", key: str = "model_id") -> DataFrame:
    best = F.min_by(F.struct(key, metric), F.struct((-F.col(metric)).alias("k1"), F.col(key).alias("k2")))
    return metrics.agg(best.alias("_b")).select(f"_b.{key}", f"_b.{metric}")


def promote_if_better(candidates: DataFrame, incumbent: DataFrame, key: str = "slot",
                      metric: str = "pr_auc") -> DataFrame:
    """A candidate wins only on a strictly greater metric, or when there is no incumbent."""
    inc = incumbent.select(key, F.col(metric).alias("incumbent_" + metric))
    j = candidates.join(inc, key, "left")
    return j.withColumn("promote", F.col("incumbent_" + metric).isNull()
                        | (F.col(metric) > F.col("incumbent_" + metric)))


# E12 -----------------------------------------------------------------------
def roc_auc(scored: DataFrame, label="y", score="p", by=(), curve: DataFrame | None = None) -> DataFrame:
    """Tie-aware rank-sum AUC: sum over distinct scores of n_pos*(negatives below + half the tied
    negatives) / (P*N).  Null when a class is absent."""
    curve = curve if curve is not None else score_curve(scored, label, score, by)
    below = F.col("N") - F.col("fps")
    return curve.groupBy(*by).agg(
        (F.sum(F.col("n_pos").cast("double") * (below + 0.5 * F.col("n_neg")))
         / F.nullif(F.max("P").cast("double") * F.max("N").cast("double"), F.lit(0.0))).alias("roc_auc"))
