"""Logistic regression by Newton steps, for several training sets at once.

The training sets are the complements of folds (fold f's model is trained on the rows of all other
folds), or the whole frame.  One pass over the rows per step gives every model its sufficient statistics:
each Arrow batch adds weighted d x d products per model, a task emits their upper triangles once, and
they are summed by (model, position).  The driver solves one d x d system per model; what reaches it is
models x d^2 / 2 numbers, whatever the rows.  Rows never move.

The objective is the reference's: C * sum of weighted log losses + |b|^2 / 2, the intercept free.  A step
that raises it is halved; a model whose step is below ``tol`` is left out of later passes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from raresight.errors import ModelConfigError


@dataclass
class LogisticFit:
    """A fitted model; ``mean`` and ``std`` are 0 and 1 for features that are not scaled."""

    features: list[str]
    intercept: float
    coefficients: list[float]
    mean: list[float]
    std: list[float]
    steps: int = 0
    gradient: list[float] = field(default_factory=list)  # of the objective, intercept first, at these coefficients

    def margin(self) -> Column:
        out = F.lit(self.intercept)
        for c, b, m, s in zip(self.features, self.coefficients, self.mean, self.std):
            x = F.col(c).cast("double")
            out = out + F.lit(b) * (x if (m, s) == (0.0, 1.0) else (x - F.lit(m)) / F.lit(s))
        return out

    def probability(self) -> Column:
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-self.margin()))


def _moments(df: DataFrame, scale: Sequence[str], label: str, models: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per model: mean and population std of ``scale`` (models x columns) and class counts (models x 2), from one
    row per (fold, class)."""
    aggs = [F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(scale)], *[F.var_pop(c).alias(f"v{i}") for i, c in enumerate(scale)]]
    rows = df.groupBy("_fold", label).agg(*aggs).collect()
    mean, std, counts = np.zeros((models, len(scale))), np.ones((models, len(scale))), np.zeros((models, 2))
    for f in range(models):
        own = [r for r in rows if models == 1 or r["_fold"] != f]
        n = np.array([r["n"] for r in own], float)
        for r in own:
            counts[f, int(r[label] == 1)] += r["n"]
        if not len(n):
            continue
        for i in range(len(scale)):
            m = np.array([r[f"m{i}"] for r in own], float)
            mean[f, i] = (n * m).sum() / n.sum()
            var = (n * (np.array([r[f"v{i}"] for r in own], float) + (m - mean[f, i]) ** 2)).sum() / n.sum()
            std[f, i] = np.sqrt(var) if var > 0 else 1.0
    return mean, std, counts


def newton_logistic(df: DataFrame, features: Sequence[str], label: str = "Class", fold: str | None = None, k: int = 1, c: float = 1.0,
                    balanced: bool = True, weight: str | None = None, scale: Sequence[str] = (), max_iter: int = 100, tol: float = 1e-10) -> list[LogisticFit]:
    """One fit per fold 0..k-1, trained on the other folds' rows; without ``fold`` one fit on all rows.

    ``balanced`` weights class c by n / (2 n_c) of the model's own training rows; ``weight`` names a column instead.
    ``scale`` names the features that are standardised with the training rows' mean and population std.  A null or NaN
    feature fails the fit, as does a training set of one class; no convergence raises."""
    features, models = list(features), k if fold else 1
    if fold and k < 2:
        raise ModelConfigError(f"k must be at least 2, got {k}")
    d = len(features)
    narrow = df.select(*[F.col(x).cast("double").alias(f"x{i}") for i, x in enumerate(features)], (F.col(label) == 1).cast("int").alias("_y"),
                       (F.col(fold) if fold else F.lit(0)).cast("int").alias("_fold"), (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("_w"))
    at = [features.index(s) for s in scale]
    mean, std, counts = _moments(narrow, [f"x{i}" for i in at], "_y", models)
    if (counts == 0).any():
        raise ModelConfigError("a training set has rows of one class only")
    means, stds = np.zeros((models, d)), np.ones((models, d))
    means[:, at], stds[:, at] = mean, std
    class_weight = counts.sum(1, keepdims=True) / (2 * counts) if balanced and not weight else np.ones((models, 2))
    upper = np.triu_indices(d + 1)
    size = len(upper[0]) + d + 2  # second derivatives, gradient, loss

    def statistics(beta: np.ndarray, active: list[int]) -> dict[int, np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((models, size))
            for batch in batches:
                if not batch.num_rows:
                    continue
                columns = [batch.column(f"x{i}") for i in range(d)]
                if any(col.null_count for col in columns):
                    raise ValueError("a feature is null")
                x = np.column_stack([col.to_numpy(zero_copy_only=False) for col in columns])
                if np.isnan(x).any():
                    raise ValueError("a feature is NaN")
                y, own, w = (batch.column(name).to_numpy(zero_copy_only=False) for name in ("_y", "_fold", "_w"))
                for m in active:
                    rows = own != m if models > 1 else slice(None)
                    z = np.column_stack([np.ones(len(x[rows])), (x[rows] - means[m]) / stds[m]])
                    target, weights = y[rows], w[rows] * class_weight[m][y[rows]]
                    margin = z @ beta[m]
                    p = 1.0 / (1.0 + np.exp(-margin))
                    second = (z * (weights * p * (1 - p))[:, None]).T @ z
                    loss = (weights * (np.logaddexp(0.0, margin) - target * margin)).sum()
                    total[m] += np.concatenate([second[upper], z.T @ (weights * (target - p)), [loss]])
            for m in active:
                yield pa.RecordBatch.from_arrays([pa.array(np.full(size, m), pa.int32()), pa.array(np.arange(size), pa.int32()), pa.array(total[m])], ["model", "position", "value"])

        summed = narrow.mapInArrow(run, "model int, position int, value double").groupBy("model", "position").agg(F.sum("value").alias("value"))
        out = {m: np.zeros(size) for m in active}
        for r in summed.collect():
            out[r["model"]][r["position"]] = r["value"]
        return out

    beta = np.zeros((models, d + 1))
    good, last = beta.copy(), np.full(models, np.inf)
    active, steps, gradients = list(range(models)), [0] * models, [[] for _ in range(models)]
    penalty = np.concatenate([[0.0], np.ones(d)]) / c
    for _ in range(max_iter):
        found = statistics(beta, active)
        for m in list(active):
            s = found[m]
            steps[m] += 1
            value = s[-1] + 0.5 * (penalty * beta[m] ** 2).sum()
            if value > last[m] * (1 + 1e-12):  # too far: half the way back
                beta[m] = (beta[m] + good[m]) / 2
                continue
            good[m], last[m] = beta[m], value
            second = np.zeros((d + 1, d + 1))
            second[upper] = s[: len(upper[0])]
            second = second + np.triu(second, 1).T + np.diag(penalty)
            gradient = s[len(upper[0]): -1] - penalty * beta[m]
            gradients[m] = (-gradient).tolist()
            step = np.linalg.lstsq(second, gradient, rcond=None)[0]
            if np.abs(step).max() <= tol * (1 + np.abs(beta[m]).max()):
                active.remove(m)
            else:
                beta[m] = beta[m] + step
        if not active:
            return [LogisticFit(features, float(good[m][0]), good[m][1:].tolist(), means[m].tolist(), stds[m].tolist(), steps[m], gradients[m]) for m in range(models)]
    raise ModelConfigError(f"no convergence within {max_iter} steps (models {active})")


def logistic_gradient(df: DataFrame, features: Sequence[str], coefficients: Sequence[float], intercept: float, label: str = "Class",
                      weight: str | None = None, c: float = 1.0) -> DataFrame:
    """(term, gradient, scale) of the penalised objective at given coefficients, summed from the rows: at the optimum each
    gradient is 0.  ``scale`` is the sum of the terms' sizes, to judge what counts as 0."""
    features = list(features)
    margin = F.lit(float(intercept))
    for x, b in zip(features, coefficients):
        margin = margin + F.lit(float(b)) * F.col(x)
    miss = (F.lit(1.0) / (F.lit(1.0) + F.exp(-margin)) - (F.col(label) == 1).cast("double")) * (F.col(weight) if weight else F.lit(1.0))
    narrow = df.select(*features, miss.alias("_miss"))
    terms = [("intercept", F.lit(1.0), 0.0), *[(x, F.col(x).cast("double"), float(b) / c) for x, b in zip(features, coefficients)]]
    sums = narrow.agg(*[a for i, (_, x, _) in enumerate(terms) for a in (F.sum(F.col("_miss") * x).alias(f"g{i}"), F.sum(F.abs(F.col("_miss") * x)).alias(f"s{i}"))])
    rows = F.array(*[F.struct(F.lit(name).alias("term"), (F.col(f"g{i}") + F.lit(b)).alias("gradient"), F.col(f"s{i}").alias("scale")) for i, (name, _, b) in enumerate(terms)])
    return sums.select(F.inline(rows))
