"""Gradient-boosted trees from gradient histograms.

A tree grows level by level.  One pass a level sums first and second derivatives of the weighted log loss per
(node, feature, value) or, with ``bins``, per (node, feature, quantile bin): a partial aggregate, so with bins
no more than nodes x features x bins rows per task are shuffled.  Running sums over the values give every
split's gain; the best split of each node (at most 2^depth rows) comes to the driver and becomes part of
the next pass's literal expression.  Rows never move; margins are stored anew every few trees.

Gain and leaves are the usual second-order ones: GL^2/(HL+l) + GR^2/(HR+l) - G^2/(H+l), leaf = -rate G/(H+l).  Of
equal gains (to ``DIGITS`` places, as sums in another order differ beyond) the first feature and the least value win.
Rows go left when x <= the split's value; with bins that is the bin's upper edge.  A null or NaN feature fails the fit.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from raresight.errors import ModelConfigError
from raresight.plans.cumulative import cumulative_by_value
from raresight.plans.ordering import exact_quantiles
from raresight.session import stored

DIGITS = 6  # places of a gain that decide
STORE_EVERY = 8  # trees whose leaf values one projection adds up


@dataclass
class Split:
    feature: int
    value: float
    gain: float


@dataclass
class Tree:
    """Node 1 is the root, the children of n are 2n (x <= value) and 2n + 1."""

    splits: dict[int, Split] = field(default_factory=dict)
    leaves: dict[int, float] = field(default_factory=dict)

    def route(self, names: Sequence[str], outcome, node: int = 1) -> Column:
        if node not in self.splits:
            return outcome(node)
        s = self.splits[node]
        return F.when(F.col(names[s.feature]) <= F.lit(s.value), self.route(names, outcome, 2 * node)).otherwise(self.route(names, outcome, 2 * node + 1))


@dataclass
class BoostedTrees:
    features: list[str]
    trees: list[Tree]

    def score(self, df: DataFrame, prob_col: str = "fraud_probability") -> DataFrame:
        """``df`` with the probability: the trees as arrays, walked a level at a time over Arrow batches."""
        depth = max((n.bit_length() for t in self.trees for n in t.leaves), default=1)
        size = 1 << depth
        feature, value, leaf = np.zeros((len(self.trees), size), np.int64), np.full((len(self.trees), size), np.inf), np.zeros((len(self.trees), size))
        for i, tree in enumerate(self.trees):
            for n, s in tree.splits.items():
                feature[i, n], value[i, n] = s.feature, s.value
            for n, v in tree.leaves.items():
                leaf[i, n] = v
        is_leaf = np.zeros((len(self.trees), size), bool)
        for i, tree in enumerate(self.trees):
            is_leaf[i, list(tree.leaves)] = True
        columns, features, n_trees = df.columns, list(self.features), len(self.trees)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = np.column_stack([batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in features]) if batch.num_rows else np.zeros((0, len(features)))
                margin, rows = np.zeros(batch.num_rows), np.arange(batch.num_rows)
                for i in range(n_trees):
                    node = np.ones(batch.num_rows, np.int64)
                    for _ in range(depth - 1):
                        down = 2 * node + (x[rows, feature[i, node]] > value[i, node])
                        node = np.where(is_leaf[i, node], node, down)
                    margin += leaf[i, node]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(1.0 / (1.0 + np.exp(-margin)))], [*columns, prob_col])

        return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(prob_col, T.DoubleType())]))


def _bin_edges(df: DataFrame, names: Sequence[str], bins: int) -> dict[int, list[float]]:
    """At most ``bins - 1`` upper edges per feature, from its exact quantiles."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("f"), F.col(c).alias("x")) for i, c in enumerate(names)])).alias("s")).select("s.*")
    found = exact_quantiles(long, "x", [i / bins for i in range(1, bins)], ["f"]).collect()  # features x bins numbers
    return {i: sorted({r["value"] for r in found if r["f"] == i}) for i in range(len(names))}


def boosted_trees(df: DataFrame, features: Sequence[str], label: str = "Class", weight: str | None = None, n_trees: int = 300, max_depth: int = 5,
                  learning_rate: float = 0.1, reg_lambda: float = 1.0, min_child_weight: float = 1.0, bins: int | None = 256) -> BoostedTrees:
    """Fit; ``bins=None`` looks at every distinct value (exact, and a shuffle of the distinct values a level)."""
    if n_trees < 1 or max_depth < 1:
        raise ModelConfigError("n_trees and max_depth must be at least 1")
    features = list(features)
    names = [f"x{i}" for i in range(len(features))]

    def whole(c: str) -> Column:
        x = F.col(c).cast("double")
        return F.when(x.isNull() | F.isnan(x), F.raise_error(F.lit(f"feature {c} is null or NaN")).cast("double")).otherwise(x)

    rows = df.select(*[whole(c).alias(n) for c, n in zip(features, names)], (F.col(label) == 1).cast("double").alias("_y"),
                     (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("_w"), F.lit(0.0).alias("_margin"))
    rows = stored(rows, "boosting-rows")
    edges = _bin_edges(rows, names, bins) if bins else None
    model, pending = BoostedTrees(features, []), []

    def with_margin() -> Column:
        out = F.col("_margin")
        for tree in pending:
            out = out + tree.route(names, lambda n, t=tree: F.lit(t.leaves[n]))
        return out

    for _ in range(n_trees):
        tree, open_nodes = Tree(), {1}
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("_m")))
        state = rows.withColumn("_m", with_margin()).select(*names, (F.col("_w") * (p - F.col("_y"))).alias("g"), (F.col("_w") * p * (1 - p)).alias("h"))
        sums: dict[int, tuple[float, float]] = {}
        for _ in range(max_depth):
            found = _best_splits(state.withColumn("node", tree.route(names, lambda n: F.lit(n))).filter(F.col("node").isin(*open_nodes)), names, edges, reg_lambda, min_child_weight)
            open_nodes = set()
            for r in found:
                n = r["node"]
                sums[n] = (r["g"], r["h"])
                if r["best"] is not None and r["best"]["gain"] > 0:
                    b = r["best"]
                    tree.splits[n] = Split(-b["minus_feature"], -b["minus_value"], b["gain"])
                    sums[2 * n] = (b["gl"], b["hl"])
                    sums[2 * n + 1] = (r["g"] - b["gl"], r["h"] - b["hl"])
                    open_nodes |= {2 * n, 2 * n + 1}
            if not open_nodes:
                break
        if not sums:
            raise ModelConfigError("no rows to fit")
        tree.leaves = {n: -learning_rate * g / (h + reg_lambda) for n, (g, h) in sums.items() if n not in tree.splits}
        model.trees.append(tree)
        pending.append(tree)
        if len(pending) == STORE_EVERY:
            rows, pending = stored(rows.withColumn("_margin", with_margin()), "boosting-rows"), []
    return model


def _best_splits(state: DataFrame, names: Sequence[str], edges: dict[int, list[float]] | None, reg_lambda: float, min_child_weight: float) -> list:
    """Per node: g, h and the best split (gain, minus_feature, minus_value, gl, hl; null where none is allowed)."""
    def value(i: int, c: str) -> Column:
        if edges is None:
            return F.col(c)
        bounds = F.array(*[F.lit(e) for e in edges[i]]) if edges[i] else F.array().cast("array<double>")
        at = F.array_position(F.transform(bounds, lambda e: e >= F.col(c)), True)  # the first upper edge at or above
        return F.when(at > 0, F.get(bounds, (at - 1).cast("int"))).otherwise(F.lit(float("inf")))

    long = state.select("node", "g", "h", F.explode(F.array(*[F.struct(F.lit(i).alias("f"), value(i, c).alias("x")) for i, c in enumerate(names)])).alias("s"))
    histogram = stored(long.groupBy("node", F.col("s.f").alias("f"), F.col("s.x").alias("x")).agg(F.sum("g").alias("g"), F.sum("h").alias("h")), "gradient-histogram")
    totals = stored(histogram.filter("f = 0").groupBy("node").agg(F.sum("g").alias("g"), F.sum("h").alias("h")), "node-totals")  # a row per node
    if edges is None:
        upto = cumulative_by_value(histogram, "x", ["g", "h"], ["node", "f"], descending=False, next_value=True)
    else:  # a window over at most ``bins`` rows
        w = Window.partitionBy("node", "f").orderBy("x")
        run = w.rowsBetween(Window.unboundedPreceding, 0)
        upto = histogram.withColumns({"cum_g": F.sum("g").over(run), "cum_h": F.sum("h").over(run), "next_x": F.lead("x").over(w)})
    cut = upto.select("node", "f", "x", F.col("cum_g").alias("gl"), F.col("cum_h").alias("hl"), "next_x").filter("next_x is not null").join(totals, "node")
    gr, hr = F.col("g") - F.col("gl"), F.col("h") - F.col("hl")
    gain = F.pow("gl", F.lit(2)) / (F.col("hl") + reg_lambda) + F.pow(gr, F.lit(2)) / (hr + reg_lambda) - F.pow("g", F.lit(2)) / (F.col("h") + reg_lambda)
    allowed = cut.filter((F.col("hl") >= min_child_weight) & (hr >= min_child_weight))
    best = allowed.groupBy("node").agg(F.max(F.struct(F.round(gain, DIGITS).alias("gain"), (-F.col("f")).alias("minus_feature"), (-F.col("x")).alias("minus_value"), "gl", "hl")).alias("best"))
    return totals.join(best, "node", "left").collect()
