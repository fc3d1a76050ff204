"""Profiling (P1-P18): structure, describe, nulls, duplicates, value counts,
imbalance, hourly profile, correlation, histograms, densities, melt, box statistics.

Many-column work is one aggregate with many expressions, or one narrow ``unpivot``
followed by one ``groupBy(column)`` (partial, map-side) — never one job per column.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raresight.functions import hour_of_day, null_safe_join
from raresight.plans import exact_quantiles
from raresight.session import stored

QUARTILES = (0.25, 0.5, 0.75)


def _stack(df: DataFrame, items: list[tuple[str, str]], names: str) -> DataFrame:
    """Turn one wide row into long form: items are (label literal, column) pairs."""
    args = [a for lab, col in items for a in (F.lit(lab), F.col(f"`{col}`"))]
    return df.select(F.stack(F.lit(len(items)), *args).alias(*[n.strip() for n in names.split(",")]))


def _long(df: DataFrame, cols, by=(), name: str = "column", value: str = "value") -> DataFrame:
    """Narrow unpivot of numeric columns to (by..., column, value) as doubles, NaN/null dropped."""
    wide = df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols])
    long = wide.unpivot(list(by), list(cols), name, value)
    return long.filter(F.col(value).isNotNull() & ~F.isnan(value))


# P1 -------------------------------------------------------------------------
def structure(df: DataFrame) -> DataFrame:
    """(column, dtype, non_null, n_rows): shape and non-null counts in one pass."""
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(F.col(f"`{c}`")).alias(f"_c{i}") for i, c in enumerate(cols)])
    dtypes = dict(df.dtypes)
    args = ", ".join(f"'{c}', '{dtypes[c]}', _c{i}" for i, c in enumerate(cols))
    return agg.selectExpr(f"stack({len(cols)}, {args}) AS (column, dtype, non_null)", "_n AS n_rows")


# P2 -------------------------------------------------------------------------
def head(df: DataFrame, n: int = 5, order_cols=()) -> DataFrame:
    """First n rows in a repeatable order (TakeOrdered: n rows per task, merged once)."""
    return df.orderBy(*order_cols).limit(n)


# P3 / P8 --------------------------------------------------------------------
def describe(df: DataFrame, cols, by=(), probs=QUARTILES, accuracy: int = 10000, exact: bool = True) -> DataFrame:
    """count, mean, sample std, min, quartiles, max per column (and group).

    ``exact`` quartiles are linearly interpolated order statistics (pandas' definition);
    ``exact=False`` returns ``percentile_approx`` values (rank error <= n / accuracy) from
    the same single aggregate — the bounded-memory option for a quick look at huge tables.
    """
    by = list(by)
    long = _long(df, cols, by)
    keys = [*by, "column"]
    names = [f"p{int(round(p * 100))}" for p in probs]
    aggs = [F.count(F.lit(1)).alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
            F.min("value").alias("min"), F.max("value").alias("max")]
    if not exact:
        approx = F.percentile_approx("value", [float(p) for p in probs], accuracy)
        out = long.groupBy(*keys).agg(*aggs, approx.alias("_q"))
        return out.select(*keys, "count", "mean", "std", "min",
                          *[F.col("_q")[i].alias(n) for i, n in enumerate(names)], "max")
    moments = {"count": F.count(F.lit(1)), "mean": F.avg("_x"), "std": F.stddev_samp("_x"),
               "min": F.min("_x"), "max": F.max("_x")}
    q = exact_quantiles(long, "value", probs, keys, extra_aggs=moments)
    qw = q.groupBy(*keys, *moments).pivot("qi", list(range(len(probs)))).agg(F.first("value"))
    return qw.select(*keys, "count", "mean", "std", "min", *[F.col(str(i)).alias(n) for i, n in enumerate(names)],
                     "max")


# P4 -------------------------------------------------------------------------
def null_counts(df: DataFrame, only_nonzero: bool = False) -> DataFrame:
    """(column, n_null) per column — null, or NaN in float columns, as pandas counts
    them — plus a ``__total__`` row; optionally only columns with nulls."""
    dtypes = dict(df.dtypes)

    def isnull(c):
        e = F.col(f"`{c}`").isNull()
        return e | F.isnan(c) if dtypes[c] in ("double", "float") else e

    agg = df.agg(*[F.count_if(isnull(c)).alias(f"_c{i}") for i, c in enumerate(df.columns)])
    long = _stack(agg, [(c, f"_c{i}") for i, c in enumerate(df.columns)], "column, n_null")
    total = long.agg(F.lit("__total__").alias("column"), F.sum("n_null").cast("long").alias("n_null"))
    out = long.unionByName(total)
    return out.filter("n_null > 0") if only_nonzero else out


# P5 -------------------------------------------------------------------------
def duplicate_counts(df: DataFrame, label: str | None = "Class") -> DataFrame:
    """Rows after the first of each identical group, by label: ``groupBy(all).count()``
    then ``sum(n - 1)``.  Partial aggregation collapses hot groups map-side."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    by = [label] if label else []
    return groups.groupBy(*by).agg(F.sum(F.col("_n") - 1).cast("long").alias("n_duplicates"))


# P6 -------------------------------------------------------------------------
def value_counts(df: DataFrame, col: str) -> DataFrame:
    """(value, n, proportion) per distinct value; the total is a scalar subquery."""
    total = df.select(F.count(F.lit(1))).scalar()
    return df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n")) \
        .withColumn("proportion", F.col("n") / total).orderBy(F.col("n").desc(), "value")


# P7 -------------------------------------------------------------------------
def imbalance(df: DataFrame, label: str = "Class") -> DataFrame:
    pos = F.col(label) == 1
    r = df.agg(F.count_if(pos).alias("n_pos"), F.count_if(~pos).alias("n_neg"))
    return r.select("n_pos", "n_neg",
                    F.try_divide(F.col("n_pos") * 100.0, F.col("n_pos") + F.col("n_neg")).alias("pos_rate_pct"),
                    (F.col("n_neg") / F.nullif(F.col("n_pos"), F.lit(0))).alias("neg_per_pos"))


# P9 -------------------------------------------------------------------------
def predicate_rate(df: DataFrame, predicate, by=()) -> DataFrame:
    """Share of rows (in %) for which the predicate holds."""
    pred = F.expr(predicate) if isinstance(predicate, str) else predicate
    return df.groupBy(*by).agg((F.avg(F.coalesce(pred, F.lit(False)).cast("double")) * 100).alias("rate_pct"))


# P10 / P11 / P12 ---------------------------------------------------------------
def hourly_profile(df: DataFrame, time_col: str = "Time", label: str = "Class") -> DataFrame:
    return df.groupBy(hour_of_day(time_col).alias("hour")).agg(
        F.count(F.lit(1)).alias("n_tx"), (F.avg(F.col(label).cast("double")) * 100).alias("pos_rate_pct"))


def time_span(df: DataFrame, time_col: str = "Time") -> DataFrame:
    return df.agg(F.max(time_col).alias("max_seconds")).withColumn(
        "hours", F.round(F.col("max_seconds") / 3600.0, 1))


# P13 / P14 --------------------------------------------------------------------
def correlation_matrix(df: DataFrame, cols) -> DataFrame:
    """Pearson r for every ordered pair (a, b) as a long table, over the rows where both are present (null and NaN
    are absent).  No value for a pair with fewer than two such rows or without variation, the diagonal
    included.

    One aggregate centres the columns (a fitted number per column); one pass then sums the products of all
    pairs, a matrix per Arrow batch, added up per task; d x d sums per task are shuffled, never rows.
    """
    import numpy as np
    import pyarrow as pa

    cols = list(cols)
    d = len(cols)
    number = [F.when(~F.isnan(F.col(f"`{c}`").cast("double")), F.col(f"`{c}`").cast("double")).alias(f"_c{i}") for i, c in enumerate(cols)]
    clean = df.select(*number)
    centre = [m if m is not None else 0.0 for m in clean.agg(*[F.avg(f"_c{i}") for i in range(d)]).first()]
    row, column = np.triu_indices(d)

    def sums(batches):
        total = np.zeros((4, d, d))
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1).astype(float) - np.array(centre)
            present = ~np.isnan(x)
            m, x = present.astype(float), np.where(present, x, 0.0)
            for k, (u, v) in enumerate(((m, m), (x, m), (x * x, m), (x, x))):  # pairs' counts, sums, squares, products
                total[k] += u.T @ v
        yield pa.RecordBatch.from_arrays([pa.array(row, pa.int32()), pa.array(column, pa.int32()), pa.array(total[0][row, column]),
                                          pa.array(total[1][row, column]), pa.array(total[1].T[row, column]), pa.array(total[2][row, column]),
                                          pa.array(total[2].T[row, column]), pa.array(total[3][row, column])], ["i", "j", "n", "sx", "sy", "sxx", "syy", "sxy"])

    names = ("n", "sx", "sy", "sxx", "syy", "sxy")
    pairs = clean.mapInArrow(sums, "i int, j int, " + ", ".join(f"{c} double" for c in names)).groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in names])
    vx, vy = F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx"), F.col("n") * F.col("syy") - F.col("sy") * F.col("sy")
    r = F.when((F.col("n") >= 2) & (vx > 0) & (vy > 0), F.when(F.col("i") == F.col("j"), 1.0).otherwise((F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")) / F.sqrt(vx * vy)))
    label = F.array(*[F.lit(c) for c in cols])
    half = pairs.select("i", "j", r.alias("r"))
    both = half.union(half.filter("i <> j").select("j", "i", "r"))
    return both.select(label[F.col("i")].alias("a"), label[F.col("j")].alias("b"), "r")


def label_correlation_ranking(df: DataFrame, features, label: str = "Class", k: int | None = 12) -> DataFrame:
    """|Pearson r| of each feature with the 0/1 label (point-biserial), descending, top k."""
    feats = list(features)
    agg = df.agg(*[F.abs(F.corr(f, F.col(label).cast("double"))).alias(f"_a{i}") for i, f in enumerate(feats)])
    long = _stack(agg, [(f, f"_a{i}") for i, f in enumerate(feats)], "feature, abs_corr")
    ranked = long.orderBy(F.col("abs_corr").desc_nulls_last(), "feature")
    return ranked.limit(k) if k else ranked


# P15 ------------------------------------------------------------------------
def grouped_histogram(df: DataFrame, col: str, label: str = "Class", bins: int = 50) -> DataFrame:
    """Equal-width bins over the shared [min, max]; counts per (label, bin).
    The range is a scalar subquery; the last bin is closed."""
    rng = df.select(F.struct(F.min(col).alias("lo"), F.max(col).alias("hi"))).scalar()  # one scan
    lo, hi = rng["lo"], rng["hi"]
    w = (hi - lo) / F.lit(float(bins))
    b = F.when(w == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col(col) - lo) / w), F.lit(bins - 1))).cast("long")
    return df.filter(F.col(col).isNotNull()).groupBy(label, b.alias("bin")).agg(
        F.count(F.lit(1)).alias("n")).select(label, "bin", (lo + F.col("bin") * w).alias("bin_lo"), "n")


# P16 ------------------------------------------------------------------------
def class_density(df: DataFrame, col: str, label: str = "Class", gridsize: int = 200, cut: float = 3.0) -> DataFrame:
    """Gaussian kernel density per class, each normalised on its own.

    Bandwidth by Scott's rule (sample std x n^(-1/5)); grid = linspace(min - cut*h, max + cut*h, gridsize).  One
    aggregate gives each class's grid; then every Arrow batch adds its values' kernels to ``gridsize`` sums per
    class, and a task emits those sums alone: nothing row-sized is shuffled.  A class whose values are all equal
    has no bandwidth and no density (null).
    """
    x = F.col(col).cast("double")
    clean = df.select(F.col(label).alias("_class"), x.alias("_x")).filter(F.col("_x").isNotNull() & ~F.isnan("_x"))
    stats = clean.groupBy("_class").agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("_x").alias("sd"), F.min("_x").alias("mn"), F.max("_x").alias("mx")).collect()  # one row per class
    grids, widths = [], []
    for r in stats:
        h = None if r["sd"] is None else r["sd"] * float(r["n"]) ** -0.2
        lo, hi = (None, None) if h is None else (r["mn"] - cut * h, r["mx"] + cut * h)
        step = None if h is None else (hi - lo) / float(gridsize - 1)
        grids.append([None if h is None else hi if j == gridsize - 1 else float(j) * step + lo for j in range(gridsize)])
        widths.append(h)
    number = F.lit(-1)
    for i, r in enumerate(stats):
        number = F.when(F.col("_class").eqNullSafe(F.lit(r["_class"])), F.lit(i)).otherwise(number)

    def run(batches):
        sums = np.zeros((len(grids), gridsize))
        for batch in batches:
            own, values = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("class", "_x"))
            for i, h in enumerate(widths):
                if not h:
                    continue
                grid = np.array(grids[i])
                different, times = np.unique(values[own == i], return_counts=True)
                for at in range(0, len(different), 4096):
                    z = (grid[:, None] - different[None, at: at + 4096]) / h
                    sums[i] += np.exp(-0.5 * z * z) @ times[at: at + 4096]
        size = len(grids) * gridsize
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(grids)), gridsize), pa.int32()), pa.array(np.tile(np.arange(gridsize), len(grids)), pa.int32()), pa.array(sums.reshape(size))], ["class", "j", "s"])

    sums = clean.select(number.alias("class"), "_x").mapInArrow(run, "class int, j int, s double").groupBy("class", "j").agg(F.sum("s").alias("s"))
    points = [(i, j, grids[i][j], None if not widths[i] else stats[i]["n"] * widths[i] * math.sqrt(2 * math.pi)) for i in range(len(stats)) for j in range(gridsize)]
    grid = df.sparkSession.createDataFrame(points, "class int, j int, x double, norm double")
    of_class = F.lit(None).cast(df.schema[label].dataType)
    for i, r in enumerate(stats):
        of_class = F.when(F.col("class") == i, F.lit(r["_class"]).cast(df.schema[label].dataType)).otherwise(of_class)
    return grid.join(sums, ["class", "j"]).select(of_class.alias(label), "j", "x", (F.col("s") / F.col("norm")).alias("density"))


# P17 ------------------------------------------------------------------------
def melt(df: DataFrame, id_cols, value_cols, var_name: str = "component", value_name: str = "value") -> DataFrame:
    return df.select(*id_cols, *[F.col(c).cast("double").alias(c) for c in value_cols]) \
        .unpivot(list(id_cols), list(value_cols), var_name, value_name)


# P18 ------------------------------------------------------------------------
def box_stats(df: DataFrame, value_cols, label: str = "Class", whisker: float = 1.5) -> DataFrame:
    """Per (component, class): exact quartiles, whiskers at ``whisker`` x IQR (the most
    extreme data points inside the fences) and the number of points outside them.
    Quartiles per group are a stored table (components x classes); its join is sized by its files."""
    long = _long(df, value_cols, [label], "component")
    keys = [label, "component"]
    q = exact_quantiles(long, "value", QUARTILES, keys)
    qw = q.groupBy(*keys).pivot("qi", [0, 1, 2]).agg(F.first("value")) \
        .select(*keys, F.col("0").alias("q1"), F.col("1").alias("median"), F.col("2").alias("q3"))
    qw = qw.withColumn("iqr", F.col("q3") - F.col("q1")) \
        .withColumn("_lf", F.col("q1") - F.lit(whisker) * F.col("iqr")) \
        .withColumn("_uf", F.col("q3") + F.lit(whisker) * F.col("iqr"))
    j = null_safe_join(long, stored(qw, "box-quartiles"), keys)
    v = F.col("value")
    out = j.groupBy(*keys, "q1", "median", "q3", "iqr").agg(
        F.min(F.when(v >= F.col("_lf"), v)).alias("whisker_lo"),
        F.max(F.when(v <= F.col("_uf"), v)).alias("whisker_hi"),
        F.count_if((v < F.col("_lf")) | (v > F.col("_uf"))).alias("n_outliers"))
    return out
