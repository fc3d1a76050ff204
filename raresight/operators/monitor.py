"""Monitoring (D3-D13): column and dataset drift between a reference and a current
frame, windowed drift and alerts, delayed-label quality, drift injection,
champion/challenger and shadow comparison, per-row contributions.

Distributions are compared through counts: per (column, value) for the two-sample
KS and Wasserstein statistics (the bucketed running-sum plan, never a global window),
per (column, category) for chi-square and Jensen-Shannon, per (window, bin) for the
windowed statistics.  The reference side enters only as counts or bin edges.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from raresight.functions import hash_uniform, null_safe_join
from raresight.functions.stats import chi2_sf_udf, norm_sf_udf
from raresight.operators import evaluate as E
from raresight.plans import cumulative_by_value, exact_quantiles
from raresight.session import stored

# Thresholds of the tests (fixed values of the published drift-preset defaults)
P_VALUE_THRESHOLD = 0.05
DISTANCE_THRESHOLD = 0.1     # Wasserstein (normed) and Jensen-Shannon
PSI_THRESHOLD = 0.1
DRIFT_SHARE = 0.5
PSI_EPS = 0.0001


def _sides_long(ref: DataFrame, cur: DataFrame, cols, as_string: bool = False) -> DataFrame:
    def long(df, side):
        typ = "string" if as_string else "double"
        w = df.select(*[F.col(c).cast(typ).alias(c) for c in cols])
        return w.unpivot([], list(cols), "column", "value").withColumn("_side", F.lit(side))
    u = long(ref, 0).unionByName(long(cur, 1))
    ok = F.col("value").isNotNull()
    if not as_string:
        ok = ok & ~F.isnan("value")
    return u.filter(ok)


def ks_p_value(d, n_ref, n_cur, terms: int = 20):
    """Asymptotic two-sample Kolmogorov-Smirnov p-value:
    Q((sqrt(ne) + 0.12 + 0.11/sqrt(ne)) * D), Q(l) = 2 sum (-1)^(j-1) exp(-2 j^2 l^2).
    Below l = 0.3 the value is 1 to double precision; above it the terms fall under
    1e-17 before j = 15, so 20 terms are exact in a double."""
    en = F.sqrt(F.try_divide(n_ref * n_cur, n_ref + n_cur))
    lam = (en + F.lit(0.12) + F.try_divide(F.lit(0.11), en)) * d
    series = sum((F.lit(2.0 * (1 if j % 2 else -1)) * F.exp(F.lit(-2.0 * j * j) * lam * lam)
                  for j in range(1, terms + 1)), F.lit(0.0))
    return F.when(lam < 0.3, F.lit(1.0)).otherwise(F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0)))


# D3 numeric ---------------------------------------------------------------------
def numeric_drift(ref: DataFrame, cur: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per column: n_ref, n_cur, KS statistic and p-value, Wasserstein-1 distance normed by
    the reference's population std.  Both statistics come from one running sum over
    the distinct values of the union."""
    u = _sides_long(ref, cur, cols)
    d = u.groupBy("column", "value").agg(F.count_if(F.col("_side") == 0).alias("n_ref"),
                                         F.count_if(F.col("_side") == 1).alias("n_cur"))
    tot = u.groupBy("column").agg(F.count_if(F.col("_side") == 0).alias("tot_ref"),
                                  F.count_if(F.col("_side") == 1).alias("tot_cur"),
                                  F.stddev_pop(F.when(F.col("_side") == 0, F.col("value"))).alias("ref_std"))
    cum = cumulative_by_value(d, "value", ["n_ref", "n_cur"], ["column"], descending=False, next_value=True)
    j = cum.join(tot, "column")  # one row per monitored column
    # try_divide: an empty side (0 rows) gives null statistics instead of an ANSI error
    gap = F.abs(F.try_divide(F.col("cum_n_ref"), F.col("tot_ref")) - F.try_divide(F.col("cum_n_cur"), F.col("tot_cur")))
    width = F.coalesce(F.col("next_value") - F.col("value"), F.lit(0.0))
    s = j.groupBy("column", "tot_ref", "tot_cur", "ref_std").agg(
        F.max(gap).alias("ks_stat"), F.sum(gap * width).alias("wasserstein"))
    return s.select(
        "column", F.col("tot_ref").alias("n_ref"), F.col("tot_cur").alias("n_cur"), "ks_stat",
        ks_p_value(F.col("ks_stat"), F.col("tot_ref").cast("double"), F.col("tot_cur").cast("double")).alias("ks_p_value"),
        (F.col("wasserstein") / F.nullif(F.col("ref_std"), F.lit(0.0))).alias("wasserstein_norm"))


# D3 categorical -------------------------------------------------------------------
def categorical_drift(ref: DataFrame, cur: DataFrame, cols: Sequence[str], p_values: bool = True) -> DataFrame:
    """Per column: n_ref, n_cur, number of categories, Jensen-Shannon distance (natural
    log), chi-square goodness of fit of current counts to reference shares (categories
    seen in the reference) with its p-value, and a two-proportion z-test p-value for
    binary columns."""
    u = _sides_long(ref, cur, cols, as_string=True)
    c = u.groupBy("column", "value").agg(F.count_if(F.col("_side") == 0).alias("n_ref"),
                                         F.count_if(F.col("_side") == 1).alias("n_cur"))
    tot = c.groupBy("column").agg(F.sum("n_ref").alias("tot_ref"), F.sum("n_cur").alias("tot_cur"),
                                  F.count(F.lit(1)).alias("n_categories"))
    j = c.join(tot, "column")
    p = F.try_divide(F.col("n_ref"), F.col("tot_ref"))
    q = F.try_divide(F.col("n_cur"), F.col("tot_cur"))
    m = (p + q) / 2
    kl = lambda a: F.when(a > 0, a * F.log(a / m)).otherwise(F.lit(0.0))
    expct = p * F.col("tot_cur")
    # the reference category of the z-test: an aggregate per column joined back (one row
    # per column), not a window holding a column's whole category domain in one task
    firsts = c.groupBy("column").agg(F.min("value").alias("_first"))
    j = j.join(firsts, "column")
    s = j.groupBy("column", "tot_ref", "tot_cur", "n_categories").agg(
        F.sqrt(F.greatest(F.lit(0.0), F.lit(0.5) * F.sum(kl(p)) + F.lit(0.5) * F.sum(kl(q)))).alias("js_distance"),
        F.sum(F.when(F.col("n_ref") > 0, F.pow(F.col("n_cur") - expct, 2) / expct)).alias("chi2_stat"),
        F.count_if(F.col("n_ref") > 0).alias("_k"),
        F.max(F.when(F.col("value") == F.col("_first"), p)).alias("_p1"),
        F.max(F.when(F.col("value") == F.col("_first"), q)).alias("_q1"))
    pooled = F.try_divide(F.col("_p1") * F.col("tot_ref") + F.col("_q1") * F.col("tot_cur"),
                          F.col("tot_ref") + F.col("tot_cur"))
    se = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1.0), F.col("tot_ref"))
                                         + F.try_divide(F.lit(1.0), F.col("tot_cur"))))
    z = F.abs(F.col("_p1") - F.col("_q1")) / F.nullif(se, F.lit(0.0))
    if p_values:  # tail probabilities: a pandas UDF over one row per column
        chi2_p = F.when(F.col("_k") > 1, chi2_sf_udf(F.col("chi2_stat"), (F.col("_k") - 1).cast("double")))
        z_p = F.when(F.col("n_categories") <= 2, F.coalesce(F.lit(2.0) * norm_sf_udf(z), F.lit(1.0)))
    else:
        chi2_p = z_p = F.lit(None).cast("double")
    return s.select(
        "column", F.col("tot_ref").alias("n_ref"), F.col("tot_cur").alias("n_cur"), "n_categories", "js_distance",
        "chi2_stat", (F.col("_k") - 1).alias("chi2_dof"), chi2_p.alias("chi2_p_value"), z_p.alias("z_p_value"))


def column_psi(ref: DataFrame, cur: DataFrame, cols: Sequence[str], bins: int = 10) -> DataFrame:
    """Population stability index per column between reference and current, on the
    reference's exact quantile bins (empty bins count as share 0.0001).

    All columns at once: exact quantiles of the unpivoted reference, grouped by column, give the edges (fetched
    once, ``bins - 1`` numbers per column); one pass over both sides counts (column, bin).  Null and NaN
    belong to no bin on either side."""
    long = _sides_long(ref, cur, cols)
    q = exact_quantiles(long.filter("_side = 0"), "value", [i / bins for i in range(1, bins)], ["column"])
    fitted: dict[str, list[float]] = {}
    for row in q.orderBy("column", "qi").collect():
        fitted.setdefault(row["column"], []).append(float(row["value"]))
    if not fitted:  # no reference values at all: nothing to compare
        return long.limit(0).select("column", F.lit(0).cast("long").alias("n_cur"), F.lit(0.0).alias("psi"))
    edges = F.create_map(*[x for c, e in fitted.items() for x in (F.lit(c), F.array(*[F.lit(v) for v in e]))])
    counts = long.groupBy("column", bin_index(F.col("value"), edges[F.col("column")], bins - 1).alias("bin")) \
        .agg(F.count_if(F.col("_side") == 0).alias("n_r"), F.count_if(F.col("_side") == 1).alias("n"))
    tot = counts.groupBy("column").agg(F.sum("n").alias("n_cur"), F.sum("n_r").alias("n_ref")).filter("n_cur > 0 and n_ref > 0")
    grid = tot.select("column", "n_cur", "n_ref", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    full = grid.join(counts, ["column", "bin"], "left").fillna(0, ["n", "n_r"])
    c = F.greatest(F.col("n") / F.col("n_cur"), F.lit(PSI_EPS))
    r = F.greatest(F.col("n_r") / F.col("n_ref"), F.lit(PSI_EPS))
    return full.groupBy("column", "n_cur").agg(F.sum((c - r) * F.log(c / r)).alias("psi"))


# D3 / D4 report --------------------------------------------------------------------
NUM_TESTS = ("ks", "wasserstein")
CAT_TESTS = ("chisquare", "z", "jensenshannon")


def drift_report(ref: DataFrame, cur: DataFrame, num_cols: Sequence[str] = (), cat_cols: Sequence[str] = (),
                 num_test: str = "wasserstein", cat_test: str = "jensenshannon") -> DataFrame:
    """(column, stattest, score, threshold, drifted) per column, by the one test named per type: the same
    statistic at every table size.  Numeric: KS p-value or normed Wasserstein distance; categorical:
    chi-square p-value, two-proportion z p-value (binary columns) or Jensen-Shannon distance.
    """
    if num_test not in NUM_TESTS or cat_test not in CAT_TESTS:
        raise ValueError(f"unknown drift test: {num_test!r}, {cat_test!r}; choose from {NUM_TESTS} and {CAT_TESTS}")
    parts = []
    if num_cols:
        nd = numeric_drift(ref, cur, num_cols)
        nd = nd.withColumn("stattest", F.lit(num_test))
        score = F.when(F.col("stattest") == "ks", F.col("ks_p_value")).otherwise(F.col("wasserstein_norm"))
        thr = F.when(F.col("stattest") == "ks", F.lit(P_VALUE_THRESHOLD)).otherwise(F.lit(DISTANCE_THRESHOLD))
        parts.append(nd.select("column", "stattest", score.alias("score"), thr.alias("threshold")))
    if cat_cols:
        cd = categorical_drift(ref, cur, cat_cols, p_values=cat_test != "jensenshannon").withColumn("stattest", F.lit(cat_test))
        score = F.when(F.col("stattest") == "chisquare", F.col("chi2_p_value")) \
            .when(F.col("stattest") == "z", F.col("z_p_value")).otherwise(F.col("js_distance"))
        thr = F.when(F.col("stattest") == "jensenshannon", F.lit(DISTANCE_THRESHOLD)).otherwise(F.lit(P_VALUE_THRESHOLD))
        parts.append(cd.select("column", "stattest", score.alias("score"), thr.alias("threshold")))
    rep = parts[0]
    for p in parts[1:]:
        rep = rep.unionByName(p)
    is_p = F.col("stattest").isin("ks", "chisquare", "z")
    drifted = F.when(is_p, F.col("score") < F.col("threshold")).otherwise(F.col("score") >= F.col("threshold"))
    return rep.withColumn("drifted", F.coalesce(drifted, F.lit(False)))


def dataset_drift(report: DataFrame, share: float = DRIFT_SHARE) -> DataFrame:
    """D4: share of drifted columns and the decision ``share >= threshold``.
    An empty current frame gives no drift (not an error)."""
    r = report.agg(F.count(F.lit(1)).alias("n_columns"), F.count_if("drifted").alias("n_drifted"))
    sh = F.col("n_drifted") / F.nullif(F.col("n_columns"), F.lit(0))
    return r.select("n_columns", "n_drifted", F.coalesce(sh, F.lit(0.0)).alias("drift_share"),
                    F.coalesce(sh >= F.lit(share), F.lit(False)).alias("dataset_drift"))


def detect_drift(ref: DataFrame, cur: DataFrame, num_cols=(), cat_cols=(), share: float = DRIFT_SHARE,
                 num_test: str = "wasserstein", cat_test: str = "jensenshannon") -> DataFrame:
    """D4 with the empty-current rule applied before any statistics are computed."""
    has_rows = cur.select(F.count(F.lit(1))).scalar() > 0
    dd = dataset_drift(drift_report(ref, cur, num_cols, cat_cols, num_test, cat_test), share)
    return dd.withColumn("dataset_drift", F.col("dataset_drift") & has_rows)


# D7 / D5 windowed ------------------------------------------------------------------
def reference_bins(ref: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """One row: exact inner quantile edges of the reference column (``bins - 1`` values)."""
    probs = [i / bins for i in range(1, bins)]
    q = exact_quantiles(ref, col, probs)
    return q.agg(F.array_sort(F.collect_list(F.struct("qi", "value"))).alias("_e")) \
        .select(F.transform("_e", lambda s: s["value"]).alias("edges"))


def bin_index(x, edges, n_edges: int):
    """Bin of x for ascending edges: number of edges strictly below x (a sum of
    ``n_edges`` comparisons — no lambda, so ``edges`` may be a scalar subquery)."""
    return sum((F.when(F.element_at(edges, i + 1) < x, 1).otherwise(0) for i in range(n_edges)), F.lit(0))


def reference_bin_shares(ref: DataFrame, col: str, bins: int = 10) -> tuple[list[float], list[float]]:
    """The reference side of PSI as fitted parameters: ``bins - 1`` exact quantile edges and the
    ``bins`` reference shares (2 * bins - 1 numbers, fetched once)."""
    edges = [float(e) for e in reference_bins(ref, col, bins).first()["edges"]]
    arr = F.array(*[F.lit(e) for e in edges])
    x = F.col(col).cast("double")
    counts = {r["bin"]: r["n"] for r in ref.filter(x.isNotNull() & ~F.isnan(x)).groupBy(
        bin_index(x, arr, bins - 1).alias("bin")).agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    return edges, [counts.get(b, 0) / total if total else 0.0 for b in range(bins)]


def windowed_psi(ref: DataFrame, cur: DataFrame, ts_col: str, col: str, window: str = "1 day",
                 bins: int = 10) -> DataFrame:
    """PSI of each tumbling window of ``cur`` against reference decile bins.

    The reference enters as 9 edges (one broadcast row) and 10 shares; each window
    contributes (window, bin) counts.  Empty bins count as share 0.0001."""
    # the reference's bins are a fitted parameter: bins - 1 numbers, fetched once and
    # projected as literals (like the standardiser), so every row compares to constants
    edges = F.array(*[F.lit(float(e)) for e in reference_bins(ref, col, bins).first()["edges"]])
    rb = ref.select(F.col(col).cast("double").alias("_x")).filter(F.col("_x").isNotNull() & ~F.isnan("_x"))
    ref_sh = rb.groupBy(bin_index(F.col("_x"), edges, bins - 1).alias("bin")).agg(F.count(F.lit(1)).alias("_rn"))
    # at most ``bins`` rows: the un-partitioned window is over a tiny frame
    ref_sh = ref_sh.select("bin", (F.col("_rn") / F.sum("_rn").over(Window.partitionBy())).alias("ref_share"))
    cb = cur.select(F.window(ts_col, window).alias("w"), F.col(col).cast("double").alias("_x")) \
        .filter(F.col("_x").isNotNull() & ~F.isnan("_x"))
    counts = cb.groupBy("w", bin_index(F.col("_x"), edges, bins - 1).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return psi_from_counts(counts, ref_sh, bins, col)


def psi_from_counts(counts: DataFrame, ref_shares: DataFrame, bins: int, col: str) -> DataFrame:
    """PSI per window from (w, bin, n) counts and (bin, ref_share); also used on
    streamed bin counts."""
    wins = counts.groupBy("w").agg(F.sum("n").alias("n_rows"))
    grid = wins.select("w", "n_rows", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    full = grid.join(counts, ["w", "bin"], "left").join(F.broadcast(ref_shares), "bin", "left").fillna(0, ["n"])
    c = F.greatest(F.col("n") / F.col("n_rows"), F.lit(PSI_EPS))
    r = F.greatest(F.coalesce(F.col("ref_share"), F.lit(0.0)), F.lit(PSI_EPS))
    return full.groupBy("w", "n_rows").agg(F.sum((c - r) * F.log(c / r)).alias("value")).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        F.lit(col).alias("column"), F.lit("psi").alias("statistic"), "value", "n_rows")


def reference_profile(ref: DataFrame, cols: Sequence[str], bins: int = 10) -> DataFrame:
    """The reference side of PSI as a table of one row per column: (column, edges, shares, n_ref).  Stored once, it stands
    for the reference in every later check, whose cost no longer depends on the reference's rows."""
    long = df_long(ref, cols)
    q = exact_quantiles(long, "value", [i / bins for i in range(1, bins)], ["column"])
    edges = stored(q.groupBy("column").agg(F.array_sort(F.collect_list(F.struct("qi", "value"))).alias("_e")).select("column", F.transform("_e", lambda e: e["value"]).alias("edges")), "reference-edges")
    counts = long.join(edges, "column").groupBy("column", bin_index(F.col("value"), F.col("edges"), bins - 1).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    per_bin = F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda b: F.coalesce(F.element_at(F.col("_c"), b), F.lit(0)))
    found = counts.groupBy("column").agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("_c"), F.sum("n").alias("n_ref"))  # bins entries
    shares = found.select("column", "n_ref", F.transform(per_bin, lambda n: n / F.col("n_ref")).alias("shares"))
    return edges.join(shares, "column").select("column", "edges", "shares", "n_ref")


def df_long(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., column, value) of the numeric columns; null and NaN belong to no bin."""
    wide = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in cols])
    return wide.unpivot(list(keep), list(cols), "column", "value").filter(F.col("value").isNotNull() & ~F.isnan("value"))


def binned(long: DataFrame, profile: list) -> DataFrame:
    """``long`` with the reference bin of each value.  The profile's edges (columns x bins numbers) are projected as literals,
    so it works on batch and streaming frames alike."""
    edges = F.create_map(*[x for r in profile for x in (F.lit(r["column"]), F.array(*[F.lit(float(e)) for e in r["edges"]]))])
    n_edges = max((len(r["edges"]) for r in profile), default=0)
    return long.withColumn("bin", bin_index(F.col("value"), edges[F.col("column")], n_edges))


def psi_by_column(counts: DataFrame, profile: list, by: Sequence[str] = (), threshold: float = PSI_THRESHOLD) -> DataFrame:
    """(by..., column, n_rows, psi, drifted) from (by..., column, bin, n) counts; empty bins count as share 0.0001.

    A group's counts of one column become one map of at most ``bins`` entries; no join."""
    by = list(by)
    of_column = F.create_map(*[x for r in profile for x in (F.lit(r["column"]), F.array(*[F.lit(float(v)) for v in r["shares"]]))])
    per = counts.groupBy(*by, "column").agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("_c"), F.sum("n").alias("n_rows"))
    shares = per.withColumn("_r", of_column[F.col("column")])

    def term(r, b):
        c = F.greatest(F.coalesce(F.element_at(F.col("_c"), b), F.lit(0)) / F.col("n_rows"), F.lit(PSI_EPS))
        ref = F.greatest(r, F.lit(PSI_EPS))
        return (c - ref) * F.log(c / ref)

    psi = F.aggregate(F.transform("_r", term), F.lit(0.0), lambda a, x: a + x)
    return shares.select(*by, "column", "n_rows", psi.alias("psi")).withColumn("drifted", F.col("psi") >= threshold)


def drift_share_by(psi: DataFrame, n_columns: int, by: Sequence[str] = (), share: float = DRIFT_SHARE) -> DataFrame:
    """D4 for each group: (by..., n_columns, n_drifted, drift_share, dataset_drift) of the monitored columns."""
    r = psi.groupBy(*by).agg(F.count_if("drifted").alias("n_drifted"))
    out = F.col("n_drifted") / F.lit(n_columns)
    return r.select(*by, F.lit(n_columns).cast("long").alias("n_columns"), "n_drifted", out.alias("drift_share"), (out >= share).alias("dataset_drift"))


def windowed_drift(cur: DataFrame, profile: list, ts_col: str, cols: Sequence[str], window: str = "1 day", threshold: float = PSI_THRESHOLD,
                   share: float = DRIFT_SHARE) -> DataFrame:
    """D7 over many columns: one (window, column, bin) count in one pass over ``cur``, PSI per column and the dataset
    decision per window from it."""
    long = df_long(cur.withColumn("_w", F.window(ts_col, window)), cols, ["_w"])
    counts = binned(long, profile).groupBy("_w", "column", "bin").agg(F.count(F.lit(1)).alias("n"))
    out = drift_share_by(psi_by_column(counts, profile, ["_w"], threshold), len(cols), ["_w"], share)
    return out.select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "n_columns", "n_drifted", "drift_share", "dataset_drift")


def windowed_js(ref: DataFrame, cur: DataFrame, ts_col: str, col: str, window: str = "1 day") -> DataFrame:
    """Jensen-Shannon distance (natural log) of each window's category shares to the
    reference shares.

    No window x category grid: a reference category absent from a window contributes
    exactly 0.5 * p * ln 2, so those terms sum to 0.5 * ln 2 * (1 - sum of p over the
    categories the window has).  Only (window, category) counts present in the data are
    aggregated; the reference shares are joined by category (AQE sizes that join)."""
    rc = ref.groupBy(F.col(col).cast("string").alias("cat")).agg(F.count(F.lit(1)).alias("_rn"))
    rs = rc.select("cat", (F.col("_rn") / rc.select(F.sum("_rn")).scalar()).alias("p"))  # total: scalar subquery
    cc = cur.groupBy(F.window(ts_col, window).alias("w"), F.col(col).cast("string").alias("cat")) \
        .agg(F.count(F.lit(1)).alias("n"))
    wins = cc.groupBy("w").agg(F.sum("n").alias("n_rows"))
    present = null_safe_join(cc.join(wins, "w"), rs, ["cat"], "left").fillna(0.0, ["p"])  # null is a category like any other
    q = F.col("n") / F.col("n_rows")
    p = F.col("p")
    m = (p + q) / 2
    term = F.when(p > 0, p * F.log(p / m)).otherwise(F.lit(0.0)) + q * F.log(q / m)
    agg = present.groupBy("w", "n_rows").agg(F.sum(term).alias("_t"), F.sum(p).alias("_pp"))
    js2 = F.lit(0.5) * F.col("_t") + F.lit(0.5 * math.log(2.0)) * (F.lit(1.0) - F.col("_pp"))
    return agg.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      F.lit(col).alias("column"), F.lit("jensenshannon").alias("statistic"),
                      F.sqrt(F.greatest(F.lit(0.0), js2)).alias("value"), "n_rows")


# D8 -----------------------------------------------------------------------------
def drift_alerts(windowed: DataFrame, thresholds: dict[str, float]) -> DataFrame:
    """One alert row per (window, column) whose statistic exceeds its threshold."""
    thr = F.create_map(*[x for k, v in thresholds.items() for x in (F.lit(k), F.lit(float(v)))])
    t = thr[F.col("statistic")]
    return windowed.filter(F.col("value") > t).select(
        "window_start", "window_end", "column", "statistic", "value", t.alias("threshold"),
        F.format_string("drift alert: %s %s = %.4f above %.4f in window starting %s", F.col("column"),
                        F.col("statistic"), F.col("value"), t, F.col("window_start").cast("string")).alias("message"))


# D6 -----------------------------------------------------------------------------
def delayed_label_quality(predictions: DataFrame, labels: DataFrame, key: str, threshold: float = 0.5,
                          label: str = "y", score: str = "p", by: Sequence[str] = ()) -> DataFrame:
    """Join predictions with labels that arrive later (equi-join on the key; both sides
    shuffle on a uniform key), then confusion counts and PR-AUC per group.
    Unlabelled predictions are counted apart; a group without any label keeps its row (counts 0, no
    PR-AUC).  A key with two labels fails the job."""
    by = list(by)
    one = labels.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), *[F.any_value(c).alias(c) for c in labels.columns if c != key])
    first = F.when(F.col("_n") > 1, F.raise_error(F.lit(f"{key} has more than one label")).cast(labels.schema[label].dataType)).otherwise(F.col(label))
    j = predictions.join(one.withColumn(label, first).drop("_n"), key, "left")
    labelled = j.filter(F.col(label).isNotNull())
    pending = j.groupBy(*by).agg(F.count_if(F.col(label).isNull()).alias("n_unlabelled"))
    if by:
        joined = null_safe_join(pending, E.model_metrics(labelled, threshold, label, score, by), by, "left")
        return joined.fillna(0, ["tp", "fp", "fn", "tn"]).select(*by, *[c for c in joined.columns if c not in (*by, "n_unlabelled")], "n_unlabelled")
    # one group: one-row results attached as scalar subqueries (no constant-key join)
    m = E.classification_metrics(labelled, threshold, label, score)
    return m.select("*", E.average_precision(labelled, label, score).select("pr_auc").scalar().alias("pr_auc"),
                    pending.select("n_unlabelled").scalar().alias("n_unlabelled"))


def score_histogram(joined: DataFrame, by: Sequence[str], buckets: int, label: str = "y", score: str = "p") -> DataFrame:
    """(by..., bucket, n_pos, n_neg, n_unlabelled): a mergeable state of scores and labels.  Bucket b holds the scores that
    round to b / buckets; histograms of different rows merge by addition."""
    b = F.round(F.col(score) * buckets).cast("int")
    return joined.groupBy(*by, b.alias("bucket")).agg(F.count_if(F.col(label) == 1).alias("n_pos"), F.count_if(F.col(label) != 1).alias("n_neg"), F.count_if(F.col(label).isNull()).alias("n_unlabelled"))


def quality_from_histogram(histogram: DataFrame, by: Sequence[str], buckets: int, threshold: float = 0.5) -> DataFrame:
    """Confusion counts, rates, PR-AUC (a bucket is one step), n_labelled and n_unlabelled per group; ``histogram`` may hold
    any number of partial rows per bucket."""
    by = list(by)
    merged = histogram.groupBy(*by, "bucket").agg(*[F.sum(c).alias(c) for c in ("n_pos", "n_neg", "n_unlabelled")])
    w = Window.partitionBy(*by).orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, 0)  # at most ``buckets`` + 1 rows
    run = merged.withColumns({"tps": F.sum("n_pos").over(w), "seen": F.sum(F.col("n_pos") + F.col("n_neg")).over(w)})
    hit = F.col("bucket") >= F.lit(threshold * buckets)
    step = F.when(F.col("n_pos") > 0, F.col("n_pos") * (F.col("tps") / F.col("seen"))).otherwise(0.0)
    out = run.groupBy(*by).agg(
        *[F.coalesce(F.sum(F.when(c, n)), F.lit(0)).alias(name) for name, c, n in (("tp", hit, F.col("n_pos")), ("fp", hit, F.col("n_neg")), ("fn", ~hit, F.col("n_pos")), ("tn", ~hit, F.col("n_neg")))],
        (F.sum(step) / F.nullif(F.sum("n_pos"), F.lit(0))).alias("pr_auc"), F.sum(F.col("n_pos") + F.col("n_neg")).alias("n_labelled"), F.sum("n_unlabelled").alias("n_unlabelled"))
    return E.with_rates(out).withColumn("pr_auc", F.when(F.col("n_labelled") > 0, F.coalesce("pr_auc", F.lit(0.0))))


# D10 ----------------------------------------------------------------------------
def hash_normal(seed, tag, *key_cols):
    """A standard normal per key from two seeded hash uniforms (Box-Muller): repeatable on
    any partitioning, unlike ``randn(seed)``."""
    tag = F.lit(tag) if isinstance(tag, str) else tag
    u1 = hash_uniform(seed, F.concat(tag, F.lit(":1")), *key_cols)
    u2 = hash_uniform(seed, F.concat(tag, F.lit(":2")), *key_cols)
    return F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - u1)) * F.cos(F.lit(2 * math.pi) * u2)


def inject_drift(df: DataFrame, key_cols, feature_cols: Sequence[str] = (), amount_col: str | None = "Amount",
                 time_col: str | None = "Time", seed: int = 0, scale: float = 2.0, shift: float = 3.0,
                 mode: str = "shift") -> DataFrame:
    """Drifted rows, deterministic per key.  Features: ``x*scale + shift`` (mode "shift",
    exact for SQL checks) or a fresh draw ``N(shift, scale)`` (mode "resample", the
    published demo: V ~ N(3, 2)).  Amount uniform on [1000, 5000), Time uniform on
    [0, 200000), all from seeded hashes of the key."""
    features = list(feature_cols)
    if mode == "resample" and features:  # one function over the names: the plan stays small for many features
        drawn = F.transform(F.array(*[F.lit(c) for c in features]), lambda c: F.lit(shift) + F.lit(scale) * hash_normal(seed, c, *key_cols))
        out = df.withColumn("_drawn", drawn).withColumns({c: F.col("_drawn")[i] for i, c in enumerate(features)}).drop("_drawn")
    else:
        out = df.withColumns({c: F.col(c) * F.lit(scale) + F.lit(shift) for c in features}) if features else df
    if amount_col:
        out = out.withColumn(amount_col, F.lit(1000.0) + F.lit(4000.0) * hash_uniform(seed, F.lit("amount"), *key_cols))
    if time_col:
        out = out.withColumn(time_col, F.lit(200000.0) * hash_uniform(seed, F.lit("time"), *key_cols))
    return out


# D11 / D12 ------------------------------------------------------------------------
def assign_arm(df: DataFrame, key_cols, challenger_share: float = 0.1, seed: int = 42, arm_col: str = "arm") -> DataFrame:
    """Stable traffic split: a row goes to the challenger when its key's hash uniform is below the share."""
    u = hash_uniform(seed, *key_cols)
    return df.withColumn(arm_col, F.when(u < F.lit(float(challenger_share)), "challenger").otherwise("champion"))


def shadow_agreement(scored_a: DataFrame, scored_b: DataFrame, key: str, threshold: float = 0.5,
                     score: str = "p", label: str | None = "y") -> DataFrame:
    """Both models score the same rows: agreement matrix of their decisions, with the
    share of each cell and (when labels exist) the positives in each cell."""
    a = scored_a.select(key, *([label] if label else []), (F.col(score) >= threshold).cast("int").alias("pred_a"))
    b = scored_b.select(key, (F.col(score) >= threshold).cast("int").alias("pred_b"))
    j = a.join(b, key)
    total = j.select(F.count(F.lit(1))).scalar()
    aggs = [F.count(F.lit(1)).alias("n")] + ([F.count_if(F.col(label) == 1).alias("n_pos")] if label else [])
    return j.groupBy("pred_a", "pred_b").agg(*aggs).withColumn("share", F.col("n") / total)


def shadow_metric_gap(scored_a: DataFrame, scored_b: DataFrame, key: str, threshold: float = 0.5,
                      score: str = "p", label: str = "y") -> DataFrame:
    """D12 metric gap: both models' PR-AUC, precision and recall on the rows they both scored,
    and the challenger-minus-champion differences (one row; per-model aggregates joined on
    the model key, then pivoted)."""
    a = scored_a.select(key, label, F.col(score).alias("p_a"))
    b = scored_b.select(key, F.col(score).alias("p_b"))
    both = a.join(b, key)
    long = both.select(label, F.explode(F.array(
        F.struct(F.lit("a").alias("m"), F.col("p_a").alias("p")),
        F.struct(F.lit("b").alias("m"), F.col("p_b").alias("p")))).alias("_s")).select(label, "_s.m", "_s.p")
    mm = E.model_metrics(long, threshold, label, "p", by=["m"])
    w = mm.groupBy().pivot("m", ["a", "b"]).agg(F.first("pr_auc").alias("pr_auc"), F.first("precision").alias("precision"),
                                                 F.first("recall").alias("recall"))
    return w.select(*[F.col(f"{m}_{x}") for m in ("a", "b") for x in ("pr_auc", "precision", "recall")],
                    *[(F.col(f"b_{x}") - F.col(f"a_{x}")).alias(f"gap_{x}") for x in ("pr_auc", "precision", "recall")])


# D13 ----------------------------------------------------------------------------
def linear_contributions(df: DataFrame, key_cols, weights: dict[str, float], means: dict[str, float],
                         k: int = 3) -> DataFrame:
    """Per row, the k features with the largest |w_i * (x_i - mean_i)| of a linear model:
    array functions within the row, no shuffle."""
    items = F.array(*[F.struct(F.lit(c).alias("feature"),
                               (F.lit(float(w)) * (F.col(c) - F.lit(float(means[c])))).alias("contribution"))
                      for c, w in weights.items()])
    ranked = F.slice(F.sort_array(F.transform(items, lambda s: F.struct(
        (-F.abs(s["contribution"])).alias("k1"), s["feature"].alias("feature"),
        s["contribution"].alias("contribution"))), asc=True), 1, k)
    return df.select(*key_cols, F.posexplode(ranked).alias("rank", "_c")).select(
        *key_cols, (F.col("rank") + 1).alias("rank"), "_c.feature", "_c.contribution")
