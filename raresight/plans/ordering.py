"""Exact order statistics without a global sort.

``hash_rank_cutoffs``: for each class, the hash value at given per-class ranks.
Hashes are uniform, so counting rows per hex prefix gives balanced buckets; prefix sums of those counts locate the one bucket that
holds each rank, and only that bucket's rows are ranked.  Used for the exact
stratified split and stratified folds; ``hash_rank`` gives every row its global
rank the same way (SMOTE's even allocation).

``exact_quantiles``: exact, linearly interpolated quantiles of arbitrary values.
Counts over buckets that follow the order of doubles locate the wanted ranks, counts over cells of
those buckets narrow them, and the few cells' distinct values are ranked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from raresight.functions import null_safe_join
from raresight.session import stored

PREFIX = 5  # hex digits: about a million buckets, the same at every size


def hash_rank_cutoffs(df: DataFrame, h_col: str, fractions, class_cols=(), prefix_len: int = PREFIX,
                      ranks_from_counts=None) -> DataFrame:
    """Per class and target ``j``: ``need`` = floor(n_class * fractions[j]) and
    ``cutoff`` = the ``need``-th smallest hash (rows with ``h <= cutoff`` are the first
    ``need``).  Classes whose ``need`` is 0 get no row; a null class is a class.  Rows whose
    equal hashes straddle a cut-off fail the job: the key is then not unique.

    ``ranks_from_counts(total_col, j_col)`` may override how ``need`` is derived.
    """
    class_cols = list(class_cols)
    bucket = F.substring(F.col(h_col), 1, prefix_len)
    counts = df.groupBy(*class_cols, bucket.alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    wc = Window.partitionBy(*class_cols)
    cum = counts.select(
        "*",
        F.sum("_n").over(wc.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)).alias("_incl"),
        F.sum("_n").over(wc).alias("_tot"),
    )
    # explode the targets only after the running sums (a generator in the same select
    # would be applied first and multiply the counts)
    cum = cum.select("*", F.posexplode(F.array(*[F.lit(float(f)) for f in fractions])).alias("_j", "_frac"))
    if ranks_from_counts is None:
        need = F.floor(F.col("_tot").cast("double") * F.col("_frac"))
    else:
        need = ranks_from_counts(F.col("_tot"), F.col("_j"))
    cum = cum.withColumn("_need", need.cast("long"))
    boundary = cum.filter((F.col("_incl") - F.col("_n") < F.col("_need")) & (F.col("_need") <= F.col("_incl"))) \
        .select(*class_cols, "_b", "_j", "_need", (F.col("_need") - F.col("_incl") + F.col("_n")).alias("_r"))
    # boundary: one row per (class, target), stored: the join is sized by what it holds
    cand = null_safe_join(df.select(*class_cols, F.col(h_col).alias("_h"), bucket.alias("_b")),
                          stored(boundary, "rank-boundaries"), [*class_cols, "_b"])
    wr = Window.partitionBy(*class_cols, "_j").orderBy("_h")
    ranked = cand.withColumns({"_rn": F.row_number().over(wr), "_next": F.lead("_h").over(wr)}).filter(F.col("_rn") == F.col("_r"))
    cutoff = F.when(F.col("_next") == F.col("_h"), F.raise_error(F.lit("rows with equal keys straddle a cut-off: the key is not unique"))) \
        .otherwise(F.col("_h"))
    return ranked.select(*class_cols, F.col("_j").alias("j"), F.col("_need").alias("need"), cutoff.alias("cutoff"))


OCTAVE = 256  # buckets per power of two in the first round
CELLS = 65536  # cells of a bucket in the second


def value_bucket(x) -> Column:
    """A bucket that never falls as ``x`` rises: sign, then 256 steps per power of two; at most about a million.
    (Java's log is semi-monotonic, and so are floor and scaling.)"""
    size = F.when(F.abs(x) == float("inf"), F.lit(600_000)).otherwise(F.floor(F.log2(F.abs(x)) * OCTAVE) + 300_000)
    return F.when(x == 0, F.lit(0)).otherwise(F.signum(x) * size).cast("int")


def exact_quantiles(df: DataFrame, value_col: str, probs, group_cols=(), extra_aggs: dict | None = None, cells: int = CELLS) -> DataFrame:
    """Rows (group..., qi, q, n, value): exact quantile ``probs[qi]`` with linear
    interpolation between order statistics (the pandas / numpy default).

    NaN and null values are ignored, as pandas does; a null group is a group.  Three passes over the rows for
    all ranks of all groups together, the same at every size: counts per bucket of leading digits, counts per cell
    of the buckets that hold a wanted rank, and distinct values of the cells that hold one.  Each pass is a partial
    aggregate; the rows themselves never move, no sketch is built, and no group's value list is ever held by one
    task.  What decides between passes is a stored table of at most 2 x probs rows per group.

    ``extra_aggs`` ({name: aggregate over ``_x``}) are returned on every row of their group (e.g. describe's moments).
    """
    group_cols, probs = list(group_cols), [float(q) for q in probs]
    x = F.col(value_col).cast("double")
    clean = df.select(*group_cols, x.alias("_x")).filter(F.col("_x").isNotNull() & ~F.isnan("_x")).withColumn("_b", value_bucket(F.col("_x")))
    edges = [F.count(F.lit(1)).alias("_c"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi")]

    def located(counted: DataFrame, keys: list[str], at: str, targets: DataFrame | None) -> DataFrame:
        """The wanted ranks with the row of ``counted`` that holds them.  ``_ahead``: rows of the group before it."""
        w = Window.partitionBy(*keys)
        cum = counted.withColumn("_upto", F.sum("_c").over(w.orderBy(at).rowsBetween(Window.unboundedPreceding, 0)))
        if targets is None:  # first round: the group's size gives its ranks
            cum = cum.withColumn("_n", F.sum("_c").over(w))
            h = [(F.col("_n") - 1).cast("double") * q for q in probs]
            ranks = F.array(*[F.struct(F.lit(i).alias("qi"), F.lit(side).alias("side"), F.least(F.floor(v).cast("long") + side, F.col("_n") - 1).alias("rank"))
                              for i, v in enumerate(h) for side in (0, 1)])
            found = cum.withColumn("_r", F.explode(ranks)).select("*", "_r.*").drop("_r").withColumn("_before", F.lit(0).cast("long"))
        else:
            found = null_safe_join(cum, targets.select(*keys, "qi", "side", "rank", "_n", F.col("_ahead").alias("_before")), keys)
        within = F.col("rank") - F.col("_before")
        held = found.filter((F.col("_upto") - F.col("_c") <= within) & (within < F.col("_upto")))
        return held.withColumn("_ahead", F.col("_before") + F.col("_upto") - F.col("_c")).drop("_before", "_upto", "_c")

    first = stored(located(clean.groupBy(*group_cols, "_b").agg(*edges), group_cols, "_b", None), "quantile-buckets")
    keys = [*group_cols, "_b"]
    wide = first.filter("_lo < _hi")
    brackets = stored(wide.select(*keys, F.col("_lo").alias("_from"), F.col("_hi").alias("_to")).distinct(), "quantile-brackets")
    share = (F.col("_x") - F.col("_from")) / (F.col("_to") - F.col("_from"))
    inside = null_safe_join(clean, brackets, keys).withColumn("_cell", F.floor(share * cells).cast("int"))
    second = stored(located(inside.groupBy(*keys, "_cell").agg(*edges), keys, "_cell", wide), "quantile-cells")
    keys2 = [*keys, "_cell"]
    wide2 = second.filter("_lo < _hi")
    chosen = null_safe_join(inside, stored(wide2.select(*keys2).distinct(), "quantile-chosen"), keys2)
    distinct = chosen.groupBy(*keys2, "_x").agg(F.count(F.lit(1)).alias("_c"))
    third = located(distinct, keys2, "_x", wide2)
    columns = [*group_cols, "qi", "side", "_n"]
    values = (first.filter("_lo = _hi").select(*columns, F.col("_lo").alias("_v"))
              .union(second.filter("_lo = _hi").select(*columns, F.col("_lo").alias("_v"))).union(third.select(*columns, F.col("_x").alias("_v"))))
    both = values.groupBy(*group_cols, "qi", "_n").agg(F.max(F.when(F.col("side") == 0, F.col("_v"))).alias("_v0"), F.max(F.when(F.col("side") == 1, F.col("_v"))).alias("_v1"))
    q = F.element_at(F.array(*[F.lit(p) for p in probs]), F.col("qi") + 1)
    h = (F.col("_n") - 1).cast("double") * q
    part = (h - F.floor(h)) * (F.col("_v1") - F.col("_v0"))
    missed = F.col("_v0").isNull() | F.col("_v1").isNull()
    value = F.when(missed, F.raise_error(F.lit("a quantile's bracket misses its rank")).cast("double")).when(F.col("_v0") == F.col("_v1"), F.col("_v0")).otherwise(F.col("_v0") + part)
    out = both.select(*group_cols, "qi", q.alias("q"), F.col("_n").alias("n"), value.alias("value"))
    if not extra_aggs:
        return out
    stats = stored(clean.groupBy(*group_cols).agg(*[a.alias(n) for n, a in extra_aggs.items()]), "quantile-stats")
    if group_cols:
        return null_safe_join(out, stats, group_cols)
    return out.select("*", *[stats.select(n).scalar().alias(n) for n in extra_aggs])


def hash_rank(df: DataFrame, h_col: str, prefix_len: int = PREFIX, rank_col: str = "rank") -> DataFrame:
    """Global 0-based rank of every row by a (uniform) hash, without a single-task sort:
    counts per hex prefix, exclusive prefix sums over the (bounded) bucket table, then
    ``row_number`` inside each bucket — buckets are balanced because hashes are uniform."""
    bucket = F.substring(F.col(h_col), 1, prefix_len)
    counts = df.groupBy(bucket.alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    # running sums in two steps: over the buckets of one leading digit, and over the digits
    counts = counts.withColumn("_d", F.substring("_b", 1, 1))
    digits = counts.groupBy("_d").agg(F.sum("_n").alias("_dn"))
    ahead = digits.select("_d", F.coalesce(F.sum("_dn").over(Window.orderBy("_d").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_doff"))
    inner = F.coalesce(F.sum("_n").over(Window.partitionBy("_d").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.withColumn("_in", inner).join(ahead, "_d").select("_b", (F.col("_in") + F.col("_doff")).alias("_off"))
    j = df.withColumn("_b", bucket).join(offsets, "_b")
    rn = F.row_number().over(Window.partitionBy("_b").orderBy(h_col))
    return j.withColumn(rank_col, (F.col("_off") + rn - 1).cast("long")).drop("_b", "_off")
