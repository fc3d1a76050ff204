"""Global running sums over an ordered value, without a single-task window.

``Window.orderBy(x)`` with no partition pulls every row into one task.  Instead the values fall into
buckets that follow their order, by their own leading digits (``value_bucket``): no sketch, no list of splits on
the driver, and no cap on the number of buckets.

1. totals per (group, bucket), and exclusive prefix sums of them;
2. where a bucket holds more than ``limit`` values, buckets of buckets: 65,536 cells each, and 16,384 parts of a
   cell; their totals are prefix-summed inside the level above.  A part holds at most 2^14 different doubles, so no
   window is larger than that, however the values cluster;
3. a window inside each (group, bucket) of the last level, plus its offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from raresight.functions import null_safe_join
from raresight.plans.ordering import CELLS, OCTAVE, value_bucket
from raresight.session import stored

LIMIT = 1 << 20  # values that one window orders
PARTS = 16384


def _levels(x: Column) -> list[Column]:
    """Bucket, cell and part of a value; each never falls as the value rises within the one above."""
    b = value_bucket(x)
    low = F.pow(F.lit(2.0), (F.abs(b) - 300_000) / OCTAVE)
    place = F.when((x == 0) | (F.abs(x) == float("inf")), F.lit(0.0)).otherwise((F.abs(x) / low - 1) / (2.0 ** (1 / OCTAVE) - 1) * CELLS)
    cell = F.least(F.greatest(F.floor(place), F.lit(0)), F.lit(CELLS - 1))
    part = F.least(F.greatest(F.floor((place - cell) * PARTS), F.lit(0)), F.lit(PARTS - 1))
    sign = F.signum(x)
    return [b, (sign * cell).cast("int"), (sign * part).cast("int")]


def cumulative_by_value(df: DataFrame, value_col: str, sum_cols: list[str], group_cols=(), descending: bool = True,
                        next_value: bool = False, limit: int = LIMIT) -> DataFrame:
    """Add ``cum_<c>``: sum of ``c`` over rows of the same group whose value comes
    at or before this row's value in the chosen order (inclusive).

    ``df`` must hold one row per (group, value), none null or NaN.  With ``next_value`` also add
    ``next_<value_col>``: the following value in the chosen order (null at the end).  The rows are stored once and
    read at most four times; ``limit`` decides how many levels there are, never the result.
    """
    group_cols = list(group_cols)
    names = ["_b", "_cell", "_part"]
    rows = stored(df.withColumns(dict(zip(names, _levels(F.col(value_col).cast("double"))))), "ordered-values")
    first = F.max(value_col) if descending else F.min(value_col)
    prefix = None
    for depth in range(1, len(names) + 1):
        above, keys = [*group_cols, *names[: depth - 1]], [*group_cols, *names[:depth]]
        totals = rows.groupBy(*keys).agg(*[F.sum(c).alias(f"_t_{c}") for c in sum_cols], first.alias("_first"), F.count(F.lit(1)).alias("_size"))
        order = F.col(names[depth - 1]).desc() if descending else F.col(names[depth - 1]).asc()
        w = Window.partitionBy(*above).orderBy(order)
        ahead = w.rowsBetween(Window.unboundedPreceding, -1)
        own = totals.select(*keys, "_size", *[F.coalesce(F.sum(f"_t_{c}").over(ahead), F.lit(0)).alias(f"_off_{c}") for c in sum_cols], F.lead("_first").over(w).alias("_next"))
        if prefix is not None:
            up = prefix.select(*above, *[F.col(f"_off_{c}").alias(f"_up_{c}") for c in sum_cols], F.col("_next").alias("_up_next"))
            own = null_safe_join(own, up, above).select(*keys, "_size", *[(F.col(f"_off_{c}") + F.col(f"_up_{c}")).alias(f"_off_{c}") for c in sum_cols],
                                                        F.coalesce("_next", "_up_next").alias("_next"))
        prefix = stored(own, "bucket-offsets")
        if (prefix.agg(F.max("_size")).first()[0] or 0) <= limit:
            break
    joined = null_safe_join(rows, prefix, keys)
    order = F.col(value_col).desc() if descending else F.col(value_col).asc()
    w = Window.partitionBy(*keys).orderBy(order)
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return joined.select(
        *df.columns,
        *[(F.sum(c).over(running) + F.col(f"_off_{c}")).alias(f"cum_{c}") for c in sum_cols],
        *([F.coalesce(F.lead(value_col).over(w), F.col("_next")).alias(f"next_{value_col}")] if next_value else []),
    )
