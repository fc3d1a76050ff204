"""Column-expression helpers.  All are built-in Spark expressions (JVM side, codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_HEX13 = float(16 ** 13)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_hex(seed, *cols) -> Column:
    """md5 hex of ``seed|col1|col2...``: a repeatable, partitioning-independent row order.

    ``rand(seed)`` depends on how rows are partitioned; this does not, and the same
    string is produced by ``md5(concat_ws('|', seed, ...))`` in any SQL engine.
    """
    parts = [F.lit(str(seed))] + [_col(c).cast("string") for c in cols]
    return F.md5(F.concat_ws("|", *parts))


def hash_uniform(seed, *cols) -> Column:
    """A uniform double in [0, 1) from the first 52 bits of :func:`hash_hex` (exact in a double)."""
    h = hash_hex(seed, *cols)
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("double") / F.lit(_HEX13)


def micros_between(start, end) -> Column:
    """Microseconds from ``start`` to ``end`` for TIMESTAMP_NTZ (or TIMESTAMP) values.

    Computed from calendar parts, so it never goes through the session time zone.
    """
    s, e = _col(start), _col(end)

    def day_micros(c):
        return (F.hour(c).cast("long") * 3_600_000_000 + F.minute(c).cast("long") * 60_000_000
                + (F.date_part(F.lit("SECOND"), c) * 1_000_000).cast("long"))

    days = F.datediff(F.to_date(e), F.to_date(s)).cast("long")
    return days * 86_400_000_000 + day_micros(e) - day_micros(s)


def seconds_between(start, end) -> Column:
    return micros_between(start, end).cast("double") / F.lit(1e6)


def hour_of_day(seconds) -> Column:
    """Hour of day of a *seconds since first row* clock: ``floor(t / 3600) % 24``."""
    return F.pmod(F.floor(_col(seconds) / F.lit(3600.0)), F.lit(24)).cast("long")


def safe_div(num, den, default: float = 0.0) -> Column:
    """``num / den``, or ``default`` when the denominator is 0 (undefined precision etc.)."""
    n, d = _col(num), _col(den)
    return F.when(d == 0, F.lit(default)).otherwise(n.cast("double") / d)


def null_safe_join(left, right, keys, how: str = "inner"):
    """Equi-join on ``keys`` in which null equals null; the keys appear once (the left side's)."""
    keys = list(keys)
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def label_flag(cond: Column) -> Column:
    """A boolean condition as a 0/1 long label."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0)).cast("long")


def linspace_value(i, start: float, stop: float, num: int) -> Column:
    """The i-th value of ``numpy.linspace(start, stop, num)``, bit for bit: ``i*step + start``."""
    step = (stop - start) / (num - 1)
    return _col(i).cast("double") * F.lit(step) + F.lit(start)


_EPOCH_NTZ = "1970-01-01 00:00:00"


def ntz_to_instant(ts) -> Column:
    """TIMESTAMP_NTZ wall-clock value -> TIMESTAMP instant read as UTC (no session time zone)."""
    return F.timestamp_micros(micros_between(F.lit(_EPOCH_NTZ).cast("timestamp_ntz"), _col(ts)))


def instant_to_ntz(ts) -> Column:
    """TIMESTAMP instant -> its UTC wall clock as TIMESTAMP_NTZ (no session time zone)."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_col(ts)), F.lit(_EPOCH_NTZ).cast("timestamp_ntz"))
