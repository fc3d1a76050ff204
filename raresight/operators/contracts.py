"""Data contracts (V1-V10): strict column set, coercion, not-null, range and domain
checks, evaluated lazily (every check, every failure) in one aggregate pass."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raresight.errors import ContractViolation
from raresight.sources.tables import V_COLUMNS

_FLOAT_TYPES = {"double", "float"}


@dataclass(frozen=True)
class Rule:
    column: str
    dtype: str = "double"          # Spark SQL type the column is coerced to
    nullable: bool = False
    ge: float | None = None        # range check: value >= ge
    isin: tuple | None = None      # domain check


@dataclass(frozen=True)
class Contract:
    name: str
    rules: tuple = field(default_factory=tuple)
    strict: bool = True            # unexpected columns fail


def raw_transaction_contract(features=tuple(V_COLUMNS), time="Time", amount="Amount", label="Class") -> Contract:
    """The raw contract: Time >= 0, features not null, Amount >= 0, Class in {0, 1}."""
    rules = []
    if time:
        rules.append(Rule(time, "double", ge=0.0))
    rules += [Rule(v, "double") for v in features]
    if amount:
        rules.append(Rule(amount, "double", ge=0.0))
    rules.append(Rule(label, "bigint", isin=(0, 1)))
    return Contract("raw", tuple(rules))


def processed_transaction_contract(features=tuple(V_COLUMNS), time="Time", amount="Amount", label="Class") -> Contract:
    """After standardisation Time and Amount may be negative: the range checks go."""
    rules = []
    if time:
        rules.append(Rule(time, "double"))
    rules += [Rule(v, "double") for v in features]
    if amount:
        rules.append(Rule(amount, "double"))
    rules.append(Rule(label, "bigint", isin=(0, 1)))
    return Contract("processed", tuple(rules))


def _fmt(v) -> str:
    return repr(v) if isinstance(v, str) else (str(int(v)) if float(v).is_integer() else str(v))


def check_expressions(contract: Contract, columns) -> list[tuple[str, str, object]]:
    """(column, check name, failure predicate) for every value-level check of present columns."""
    out = []
    for r in contract.rules:
        if r.column not in columns:
            continue
        src = F.col(r.column)
        cast = src.try_cast(r.dtype)
        out.append((r.column, f"dtype({r.dtype})", src.isNotNull() & cast.isNull()))
        if not r.nullable:
            null = src.isNull()
            if r.dtype in _FLOAT_TYPES:
                null = null | F.isnan(cast)
            out.append((r.column, "not_null", null))
        if r.ge is not None:
            out.append((r.column, f"ge({_fmt(r.ge)})", F.coalesce(cast < F.lit(r.ge), F.lit(False))))
        if r.isin is not None:
            vals = ",".join(_fmt(v) for v in r.isin)
            out.append((r.column, f"isin({vals})",
                        cast.isNotNull() & ~F.coalesce(cast.isin(*r.isin), F.lit(False))))
    return out


def structural_failures(df: DataFrame, contract: Contract) -> list[tuple[str, str]]:
    """V1: missing declared columns and (strict) unexpected columns — schema metadata only."""
    declared = [r.column for r in contract.rules]
    out = [(c, "missing_column") for c in declared if c not in df.columns]
    if contract.strict:
        out += [(c, "unexpected_column") for c in df.columns if c not in declared]
    return out


def contract_summary(df: DataFrame, contract: Contract) -> DataFrame:
    """V6 counts: (column, check, n_failed) for every check, in one aggregate pass.

    Value checks come from a single ``agg`` of ``count_if`` expressions turned to long
    form with ``stack``; structural failures are added as rows with ``n_failed = 1``.
    """
    checks = check_expressions(contract, df.columns)
    spark = df.sparkSession
    parts = []
    if checks:
        agg = df.agg(*[F.count_if(pred).alias(f"_c{i}") for i, (_, _, pred) in enumerate(checks)])
        args = [a for i, (c, chk, _) in enumerate(checks) for a in (F.lit(c), F.lit(chk), F.col(f"_c{i}"))]
        parts.append(agg.select(F.stack(F.lit(len(checks)), *args).alias("column", "check", "n_failed")))
    struct_rows = structural_failures(df, contract)
    if struct_rows:
        parts.append(spark.createDataFrame([(c, k, 1) for c, k in struct_rows], "column string, check string, n_failed bigint"))
    if not parts:
        return spark.createDataFrame([], "column string, check string, n_failed bigint")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def failure_cases(df: DataFrame, contract: Contract, key_cols) -> DataFrame:
    """V6 cases: one row per failing value (key..., column, check, failure_case), and one per missing or
    unexpected column (null key, the column's name as the case).

    A narrow ``explode(filter(array(struct ...)))`` per row: no shuffle, no collect.
    """
    checks = check_expressions(contract, df.columns)
    key_cols = list(key_cols)
    spark = df.sparkSession
    found = spark.createDataFrame([(c, k, c) for c, k in structural_failures(df, contract)], "column string, check string, failure_case string")
    keys = [F.lit(None).cast(df.schema[k].dataType).alias(k) for k in key_cols]
    structural = found.select(*keys, "column", "check", "failure_case")
    if not checks:
        return structural
    items = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(chk).alias("check"),
                               F.col(c).cast("string").alias("failure_case"), pred.alias("failed"))
                      for c, chk, pred in checks])
    cases = df.select(*key_cols, F.explode(F.filter(items, lambda s: s["failed"])).alias("_f")) \
        .select(*key_cols, "_f.column", "_f.check", "_f.failure_case")
    return cases.unionByName(structural) if structural_failures(df, contract) else cases


def health_report(df: DataFrame, contract: Contract, label: str = "Class") -> DataFrame:
    """V7 with the V6 outcome folded in: n_rows, n_fraud, fraud_rate (6 decimals),
    n_failures and status, all from one aggregate pass."""
    checks = check_expressions(contract, df.columns)
    n_struct = len(structural_failures(df, contract))
    fails = sum((F.count_if(p) for _, _, p in checks), F.lit(0).cast("bigint"))
    rep = df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.col(label).cast("long")).alias("n_fraud"),
                 F.round(F.avg(F.col(label).cast("double")), 6).alias("fraud_rate"),
                 (fails + F.lit(n_struct)).alias("n_failures"))
    return rep.withColumn("status", F.when(F.col("n_failures") == 0, "passed").otherwise("failed"))


def enforce(df: DataFrame, contract: Contract, boundary: str | None = None) -> DataFrame:
    """V9 gate: raise :class:`ContractViolation` naming the boundary and every failing
    check; return ``df`` unchanged when it passes.  Fetches only the summary rows."""
    failing = [r for r in contract_summary(df, contract).filter("n_failed > 0").collect()]
    if failing:
        where = boundary or contract.name
        detail = "; ".join(f"{r['column']}:{r['check']} x{r['n_failed']}" for r in failing)
        raise ContractViolation(f"{where} data does not satisfy the {contract.name} contract: {detail}")
    return df


def with_validity(df: DataFrame, contract: Contract, flag: str = "is_valid") -> DataFrame:
    """V10: a boolean column, true when the row passes every value check; works on streams."""
    checks = check_expressions(contract, df.columns)
    bad = F.lit(False)
    for _, _, p in checks:
        bad = bad | F.coalesce(p, F.lit(True))
    return df.withColumn(flag, ~bad)


def split_valid(df: DataFrame, contract: Contract, flag: str = "is_valid") -> tuple[DataFrame, DataFrame]:
    """V10: (valid rows, quarantined rows) — two filters over one flagged frame."""
    flagged = with_validity(df, contract, flag)
    return flagged.filter(F.col(flag)).drop(flag), flagged.filter(~F.col(flag)).drop(flag)
