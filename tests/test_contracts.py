"""Contract tests modelled on the reference's: a valid row passes, each bad value
fails for its own reason, an extra column fails, processed rows may be negative."""

import pytest
from pyspark.sql import functions as F

from raresight.errors import ContractViolation
from raresight.operators import contracts as V
from raresight.sources.tables import V_COLUMNS

COLS = ["Time", *V_COLUMNS, "Amount", "Class"]
SCHEMA = ", ".join([f"{c} double" for c in COLS[:-1]] + ["Class bigint"])


def row(**over):
    base = {"Time": 0.0, **{v: 0.1 for v in V_COLUMNS}, "Amount": 10.0, "Class": 0}
    base.update(over)
    return [base[c] for c in COLS]


def failing(spark, contract, data, schema=SCHEMA):
    df = spark.createDataFrame([tuple(data)], schema)
    return {(r["column"], r["check"]) for r in V.contract_summary(df, contract).filter("n_failed > 0").collect()}


def test_raw_contract_accepts_valid_row(spark):
    assert failing(spark, V.raw_transaction_contract(), row()) == set()


@pytest.mark.parametrize("field,value,expected", [
    ("Class", 5, ("Class", "isin(0,1)")),
    ("Amount", -5.0, ("Amount", "ge(0)")),
    ("Time", -1.0, ("Time", "ge(0)")),
    ("V1", None, ("V1", "not_null")),
    ("V2", float("nan"), ("V2", "not_null")),
])
def test_raw_contract_rejects_each_bad_value_for_its_reason(spark, field, value, expected):
    assert failing(spark, V.raw_transaction_contract(), row(**{field: value})) == {expected}


def test_unexpected_and_missing_columns(spark):
    df = spark.createDataFrame([tuple(row()) + (1.0,)], SCHEMA + ", extra_column double").drop("V28")
    got = {(r["column"], r["check"]) for r in V.contract_summary(df, V.raw_transaction_contract()).collect()
           if r["n_failed"] > 0}
    assert ("extra_column", "unexpected_column") in got and ("V28", "missing_column") in got


def test_processed_contract_allows_negative_but_not_class_5(spark):
    assert failing(spark, V.processed_transaction_contract(), row(Time=-1.5, Amount=-0.3)) == set()
    assert failing(spark, V.processed_transaction_contract(), row(Time=-1.5, Class=5)) == {("Class", "isin(0,1)")}


def test_coercion_failure_is_reported(spark):
    df = spark.createDataFrame([("abc",), ("1.5",)], "Amount string")
    c = V.Contract("t", (V.Rule("Amount", "double", ge=0.0),))
    got = {(r["column"], r["check"]): r["n_failed"] for r in V.contract_summary(df, c).collect()}
    assert got[("Amount", "dtype(double)")] == 1


def test_gate_raises_with_every_failure_and_boundary(spark):
    df = spark.createDataFrame([tuple(row(Amount=-5.0, Class=5))], SCHEMA)
    with pytest.raises(ContractViolation) as e:
        V.enforce(df, V.raw_transaction_contract(), "raw data")
    assert "raw data" in str(e.value) and "Amount:ge(0)" in str(e.value) and "Class:isin(0,1)" in str(e.value)


def test_failure_cases_and_validity(spark):
    df = spark.createDataFrame([(1, 5.0), (2, -1.0), (3, None)], "k bigint, Amount double")
    c = V.Contract("t", (V.Rule("Amount", "double", ge=0.0),), strict=False)
    cases = {(r["k"], r["check"]) for r in V.failure_cases(df, c, ["k"]).collect()}
    assert cases == {(2, "ge(0)"), (3, "not_null")}
    valid, bad = V.split_valid(df, c)
    assert [r["k"] for r in valid.collect()] == [1] and sorted(r["k"] for r in bad.collect()) == [2, 3]


def test_health_report_matches_published_rounding(spark):
    # 492 positives of 284,807 rows -> 0.001727 (6 decimals) as in the published report
    df = spark.range(284807).select(F.when(F.col("id") < 492, 1).otherwise(0).cast("long").alias("Class"))
    r = V.health_report(df, V.Contract("c", (V.Rule("Class", "bigint", isin=(0, 1)),)), "Class").first()
    assert (r["n_rows"], r["n_fraud"], r["fraud_rate"], r["status"]) == (284807, 492, 0.001727, "passed")
