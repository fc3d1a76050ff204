"""Registered queries: each runs one operator (or a short chain) over the given
tables and has, where SQL can express it, an equivalent DuckDB query.

Column names and types are aligned between both sides; floating results are
rounded identically on both sides, because the two engines sum in different orders.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from raresight.operators import contracts as V
from raresight.operators import evaluate as E
from raresight.operators import prepare as T
from raresight.sources import tables as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

COST_FP, COST_FN = 4.0, 137.0  # fixed values: illustrative per-error costs (EUR) of the reference
TEST_SIZE, SEED = 0.2, 42


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def r9(c):
    return F.round(c, 9)


# ----------------------------------------------------------------------------
# SQL building blocks for the oracle side (DuckDB dialect)
SQL_TX = """
tx AS (
  SELECT event_id,
         CAST(date_diff('microsecond', (SELECT min(ts) FROM events), ts) AS DOUBLE) / 1e6 AS Time,
         value AS Amount,
         CAST(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS BIGINT) AS Class
  FROM events)"""

SQL_SPLIT = """
hs AS (SELECT *, md5(concat_ws('|', '42', CAST(event_id AS VARCHAR))) AS h FROM tx),
rk AS (SELECT *, row_number() OVER (PARTITION BY Class ORDER BY h) AS rn,
              count(*) OVER (PARTITION BY Class) AS n_c FROM hs),
sp AS (SELECT event_id, Time, Amount, Class,
              CASE WHEN rn <= floor(CAST(n_c AS DOUBLE) * 0.2) THEN 'test' ELSE 'train' END AS split
       FROM rk)"""

SQL_LINSPACE = "(SELECT i, CAST(i AS DOUBLE) * ((0.99::DOUBLE - 0.01::DOUBLE) / 98) + 0.01::DOUBLE AS t FROM range(99) r(i))"


# ----------------------------------------------------------------------------
# Flagship: transactions -> contract gate -> exact stratified split -> fit scaler on
# train -> apply to test -> stand-in score -> cost-optimal threshold.
def standin_score(z) -> F.Column:
    """A monotone score in (0, 1) from a standardised column (rational: bit-identical across engines)."""
    return F.lit(0.5) + F.lit(0.5) * z / (F.lit(1.0) + F.abs(z))


def scored_test_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = S.transaction_table(spark, sf_dir)
    V.enforce(tx.drop("event_id"), V.raw_transaction_contract(features=()), boundary="raw transactions")
    split = T.stratified_split(tx, ["event_id"], "Class", TEST_SIZE, SEED)
    params = T.fit_standardizer(split.filter(F.col("split") == "train"), ["Time", "Amount"])
    test = T.apply_standardizer(split.filter(F.col("split") == "test"), params)
    return test.select("event_id", F.col("Class").alias("y"), standin_score(F.col("Amount")).alias("p"))


@register("flagship_cost_threshold", sql=f"""
WITH {SQL_TX}, {SQL_SPLIT},
prm AS (SELECT avg(Amount) AS ma, stddev_pop(Amount) AS sa FROM sp WHERE split = 'train'),
sc AS (SELECT Class AS y, (Amount - ma) / CASE WHEN sa = 0 THEN 1 ELSE sa END AS z
       FROM sp, prm WHERE split = 'test'),
pr AS (SELECT y, 0.5 + 0.5 * z / (1 + abs(z)) AS p FROM sc),
cand AS {SQL_LINSPACE},
sw AS (SELECT c.i, c.t,
              count(*) FILTER (WHERE pr.p >= c.t AND pr.y = 1) AS tp,
              count(*) FILTER (WHERE pr.p >= c.t AND pr.y <> 1) AS fp,
              count(*) FILTER (WHERE pr.p < c.t AND pr.y = 1) AS fn,
              count(*) FILTER (WHERE pr.p < c.t AND pr.y <> 1) AS tn
       FROM cand c, pr GROUP BY c.i, c.t)
SELECT t AS threshold, CAST(fp AS DOUBLE) * 4.0::DOUBLE + CAST(fn AS DOUBLE) * 137.0::DOUBLE AS expected_cost,
       fp, fn, tp, tn
FROM sw ORDER BY expected_cost, i LIMIT 1
""")
def flagship_cost_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = scored_test_transactions(spark, sf_dir)
    return E.cost_optimal_threshold(scored, COST_FP, COST_FN, label="y", score="p")


# ----------------------------------------------------------------------------
# V: contracts
from raresight.operators import profile as P  # noqa: E402
from raresight.operators.contracts import Contract, Rule  # noqa: E402

# fixed values: the event-type domain and customer segments named by the contracts below
EVENTS_CONTRACT = Contract("events", (
    Rule("event_id", "bigint"), Rule("ts", "timestamp_ntz"), Rule("user_id", "bigint"),
    Rule("event_type", "string", isin=("view", "click", "purchase", "signup")),
    Rule("value", "double", ge=1.0), Rule("props", "double"), Rule("channel", "string")))
CUSTOMER_CONTRACT = Contract("customer", (
    Rule("c_custkey", "bigint"), Rule("c_name", "string"), Rule("c_nationkey", "bigint", isin=tuple(range(25))),
    Rule("c_acctbal", "double", ge=0.0),
    Rule("c_mktsegment", "string", isin=("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"))))


@register("v6_contract_summary_events", sql="""
SELECT 'event_id' AS "column", 'dtype(bigint)' AS "check", count(*) FILTER (WHERE event_id IS NOT NULL AND TRY_CAST(event_id AS BIGINT) IS NULL) AS n_failed FROM events
UNION ALL SELECT 'event_id', 'not_null', count(*) FILTER (WHERE event_id IS NULL) FROM events
UNION ALL SELECT 'ts', 'dtype(timestamp_ntz)', count(*) FILTER (WHERE ts IS NOT NULL AND TRY_CAST(ts AS TIMESTAMP) IS NULL) FROM events
UNION ALL SELECT 'ts', 'not_null', count(*) FILTER (WHERE ts IS NULL) FROM events
UNION ALL SELECT 'user_id', 'dtype(bigint)', count(*) FILTER (WHERE user_id IS NOT NULL AND TRY_CAST(user_id AS BIGINT) IS NULL) FROM events
UNION ALL SELECT 'user_id', 'not_null', count(*) FILTER (WHERE user_id IS NULL) FROM events
UNION ALL SELECT 'event_type', 'dtype(string)', count(*) FILTER (WHERE event_type IS NOT NULL AND TRY_CAST(event_type AS VARCHAR) IS NULL) FROM events
UNION ALL SELECT 'event_type', 'not_null', count(*) FILTER (WHERE event_type IS NULL) FROM events
UNION ALL SELECT 'event_type', 'isin(''view'',''click'',''purchase'',''signup'')', count(*) FILTER (WHERE event_type IS NOT NULL AND event_type NOT IN ('view', 'click', 'purchase', 'signup')) FROM events
UNION ALL SELECT 'value', 'dtype(double)', count(*) FILTER (WHERE value IS NOT NULL AND TRY_CAST(value AS DOUBLE) IS NULL) FROM events
UNION ALL SELECT 'value', 'not_null', count(*) FILTER (WHERE value IS NULL OR isnan(value)) FROM events
UNION ALL SELECT 'value', 'ge(1)', count(*) FILTER (WHERE value < 1.0) FROM events
UNION ALL SELECT 'props', 'dtype(double)', count(*) FILTER (WHERE props IS NOT NULL AND TRY_CAST(props AS DOUBLE) IS NULL) FROM events
UNION ALL SELECT 'props', 'not_null', count(*) FILTER (WHERE props IS NULL OR isnan(TRY_CAST(props AS DOUBLE))) FROM events
UNION ALL SELECT 'channel', 'missing_column', CAST(1 AS BIGINT)
""")
def v6_contract_summary_events(spark, sf_dir):
    return V.contract_summary(S.load(spark, sf_dir, "events"), EVENTS_CONTRACT)


@register("v6_contract_summary_customer", sql="""
SELECT 'c_custkey' AS "column", 'dtype(bigint)' AS "check", count(*) FILTER (WHERE c_custkey IS NOT NULL AND TRY_CAST(c_custkey AS BIGINT) IS NULL) AS n_failed FROM customer
UNION ALL SELECT 'c_custkey', 'not_null', count(*) FILTER (WHERE c_custkey IS NULL) FROM customer
UNION ALL SELECT 'c_name', 'dtype(string)', count(*) FILTER (WHERE c_name IS NOT NULL AND TRY_CAST(c_name AS VARCHAR) IS NULL) FROM customer
UNION ALL SELECT 'c_name', 'not_null', count(*) FILTER (WHERE c_name IS NULL) FROM customer
UNION ALL SELECT 'c_nationkey', 'dtype(bigint)', count(*) FILTER (WHERE c_nationkey IS NOT NULL AND TRY_CAST(c_nationkey AS BIGINT) IS NULL) FROM customer
UNION ALL SELECT 'c_nationkey', 'not_null', count(*) FILTER (WHERE c_nationkey IS NULL) FROM customer
UNION ALL SELECT 'c_nationkey', 'isin(' || (SELECT string_agg(CAST(i AS VARCHAR), ',' ORDER BY i) FROM range(25) r(i)) || ')', count(*) FILTER (WHERE c_nationkey IS NOT NULL AND (c_nationkey < 0 OR c_nationkey > 24)) FROM customer
UNION ALL SELECT 'c_acctbal', 'dtype(double)', count(*) FILTER (WHERE c_acctbal IS NOT NULL AND TRY_CAST(c_acctbal AS DOUBLE) IS NULL) FROM customer
UNION ALL SELECT 'c_acctbal', 'not_null', count(*) FILTER (WHERE c_acctbal IS NULL OR isnan(c_acctbal)) FROM customer
UNION ALL SELECT 'c_acctbal', 'ge(0)', count(*) FILTER (WHERE c_acctbal < 0) FROM customer
UNION ALL SELECT 'c_mktsegment', 'dtype(string)', count(*) FILTER (WHERE c_mktsegment IS NOT NULL AND TRY_CAST(c_mktsegment AS VARCHAR) IS NULL) FROM customer
UNION ALL SELECT 'c_mktsegment', 'not_null', count(*) FILTER (WHERE c_mktsegment IS NULL) FROM customer
UNION ALL SELECT 'c_mktsegment', 'isin(''AUTOMOBILE'',''BUILDING'',''FURNITURE'',''HOUSEHOLD'',''MACHINERY'')', count(*) FILTER (WHERE c_mktsegment IS NOT NULL AND c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY')) FROM customer
""")
def v6_contract_summary_customer(spark, sf_dir):
    return V.contract_summary(S.load(spark, sf_dir, "customer"), CUSTOMER_CONTRACT)


@register("v6_failure_cases_customer", sql="""
SELECT c_custkey, 'c_acctbal' AS "column", 'ge(0)' AS "check", CAST(c_acctbal AS VARCHAR) AS failure_case
FROM customer WHERE c_acctbal < 0
""")
def v6_failure_cases_customer(spark, sf_dir):
    return V.failure_cases(S.load(spark, sf_dir, "customer"), CUSTOMER_CONTRACT, ["c_custkey"])


@register("v7_health_report", sql=f"""
WITH {SQL_TX}
SELECT count(*) AS n_rows, CAST(sum(Class) AS BIGINT) AS n_fraud, round(avg(CAST(Class AS DOUBLE)), 6) AS fraud_rate,
       CAST(count(*) FILTER (WHERE Time < 0) + count(*) FILTER (WHERE Amount < 0)
            + count(*) FILTER (WHERE Time IS NULL OR isnan(Time)) + count(*) FILTER (WHERE Amount IS NULL OR isnan(Amount))
            + count(*) FILTER (WHERE Class IS NULL OR Class NOT IN (0, 1)) AS BIGINT) AS n_failures,
       CASE WHEN count(*) FILTER (WHERE Time < 0 OR Amount < 0 OR Class NOT IN (0, 1)) = 0 THEN 'passed' ELSE 'failed' END AS status
FROM tx
""")
def v7_health_report(spark, sf_dir):
    tx = S.transaction_table(spark, sf_dir).drop("event_id")
    return V.health_report(tx, V.raw_transaction_contract(features=()), "Class")


@register("v8_processed_contract", sql=f"""
WITH {SQL_TX}, {SQL_SPLIT},
prm AS (SELECT avg(Time) AS mt, stddev_pop(Time) AS st, avg(Amount) AS ma, stddev_pop(Amount) AS sa FROM sp WHERE split = 'train'),
sc AS (SELECT split, (Time - mt) / st AS Time, (Amount - ma) / sa AS Amount, Class FROM sp, prm)
SELECT split, count(*) AS n_rows,
       count(*) FILTER (WHERE Time < 0) AS n_negative_time,
       CAST(count(*) FILTER (WHERE Time IS NULL OR isnan(Time)) + count(*) FILTER (WHERE Amount IS NULL OR isnan(Amount))
            + count(*) FILTER (WHERE Class NOT IN (0, 1)) AS BIGINT) AS n_failures
FROM sc GROUP BY split
""")
def v8_processed_contract(spark, sf_dir):
    """Both processed splits against the processed contract (no range checks): negative
    standardised times are allowed, so the failure count stays 0."""
    tx = S.transaction_table(spark, sf_dir)
    split = T.stratified_split(tx, ["event_id"], "Class", TEST_SIZE, SEED)
    params = T.fit_standardizer(split.filter(F.col("split") == "train"), ["Time", "Amount"])
    proc = T.apply_standardizer(split, params)
    contract = V.processed_transaction_contract(features=())
    checks = V.check_expressions(contract, proc.columns)
    fails = sum((F.count_if(p) for _, _, p in checks), F.lit(0).cast("bigint"))
    return proc.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"),
                                     F.count_if(F.col("Time") < 0).alias("n_negative_time"),
                                     fails.alias("n_failures"))


@register("v10_valid_quarantine", sql="""
SELECT c_custkey, NOT (coalesce(c_acctbal < 0, true) OR c_acctbal IS NULL OR isnan(c_acctbal)
       OR c_nationkey NOT BETWEEN 0 AND 24 OR c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY')) AS is_valid
FROM customer
""")
def v10_valid_quarantine(spark, sf_dir):
    return V.with_validity(S.load(spark, sf_dir, "customer"), CUSTOMER_CONTRACT).select("c_custkey", "is_valid")


# ----------------------------------------------------------------------------
# P: profiling
LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("p1_structure_lineitem", sql="""
WITH d AS (SELECT column_name, column_type FROM (DESCRIBE lineitem)),
c AS (UNPIVOT (SELECT count(l_orderkey) AS l_orderkey, count(l_partkey) AS l_partkey, count(l_suppkey) AS l_suppkey,
                      count(l_linenumber) AS l_linenumber, count(l_quantity) AS l_quantity,
                      count(l_extendedprice) AS l_extendedprice, count(l_discount) AS l_discount, count(l_tax) AS l_tax,
                      count(l_returnflag) AS l_returnflag, count(l_linestatus) AS l_linestatus,
                      count(l_shipdate) AS l_shipdate FROM lineitem)
      ON COLUMNS(*) INTO NAME column_name VALUE non_null)
SELECT d.column_name AS "column",
       CASE d.column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
            WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(d.column_type) END AS dtype,
       c.non_null, (SELECT count(*) FROM lineitem) AS n_rows
FROM d JOIN c USING (column_name)
""")
def p1_structure_lineitem(spark, sf_dir):
    return P.structure(S.load(spark, sf_dir, "lineitem"))


@register("p2_head_transactions", sql=f"""
WITH {SQL_TX} SELECT * FROM tx ORDER BY event_id LIMIT 5
""")
def p2_head_transactions(spark, sf_dir):
    return P.head(S.transaction_table(spark, sf_dir), 5, ["event_id"])


def _describe_sql(table_sql: str, cols: list[str], by: str | None = None) -> str:
    on = ", ".join(cols)
    g = f"{by}, " if by else ""
    return f"""
WITH base AS ({table_sql}),
long AS (UNPIVOT (SELECT {g}{on} FROM base) ON {on} INTO NAME "column" VALUE value)
SELECT {g}"column", count(value) AS "count", round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
       min(value) AS "min", quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.5) AS p50,
       quantile_cont(value, 0.75) AS p75, max(value) AS "max"
FROM long WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY {g}"column"
"""


def _round_describe(d):
    return d.withColumn("mean", F.round("mean", 6)).withColumn("std", F.round("std", 6))


@register("p3_describe_lineitem", sql=_describe_sql("SELECT * FROM lineitem", LI_NUM))
def p3_describe_lineitem(spark, sf_dir):
    return _round_describe(P.describe(S.load(spark, sf_dir, "lineitem"), LI_NUM))


@register("p4_null_counts_documents", sql="""
WITH c AS (UNPIVOT (SELECT count(*) FILTER (WHERE doc_id IS NULL) AS doc_id, count(*) FILTER (WHERE text IS NULL) AS text,
                      count(*) FILTER (WHERE lang IS NULL) AS lang, count(*) FILTER (WHERE source IS NULL) AS source,
                      count(*) FILTER (WHERE n_chars IS NULL) AS n_chars FROM documents)
      ON COLUMNS(*) INTO NAME "column" VALUE n_null)
SELECT "column", n_null FROM c UNION ALL SELECT '__total__', CAST(sum(n_null) AS BIGINT) FROM c
""")
def p4_null_counts_documents(spark, sf_dir):
    return P.null_counts(S.load(spark, sf_dir, "documents"))


@register("p5_duplicates_lineitem_keys", sql="""
WITH g AS (SELECT l_orderkey, l_linenumber, CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS BIGINT) AS Class,
                  count(*) AS n FROM lineitem GROUP BY ALL)
SELECT Class, CAST(sum(n - 1) AS BIGINT) AS n_duplicates FROM g GROUP BY Class
""")
def p5_duplicates_lineitem_keys(spark, sf_dir):
    li = S.returns_table(spark, sf_dir).select("l_orderkey", "l_linenumber", "Class")
    return P.duplicate_counts(li, "Class")


@register("p6_value_counts_part_size", sql="""
SELECT p_size AS value, count(*) AS n, count(*) / (SELECT count(*) FROM part) AS proportion FROM part GROUP BY p_size
""")
def p6_value_counts_part_size(spark, sf_dir):
    return P.value_counts(S.load(spark, sf_dir, "part"), "p_size")


@register("p7_imbalance_events", sql=f"""
WITH {SQL_TX}
SELECT count(*) FILTER (WHERE Class = 1) AS n_pos, count(*) FILTER (WHERE Class <> 1) AS n_neg,
       count(*) FILTER (WHERE Class = 1) * 100.0::DOUBLE / count(*) AS pos_rate_pct,
       count(*) FILTER (WHERE Class <> 1) / nullif(count(*) FILTER (WHERE Class = 1), 0) AS neg_per_pos
FROM tx
""")
def p7_imbalance_events(spark, sf_dir):
    return P.imbalance(S.transaction_table(spark, sf_dir))


@register("p8_describe_amount_by_class", sql=_describe_sql(f"WITH {SQL_TX} SELECT * FROM tx", ["Amount"], "Class"))
def p8_describe_amount_by_class(spark, sf_dir):
    return _round_describe(P.describe(S.transaction_table(spark, sf_dir), ["Amount"], by=["Class"]))


@register("p9_zero_amount_rate", sql=f"""
WITH {SQL_TX} SELECT avg(CAST(Amount = 0 AS DOUBLE)) * 100 AS rate_pct FROM tx
""")
def p9_zero_amount_rate(spark, sf_dir):
    return P.predicate_rate(S.transaction_table(spark, sf_dir), F.col("Amount") == 0)


@register("p11_hourly_profile", sql=f"""
WITH {SQL_TX}
SELECT CAST(floor(Time / 3600.0) AS BIGINT) % 24 AS hour, count(*) AS n_tx,
       round(avg(CAST(Class AS DOUBLE)) * 100, 9) AS pos_rate_pct
FROM tx GROUP BY 1
""")
def p11_hourly_profile(spark, sf_dir):
    h = P.hourly_profile(S.transaction_table(spark, sf_dir))
    return h.withColumn("pos_rate_pct", r9(F.col("pos_rate_pct")))


@register("p12_time_span", sql=f"""
WITH {SQL_TX} SELECT max(Time) AS max_seconds, round(max(Time) / 3600.0, 1) AS hours FROM tx
""")
def p12_time_span(spark, sf_dir):
    return P.time_span(S.transaction_table(spark, sf_dir))


FEAT_SQL = ("SELECT vec_id, " + ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS V{i + 1}" for i in range(64))
            + ", CAST(CASE WHEN label = 0 THEN 1 ELSE 0 END AS BIGINT) AS Class FROM embeddings")


def _corr_sql() -> str:
    cols = S.E_COLUMNS + ["Class"]
    sel = []
    for a in cols:
        for b in cols:
            sel.append(f"round(corr({a}, {b}), 9) AS {a}__{b}")
    wide = f"SELECT {', '.join(sel)} FROM feat"
    return (f"WITH feat AS ({FEAT_SQL}), wide AS ({wide}), long AS (UNPIVOT wide ON * INTO NAME pair VALUE r)\n"
            "SELECT split_part(pair, '__', 1) AS a, split_part(pair, '__', 2) AS b, r FROM long")


@register("p13_correlation_matrix", sql=_corr_sql())
def p13_correlation_matrix(spark, sf_dir):
    cm = P.correlation_matrix(S.feature_table(spark, sf_dir), S.E_COLUMNS + ["Class"])
    return cm.withColumn("r", r9(F.col("r")))


@register("p14_label_correlation_top12", sql=f"""
WITH feat AS ({FEAT_SQL}),
c AS ({" UNION ALL ".join(f"SELECT '{v}' AS feature, abs(corr({v}, CAST(Class AS DOUBLE))) AS abs_corr FROM feat" for v in S.E_COLUMNS)})
SELECT feature, round(abs_corr, 9) AS abs_corr FROM c ORDER BY abs_corr DESC, feature LIMIT 12
""")
def p14_label_correlation_top12(spark, sf_dir):
    r = P.label_correlation_ranking(S.feature_table(spark, sf_dir), S.E_COLUMNS, "Class", 12)
    return r.withColumn("abs_corr", r9(F.col("abs_corr")))


@register("p15_histogram_amount", sql=f"""
WITH {SQL_TX}, rg AS (SELECT min(Amount) AS lo, (max(Amount) - min(Amount)) / 50.0::DOUBLE AS w FROM tx)
SELECT Class, CAST(CASE WHEN w = 0 THEN 0 ELSE least(floor((Amount - lo) / w), 49) END AS BIGINT) AS bin,
       round(lo + CAST(CASE WHEN w = 0 THEN 0 ELSE least(floor((Amount - lo) / w), 49) END AS BIGINT) * w, 9) AS bin_lo,
       count(*) AS n
FROM tx, rg GROUP BY ALL
""")
def p15_histogram_amount(spark, sf_dir):
    h = P.grouped_histogram(S.transaction_table(spark, sf_dir), "Amount", "Class", 50)
    return h.withColumn("bin_lo", r9(F.col("bin_lo")))


@register("p16_density_amount", sql=f"""
WITH {SQL_TX},
st AS (SELECT Class, count(*) AS n, stddev_samp(Amount) * pow(CAST(count(*) AS DOUBLE), -0.2) AS bw,
              min(Amount) AS mn, max(Amount) AS mx FROM tx GROUP BY Class),
g AS (SELECT Class, n, bw, j,
             CASE WHEN j = 199 THEN mx + 3.0 * bw
                  ELSE CAST(j AS DOUBLE) * (((mx + 3.0 * bw) - (mn - 3.0 * bw)) / 199.0) + (mn - 3.0 * bw) END AS x
      FROM st, range(200) r(j))
SELECT g.Class, CAST(g.j AS INTEGER) AS j, round(g.x, 9) AS x,
       round(sum(exp(-0.5 * pow((g.x - tx.Amount) / g.bw, 2))) / (g.n * g.bw * sqrt(2 * pi())), 12) AS density
FROM g JOIN tx ON g.Class = tx.Class GROUP BY g.Class, g.j, g.x, g.n, g.bw
""")
def p16_density_amount(spark, sf_dir):
    d = P.class_density(S.transaction_table(spark, sf_dir), "Amount", "Class", 200, 3.0)
    return d.withColumn("x", r9(F.col("x"))).withColumn("density", F.round("density", 12))


@register("p17_melt_features", sql=f"""
WITH feat AS ({FEAT_SQL})
UNPIVOT feat ON {", ".join(S.E_COLUMNS)} INTO NAME component VALUE value
""")
def p17_melt_features(spark, sf_dir):
    return P.melt(S.feature_table(spark, sf_dir), ["vec_id", "Class"], S.E_COLUMNS)


@register("p18_box_stats_features", sql=f"""
WITH feat AS ({FEAT_SQL}),
long AS (UNPIVOT (SELECT Class, {", ".join(S.E_COLUMNS)} FROM feat) ON {", ".join(S.E_COLUMNS)} INTO NAME component VALUE value),
q AS (SELECT Class, component, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
             quantile_cont(value, 0.75) AS q3 FROM long GROUP BY ALL),
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lf, q3 + 1.5 * (q3 - q1) AS uf FROM q)
SELECT f.Class, f.component, f.q1, f.median, f.q3, round(f.iqr, 12) AS iqr,
       min(value) FILTER (WHERE value >= lf) AS whisker_lo, max(value) FILTER (WHERE value <= uf) AS whisker_hi,
       count(*) FILTER (WHERE value < lf OR value > uf) AS n_outliers
FROM long JOIN f USING (Class, component) GROUP BY ALL
""")
def p18_box_stats_features(spark, sf_dir):
    b = P.box_stats(S.feature_table(spark, sf_dir), S.E_COLUMNS, "Class")
    return b.withColumn("iqr", F.round("iqr", 12))


# ----------------------------------------------------------------------------
# E: evaluation over three stand-in score models on lineitem (Class = returned)
SQL_SM = """
sm AS (UNPIVOT (SELECT CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS BIGINT) AS y,
                       CAST(l_discount * 10.0 AS DOUBLE) AS discount, CAST(l_tax / 0.08 AS DOUBLE) AS tax,
                       CAST(l_quantity / 50.0 AS DOUBLE) AS quantity FROM lineitem)
       ON discount, tax, quantity INTO NAME model_id VALUE p)"""

SQL_CURVE = """
dc AS (SELECT model_id, p AS threshold, count(*) FILTER (WHERE y = 1) AS n_pos,
              count(*) FILTER (WHERE y <> 1) AS n_neg FROM sm GROUP BY ALL),
cv AS (SELECT *, CAST(sum(n_pos) OVER w AS BIGINT) AS tps, CAST(sum(n_neg) OVER w AS BIGINT) AS fps,
              CAST(sum(n_pos) OVER (PARTITION BY model_id) AS BIGINT) AS P,
              CAST(sum(n_neg) OVER (PARTITION BY model_id) AS BIGINT) AS N
       FROM dc WINDOW w AS (PARTITION BY model_id ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING)),
pts AS (SELECT *, tps / (tps + fps) AS precision, CASE WHEN P = 0 THEN 1.0 ELSE tps / P END AS recall FROM cv)"""

SQL_CONF = """
SELECT model_id, count(*) FILTER (WHERE p >= {t} AND y = 1) AS tp, count(*) FILTER (WHERE p >= {t} AND y <> 1) AS fp,
       count(*) FILTER (WHERE p < {t} AND y = 1) AS fn, count(*) FILTER (WHERE p < {t} AND y <> 1) AS tn
FROM sm GROUP BY model_id"""

SQL_RATES = """
SELECT *, CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision,
          CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS recall,
          CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1"""


def _r9cols(df, cols):
    for c in cols:
        df = df.withColumn(c, r9(F.col(c)))
    return df


def _models(spark, sf_dir):
    return S.scored_models(spark, sf_dir)


@register("e1_confusion_by_model", sql=f"WITH {SQL_SM} {SQL_CONF.format(t='0.5')}")
def e1_confusion_by_model(spark, sf_dir):
    return E.confusion_counts(_models(spark, sf_dir), 0.5, by=["model_id"])


@register("e2_metrics_by_model", sql=f"""
WITH {SQL_SM}, cf AS ({SQL_CONF.format(t='0.5')}), rt AS ({SQL_RATES} FROM cf)
SELECT model_id, tp, fp, fn, tn, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1 FROM rt
""")
def e2_metrics_by_model(spark, sf_dir):
    m = E.classification_metrics(_models(spark, sf_dir), 0.5, by=["model_id"])
    return _r9cols(m, ["precision", "recall", "f1"])


@register("e3_pr_auc_by_model", sql=f"""
WITH {SQL_SM}, {SQL_CURVE}
SELECT model_id, round(coalesce(sum(n_pos * precision) / nullif(max(P), 0), 0.0), 9) AS pr_auc FROM pts GROUP BY model_id
""")
def e3_pr_auc_by_model(spark, sf_dir):
    return _r9cols(E.average_precision(_models(spark, sf_dir), by=["model_id"]), ["pr_auc"])


@register("e3_pr_auc_flagship", sql=f"""
WITH {SQL_TX}, {SQL_SPLIT},
prm AS (SELECT avg(Amount) AS ma, stddev_pop(Amount) AS sa FROM sp WHERE split = 'train'),
sc AS (SELECT Class AS y, (Amount - ma) / sa AS z FROM sp, prm WHERE split = 'test'),
pr AS (SELECT y, 0.5 + 0.5 * z / (1 + abs(z)) AS p FROM sc),
dc AS (SELECT p AS threshold, count(*) FILTER (WHERE y = 1) AS n_pos, count(*) FILTER (WHERE y <> 1) AS n_neg
       FROM pr GROUP BY ALL),
cv AS (SELECT *, sum(n_pos) OVER w AS tps, sum(n_neg) OVER w AS fps, sum(n_pos) OVER () AS P
       FROM dc WINDOW w AS (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING))
SELECT round(coalesce(sum(n_pos * (tps / (tps + fps))) / nullif(max(P), 0), 0.0), 9) AS pr_auc FROM cv
""")
def e3_pr_auc_flagship(spark, sf_dir):
    return _r9cols(E.average_precision(scored_test_transactions(spark, sf_dir)), ["pr_auc"])


@register("e4_pr_curve_by_model", sql=f"""
WITH {SQL_SM}, {SQL_CURVE}
SELECT model_id, threshold, round(precision, 9) AS precision, round(recall, 9) AS recall FROM pts
UNION ALL SELECT DISTINCT model_id, CAST(NULL AS DOUBLE), 1.0, 0.0 FROM sm
""")
def e4_pr_curve_by_model(spark, sf_dir):
    return _r9cols(E.pr_curve(_models(spark, sf_dir), by=["model_id"]), ["precision", "recall"])


@register("e5_f1_threshold_by_model", sql=f"""
WITH {SQL_SM}, {SQL_CURVE},
f AS (SELECT model_id, threshold, 2 * precision * recall / (precision + recall + 1e-9) AS f1 FROM pts),
r AS (SELECT *, row_number() OVER (PARTITION BY model_id ORDER BY f1 DESC, threshold ASC) AS rn FROM f)
SELECT model_id, threshold, round(f1, 9) AS f1 FROM r WHERE rn = 1
""")
def e5_f1_threshold_by_model(spark, sf_dir):
    return _r9cols(E.f1_optimal_threshold(_models(spark, sf_dir), by=["model_id"]), ["f1"])


SQL_COST_CURVE = f"""
cand AS {SQL_LINSPACE},
sw AS (SELECT sm.model_id, c.i, c.t AS threshold,
              count(*) FILTER (WHERE sm.p >= c.t AND sm.y = 1) AS tp, count(*) FILTER (WHERE sm.p >= c.t AND sm.y <> 1) AS fp,
              count(*) FILTER (WHERE sm.p < c.t AND sm.y = 1) AS fn, count(*) FILTER (WHERE sm.p < c.t AND sm.y <> 1) AS tn
       FROM cand c, sm GROUP BY ALL),
cc AS (SELECT *, CAST(fp AS DOUBLE) * 4.0::DOUBLE + CAST(fn AS DOUBLE) * 137.0::DOUBLE AS cost FROM sw)"""


@register("e6_cost_curve_by_model", sql=f"""
WITH {SQL_SM}, {SQL_COST_CURVE}
SELECT model_id, CAST(i AS INTEGER) AS i, threshold, tp, fp, fn, tn, cost FROM cc
""")
def e6_cost_curve_by_model(spark, sf_dir):
    return E.cost_curve(_models(spark, sf_dir), COST_FP, COST_FN, by=["model_id"])


@register("e6_cost_threshold_by_model", sql=f"""
WITH {SQL_SM}, {SQL_COST_CURVE},
r AS (SELECT *, row_number() OVER (PARTITION BY model_id ORDER BY cost, i) AS rn FROM cc)
SELECT model_id, threshold, cost AS expected_cost, fp, fn, tp, tn FROM r WHERE rn = 1
""")
def e6_cost_threshold_by_model(spark, sf_dir):
    return E.cost_optimal_threshold(_models(spark, sf_dir), COST_FP, COST_FN, by=["model_id"])


NAMED_THRESHOLDS = (0.03, 0.5, 0.9921)  # fixed values: cost-optimal, default and F1-optimal points of the reference


@register("e7_operating_points", sql=f"""
WITH {SQL_SM},
th AS (SELECT unnest([0.03, 0.5, 0.9921]::DOUBLE[]) AS threshold),
cf AS (SELECT model_id, threshold,
              count(*) FILTER (WHERE p >= threshold AND y = 1) AS tp, count(*) FILTER (WHERE p >= threshold AND y <> 1) AS fp,
              count(*) FILTER (WHERE p < threshold AND y = 1) AS fn, count(*) FILTER (WHERE p < threshold AND y <> 1) AS tn
       FROM th, sm GROUP BY ALL),
rt AS ({SQL_RATES} FROM cf)
SELECT model_id, threshold, tp, fp, fn, tn, round(precision, 9) AS precision, round(recall, 9) AS recall,
       round(f1, 9) AS f1, CAST(fp AS DOUBLE) * 4.0::DOUBLE + CAST(fn AS DOUBLE) * 137.0::DOUBLE AS cost FROM rt
""")
def e7_operating_points(spark, sf_dir):
    op = E.operating_points(_models(spark, sf_dir), NAMED_THRESHOLDS, COST_FP, COST_FN, by=["model_id"])
    return _r9cols(op, ["precision", "recall", "f1"])


@register("e8_matched_recall", sql=f"""
WITH {SQL_SM}, {SQL_CURVE},
c AS (SELECT *, CAST(fps AS DOUBLE) * 4.0::DOUBLE + CAST(P - tps AS DOUBLE) * 137.0::DOUBLE AS cost FROM pts WHERE recall >= 0.8),
r AS (SELECT *, row_number() OVER (PARTITION BY model_id ORDER BY cost, threshold) AS rn FROM c)
SELECT model_id, threshold, round(precision, 9) AS precision, round(recall, 9) AS recall, cost FROM r WHERE rn = 1
""")
def e8_matched_recall(spark, sf_dir):
    m = E.matched_recall_point(_models(spark, sf_dir), 0.8, COST_FP, COST_FN, by=["model_id"])
    return _r9cols(m, ["precision", "recall"])


SQL_MODEL_METRICS = f"""
cf AS ({SQL_CONF.format(t='0.5')}), rt AS ({SQL_RATES} FROM cf),
ap AS (SELECT model_id, coalesce(sum(n_pos * precision) / nullif(max(P), 0), 0.0) AS pr_auc FROM pts GROUP BY model_id),
mm AS (SELECT rt.model_id, tp, fp, fn, tn, round(precision, 9) AS precision, round(recall, 9) AS recall,
              round(f1, 9) AS f1, round(pr_auc, 9) AS pr_auc FROM rt JOIN ap USING (model_id))"""


def _model_metrics(spark, sf_dir):
    m = E.model_metrics(_models(spark, sf_dir), 0.5, by=["model_id"])
    return _r9cols(m, ["precision", "recall", "f1", "pr_auc"])


@register("e9_quality_gate", sql=f"""
WITH {SQL_SM}, {SQL_CURVE}, {SQL_MODEL_METRICS}
SELECT model_id, round(pr_auc, 9) AS pr_auc, pr_auc >= 0.75 AS passed,
       CASE WHEN pr_auc >= 0.75 THEN 'passed' ELSE printf('blocked: pr_auc %.4f below minimum 0.75', pr_auc) END AS message
FROM ap
""")
def e9_quality_gate(spark, sf_dir):
    gated = E.quality_gate(E.model_metrics(_models(spark, sf_dir), 0.5, by=["model_id"]), 0.75)  # on the number itself; rounded to be shown
    return _r9cols(gated, ["pr_auc"]).select("model_id", "pr_auc", "passed", "message")


@register("e10_model_ranking", sql=f"""
WITH {SQL_SM}, {SQL_CURVE}, {SQL_MODEL_METRICS}
SELECT *, CAST(rank() OVER (ORDER BY pr_auc DESC, model_id) AS INTEGER) AS rank FROM mm
""")
def e10_model_ranking(spark, sf_dir):
    return E.rank_models(_model_metrics(spark, sf_dir))


SQL_YEAR_AP = """
{name} AS (
  SELECT year, coalesce(sum(n_pos * (tps / (tps + fps))) / nullif(max(P), 0), 0.0) AS pr_auc FROM (
    SELECT year, n_pos, sum(n_pos) OVER w AS tps, sum(n_neg) OVER w AS fps, sum(n_pos) OVER (PARTITION BY year) AS P
    FROM (SELECT year(l_shipdate) AS year, {score} AS threshold,
                 count(*) FILTER (WHERE l_returnflag = 'R') AS n_pos, count(*) FILTER (WHERE l_returnflag <> 'R') AS n_neg
          FROM lineitem {where} GROUP BY ALL)
    WINDOW w AS (PARTITION BY year ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING))
  GROUP BY year)"""


@register("e11_promote_if_better", sql=f"""
WITH {SQL_YEAR_AP.format(name="cand", score="CAST(l_quantity / 50.0 AS DOUBLE)", where="").strip()},
{SQL_YEAR_AP.format(name="inc", score="CAST(l_discount * 10.0 AS DOUBLE)", where="WHERE year(l_shipdate) < 2000").strip()}
SELECT CAST(cand.year AS INTEGER) AS year, round(cand.pr_auc, 9) AS pr_auc, round(inc.pr_auc, 9) AS incumbent_pr_auc,
       inc.pr_auc IS NULL OR cand.pr_auc > inc.pr_auc AS promote
FROM cand LEFT JOIN inc ON inc.year = cand.year
""")
def e11_promote_if_better(spark, sf_dir):
    """One slot per ship year: the incumbent is the discount model (registered for years before
    2000 only), the candidate the quantity model.  A candidate is promoted on a strictly
    greater PR-AUC, or where the slot has no incumbent."""
    li = S.returns_table(spark, sf_dir).withColumn("year", F.year("l_shipdate"))
    cand = E.average_precision(li.select("year", F.col("Class").alias("y"),
                                         F.expr(S.SCORE_MODELS["quantity"]).cast("double").alias("p")), by=["year"])
    inc = E.average_precision(li.filter(F.col("year") < 2000).select(
        "year", F.col("Class").alias("y"), F.expr(S.SCORE_MODELS["discount"]).cast("double").alias("p")), by=["year"])
    out = _r9cols(E.promote_if_better(cand, inc, key="year"), ["pr_auc", "incumbent_pr_auc"])
    return out.select("year", "pr_auc", "incumbent_pr_auc", "promote")


@register("e12_roc_auc_by_model", sql=f"""
WITH {SQL_SM}, {SQL_CURVE}
SELECT model_id, round(sum(n_pos * ((N - fps) + 0.5 * n_neg)) / nullif(max(P) * max(N), 0), 9) AS roc_auc
FROM pts GROUP BY model_id
""")
def e12_roc_auc_by_model(spark, sf_dir):
    return _r9cols(E.roc_auc(_models(spark, sf_dir), by=["model_id"]), ["roc_auc"])


# ----------------------------------------------------------------------------
# T: preparation
def _split_tx(spark, sf_dir):
    return T.stratified_split(S.transaction_table(spark, sf_dir), ["event_id"], "Class", TEST_SIZE, SEED)


@register("t1_feature_projection", sql=f"WITH {SQL_TX} SELECT event_id, Time, Amount FROM tx")
def t1_feature_projection(spark, sf_dir):
    feats, _ = T.features_and_target(S.transaction_table(spark, sf_dir), "Class", ["event_id"])
    return feats


@register("t2_stratified_split", sql=f"WITH {SQL_TX}, {SQL_SPLIT} SELECT event_id, Class, split FROM sp")
def t2_stratified_split(spark, sf_dir):
    return _split_tx(spark, sf_dir).select("event_id", "Class", "split")


LI_ALL = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
          "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@register("t2_split_lineitem_by_flag", sql=f"""
WITH hs AS (SELECT *, md5(concat_ws('|', '42', {", ".join(f"CAST({c} AS VARCHAR)" for c in LI_ALL)})) AS h FROM lineitem),
rk AS (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY h) AS rn,
              count(*) OVER (PARTITION BY l_returnflag) AS n_c FROM hs),
sp AS (SELECT *, CASE WHEN rn <= floor(CAST(n_c AS DOUBLE) * 0.2) THEN 'test' ELSE 'train' END AS split FROM rk)
SELECT l_returnflag, split, count(*) AS n_rows, CAST(sum(l_orderkey) AS BIGINT) AS sum_orderkey FROM sp GROUP BY ALL
""")
def t2_split_lineitem_by_flag(spark, sf_dir):
    """lineitem has no key: the whole row is hashed (it has no whole-row duplicates)."""
    li = S.load(spark, sf_dir, "lineitem")
    sp = T.stratified_split(li, LI_ALL, "l_returnflag", TEST_SIZE, SEED)
    return sp.groupBy("l_returnflag", "split").agg(F.count(F.lit(1)).alias("n_rows"),
                                                   F.sum("l_orderkey").alias("sum_orderkey"))


@register("t3_fit_standardizer", sql=f"""
WITH {SQL_TX}, {SQL_SPLIT}
SELECT 'Time' AS "column", round(avg(Time), 6) AS mean, round(stddev_pop(Time), 6) AS std FROM sp WHERE split = 'train'
UNION ALL SELECT 'Amount', round(avg(Amount), 6), round(stddev_pop(Amount), 6) FROM sp WHERE split = 'train'
""")
def t3_fit_standardizer(spark, sf_dir):
    sp = _split_tx(spark, sf_dir)
    p = T.fit_standardizer(sp.filter(F.col("split") == "train"), ["Time", "Amount"])
    return p.withColumn("mean", F.round("mean", 6)).withColumn("std", F.round("std", 6))


SQL_SCALED = f"""
WITH {SQL_TX}, {SQL_SPLIT},
prm AS (SELECT avg(Time) AS mt, stddev_pop(Time) AS st, avg(Amount) AS ma, stddev_pop(Amount) AS sa FROM sp WHERE split = 'train')
SELECT round((Time - mt) / st, 9) AS Time, round((Amount - ma) / sa, 9) AS Amount, event_id, Class, split
FROM sp, prm
"""


@register("t4_apply_standardizer", sql=SQL_SCALED)
def t4_apply_standardizer(spark, sf_dir):
    sp = _split_tx(spark, sf_dir)
    params = T.fit_standardizer(sp.filter(F.col("split") == "train"), ["Time", "Amount"])
    out = T.apply_standardizer(sp, params)
    return _r9cols(out, ["Time", "Amount"])


@register("t5_persisted_standardizer", sql=SQL_SCALED)
def t5_persisted_standardizer(spark, sf_dir):
    """Fit on train, write the params table to the shared folder, read it back and
    apply it to both parts: the scoring-time transform is the training-time one."""
    from raresight.session import scratch_path
    sp = _split_tx(spark, sf_dir)
    path = T.save_standardizer(T.fit_standardizer(sp.filter(F.col("split") == "train"), ["Time", "Amount"]),
                               scratch_path(spark, "standardizer"))
    out = T.apply_standardizer(sp, T.load_standardizer(spark, path))
    return _r9cols(out, ["Time", "Amount"])


@register("t6_split_summary", sql=f"""
WITH {SQL_TX}, {SQL_SPLIT}
SELECT split, count(*) AS n_rows, CAST(sum(Class) AS BIGINT) AS n_pos, round(avg(CAST(Class AS DOUBLE)) * 100, 9) AS pos_rate_pct
FROM sp GROUP BY split
""")
def t6_split_summary(spark, sf_dir):
    return _r9cols(T.split_summary(_split_tx(spark, sf_dir)), ["pos_rate_pct"])


@register("t7_dedupe_keep_positives", sql="""
WITH li AS (SELECT l_orderkey, l_linenumber, CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS BIGINT) AS Class FROM lineitem)
SELECT * FROM li WHERE Class = 1 UNION ALL SELECT DISTINCT * FROM li WHERE Class <> 1
""")
def t7_dedupe_keep_positives(spark, sf_dir):
    li = S.returns_table(spark, sf_dir).select("l_orderkey", "l_linenumber", "Class")
    return T.drop_duplicates_keep_positives(li, "Class")


@register("t8_cyclical_hour", sql=f"""
WITH {SQL_TX}
SELECT event_id, round(sin(2 * pi() * CAST(CAST(floor(Time / 3600.0) AS BIGINT) % 24 AS DOUBLE) / 24.0), 9) + 0.0::DOUBLE AS hour_sin,
       round(cos(2 * pi() * CAST(CAST(floor(Time / 3600.0) AS BIGINT) % 24 AS DOUBLE) / 24.0), 9) + 0.0::DOUBLE AS hour_cos FROM tx
""")
def t8_cyclical_hour(spark, sf_dir):
    out = T.add_cyclical_hour(S.transaction_table(spark, sf_dir), "Time").select("event_id", "hour_sin", "hour_cos")
    return _r9cols(out, ["hour_sin", "hour_cos"])


@register("t9_log_amount", sql=f"WITH {SQL_TX} SELECT event_id, round(ln(1 + Amount), 9) AS log_Amount FROM tx")
def t9_log_amount(spark, sf_dir):
    out = T.add_log_amount(S.transaction_table(spark, sf_dir), "Amount").select("event_id", "log_Amount")
    return _r9cols(out, ["log_Amount"])


@register("t10_temporal_split_orders", sql="""
WITH o AS (SELECT o_orderkey, CAST(epoch_us(o_orderdate) AS DOUBLE) AS t FROM orders),
c AS (SELECT quantile_cont(t, 0.8) AS cut FROM o)
SELECT o_orderkey, CASE WHEN t >= cut THEN 'test' ELSE 'train' END AS split FROM o, c
""")
def t10_temporal_split_orders(spark, sf_dir):
    return T.temporal_split(S.load(spark, sf_dir, "orders"), "o_orderdate", TEST_SIZE).select("o_orderkey", "split")


@register("t11_repeatable_sample", sql=f"""
WITH {SQL_TX}
SELECT event_id, Time, Amount FROM tx ORDER BY md5(concat_ws('|', '42', CAST(event_id AS VARCHAR))) LIMIT 5000
""")
def t11_repeatable_sample(spark, sf_dir):
    """Reference sample for drift: 5,000 rows of the features (target dropped)."""
    tx = S.transaction_table(spark, sf_dir).drop("Class")
    return T.repeatable_sample(tx, 5000, ["event_id"], SEED)


@register("m9_stratified_folds", sql=f"""
WITH {SQL_TX},
hs AS (SELECT *, md5(concat_ws('|', '42', CAST(event_id AS VARCHAR))) AS h FROM tx),
rk AS (SELECT *, row_number() OVER (PARTITION BY Class ORDER BY h) - 1 AS r, count(*) OVER (PARTITION BY Class) AS n_c FROM hs)
SELECT event_id, Class,
       CAST((floor(n_c * 1 / 5) <= r)::INT + (floor(n_c * 2 / 5) <= r)::INT + (floor(n_c * 3 / 5) <= r)::INT
            + (floor(n_c * 4 / 5) <= r)::INT AS INTEGER) AS fold
FROM rk
""")
def m9_stratified_folds(spark, sf_dir):
    tx = S.transaction_table(spark, sf_dir)
    return T.stratified_folds(tx, ["event_id"], "Class", 5, SEED).select("event_id", "Class", "fold")


# ----------------------------------------------------------------------------
# D: monitoring
from raresight.functions import hash_uniform, instant_to_ntz, seconds_between  # noqa: E402
from raresight.operators import monitor as D  # noqa: E402

SPLIT_TS = "2024-01-16 00:00:00"   # reference = first half of January, current = second half
REF_END_TS = "2024-01-08 00:00:00"  # windowed drift: reference = first week


def _halves(spark, sf_dir):
    ev = S.transaction_table(spark, sf_dir, keep_ts=True, extra=["event_type"])
    cut = F.lit(SPLIT_TS).cast("timestamp_ntz")
    return ev.filter(F.col("ts") < cut), ev.filter(F.col("ts") >= cut)


SQL_HALVES = """
ref AS (SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-16 00:00:00'),
cur AS (SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-16 00:00:00')"""


def _sql_numeric_drift(ref_sql: str, cur_sql: str, col: str, name: str) -> str:
    return f"""
u_{name} AS (SELECT {col} AS value, 0 AS side FROM {ref_sql} UNION ALL SELECT {col}, 1 FROM {cur_sql}),
d_{name} AS (SELECT value, count(*) FILTER (WHERE side = 0) AS n_ref, count(*) FILTER (WHERE side = 1) AS n_cur
             FROM u_{name} WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY value),
t_{name} AS (SELECT count(*) FILTER (WHERE side = 0) AS N_ref, count(*) FILTER (WHERE side = 1) AS N_cur,
                    stddev_pop(value) FILTER (WHERE side = 0) AS ref_std FROM u_{name}),
c_{name} AS (SELECT value, sum(n_ref) OVER w AS cr, sum(n_cur) OVER w AS cc, lead(value) OVER (ORDER BY value) AS nv
             FROM d_{name} WINDOW w AS (ORDER BY value ROWS UNBOUNDED PRECEDING)),
s_{name} AS (SELECT '{name}' AS "column", N_ref, N_cur, ref_std, max(abs(cr / N_ref - cc / N_cur)) AS ks_stat,
                    sum(abs(cr / N_ref - cc / N_cur) * coalesce(nv - value, 0.0)) AS w1
             FROM c_{name}, t_{name} GROUP BY ALL),
k_{name} AS (SELECT *, (sqrt(N_ref * N_cur / (N_ref + N_cur)) + 0.12 + 0.11 / sqrt(N_ref * N_cur / (N_ref + N_cur))) * ks_stat AS lam
             FROM s_{name}),
nd_{name} AS (SELECT "column", N_ref AS n_ref, N_cur AS n_cur, ks_stat,
                     CASE WHEN lam < 0.3 THEN 1.0 ELSE least(greatest((SELECT sum(2.0 * (CASE WHEN j % 2 = 1 THEN 1 ELSE -1 END)
                          * exp(-2.0 * j * j * lam * lam)) FROM range(1, 101) r(j)), 0.0), 1.0) END AS ks_p_value,
                     w1 / nullif(ref_std, 0.0) AS wasserstein_norm FROM k_{name})"""


@register("d3_numeric_drift_halves", sql=f"""
WITH {SQL_HALVES}, {_sql_numeric_drift('ref', 'cur', 'value', 'Amount')}
SELECT "column", n_ref, n_cur, round(ks_stat, 9) AS ks_stat, round(ks_p_value, 9) AS ks_p_value,
       round(wasserstein_norm, 9) AS wasserstein_norm FROM nd_Amount
""")
def d3_numeric_drift_halves(spark, sf_dir):
    ref, cur = _halves(spark, sf_dir)
    return _r9cols(D.numeric_drift(ref, cur, ["Amount"]), ["ks_stat", "ks_p_value", "wasserstein_norm"])


SQL_JS = """
cc_{n} AS (SELECT CAST({c} AS VARCHAR) AS value, count(*) FILTER (WHERE side = 0) AS n_ref, count(*) FILTER (WHERE side = 1) AS n_cur
           FROM (SELECT {c}, 0 AS side FROM ref UNION ALL SELECT {c}, 1 FROM cur) GROUP BY 1),
ct_{n} AS (SELECT sum(n_ref) AS tot_ref, sum(n_cur) AS tot_cur, count(*) AS k FROM cc_{n}),
cs_{n} AS (SELECT n_ref / tot_ref AS p, n_cur / tot_cur AS q, n_ref, n_cur, tot_ref, tot_cur, k FROM cc_{n}, ct_{n}),
js_{n} AS (SELECT '{n}' AS "column", CAST(max(tot_ref) AS BIGINT) AS n_ref, CAST(max(tot_cur) AS BIGINT) AS n_cur,
                  max(k) AS n_categories,
                  sqrt(greatest(0.0, 0.5 * sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0.0 END)
                                   + 0.5 * sum(CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0.0 END))) AS js_distance,
                  sum(CASE WHEN n_ref > 0 THEN pow(n_cur - p * tot_cur, 2) / (p * tot_cur) END) AS chi2_stat,
                  count(*) FILTER (WHERE n_ref > 0) - 1 AS chi2_dof
           FROM cs_{n})"""


@register("d3_categorical_drift_halves", sql=f"""
WITH {SQL_HALVES}, {SQL_JS.format(n='event_type', c='event_type')}
SELECT "column", n_ref, n_cur, n_categories, round(js_distance, 9) AS js_distance, round(chi2_stat, 9) AS chi2_stat,
       chi2_dof FROM js_event_type
""")
def d3_categorical_drift_halves(spark, sf_dir):
    ref, cur = _halves(spark, sf_dir)
    cd = D.categorical_drift(ref, cur, ["event_type"])
    return _r9cols(cd.select("column", "n_ref", "n_cur", "n_categories", "js_distance", "chi2_stat", "chi2_dof"),
                   ["js_distance", "chi2_stat"])


@register("d4_dataset_drift_halves", sql=f"""
WITH {SQL_HALVES}, {_sql_numeric_drift('ref', 'cur', 'value', 'Amount')}, {SQL_JS.format(n='event_type', c='event_type')},
rep AS (SELECT wasserstein_norm >= 0.1 AS drifted FROM nd_Amount
        UNION ALL SELECT js_distance >= 0.1 FROM js_event_type)
SELECT count(*) AS n_columns, count(*) FILTER (WHERE drifted) AS n_drifted,
       count(*) FILTER (WHERE drifted) / count(*) AS drift_share,
       count(*) FILTER (WHERE drifted) / count(*) >= 0.5 AS dataset_drift FROM rep
""")
def d4_dataset_drift_halves(spark, sf_dir):
    ref, cur = _halves(spark, sf_dir)
    return D.detect_drift(ref, cur, ["Amount"], ["event_type"])


def _injected(spark, sf_dir):
    tx = S.transaction_table(spark, sf_dir)
    return tx, D.inject_drift(tx, ["event_id"], (), "Amount", "Time", seed=0)


SQL_INJ = f"""{SQL_TX},
inj AS (SELECT event_id,
               200000.0::DOUBLE * (CAST(CAST(('0x' || substr(md5(concat_ws('|', '0', 'time', CAST(event_id AS VARCHAR))), 1, 13)) AS BIGINT) AS DOUBLE) / 4503599627370496.0::DOUBLE) AS Time,
               1000.0::DOUBLE + 4000.0::DOUBLE * (CAST(CAST(('0x' || substr(md5(concat_ws('|', '0', 'amount', CAST(event_id AS VARCHAR))), 1, 13)) AS BIGINT) AS DOUBLE) / 4503599627370496.0::DOUBLE) AS Amount,
               Class FROM tx)"""


@register("d10_drift_injection", sql=f"""
WITH {SQL_INJ} SELECT event_id, Time, Amount, Class FROM inj
""")
def d10_drift_injection(spark, sf_dir):
    _, inj = _injected(spark, sf_dir)
    return inj  # same IEEE operations on both sides: compared without rounding


@register("d3_drift_report_injected", sql=f"""
WITH {SQL_INJ}, {_sql_numeric_drift('tx', 'inj', 'Time', 'Time')}, {_sql_numeric_drift('tx', 'inj', 'Amount', 'Amount')},
nd AS (SELECT * FROM nd_Time UNION ALL SELECT * FROM nd_Amount)
SELECT "column", 'wasserstein' AS stattest, round(wasserstein_norm, 9) AS score, 0.1::DOUBLE AS threshold,
       coalesce(wasserstein_norm >= 0.1, false) AS drifted
FROM nd
""")
def d3_drift_report_injected(spark, sf_dir):
    tx, inj = _injected(spark, sf_dir)
    return _r9cols(D.drift_report(tx, inj, ["Time", "Amount"]), ["score"])


SQL_WIN_REF = """
wref AS (SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-08 00:00:00')"""


@register("d7_windowed_psi", sql=f"""
WITH {SQL_WIN_REF},
e AS (SELECT [quantile_cont(value, 0.1), quantile_cont(value, 0.2), quantile_cont(value, 0.3), quantile_cont(value, 0.4),
              quantile_cont(value, 0.5), quantile_cont(value, 0.6), quantile_cont(value, 0.7), quantile_cont(value, 0.8),
              quantile_cont(value, 0.9)] AS edges FROM wref),
rb AS (SELECT len(list_filter(edges, lambda x: x < value)) AS bin, count(*) AS n FROM wref, e GROUP BY 1),
rs AS (SELECT bin, n / sum(n) OVER () AS ref_share FROM rb),
cb AS (SELECT date_trunc('day', ts) AS ws, len(list_filter(edges, lambda x: x < value)) AS bin, count(*) AS n
       FROM events, e GROUP BY 1, 2),
wn AS (SELECT ws, sum(n) AS n_rows FROM cb GROUP BY ws),
g AS (SELECT ws, n_rows, b AS bin FROM wn, range(10) r(b)),
f AS (SELECT g.ws, g.n_rows, greatest(coalesce(cb.n, 0) / g.n_rows, 0.0001) AS c, greatest(coalesce(rs.ref_share, 0.0), 0.0001) AS r
      FROM g LEFT JOIN cb ON cb.ws = g.ws AND cb.bin = g.bin LEFT JOIN rs ON rs.bin = g.bin)
SELECT ws AS window_start, ws + INTERVAL 1 DAY AS window_end, 'Amount' AS "column", 'psi' AS statistic,
       round(sum((c - r) * ln(c / r)), 9) AS value, CAST(n_rows AS BIGINT) AS n_rows FROM f GROUP BY ws, n_rows
""")
def d7_windowed_psi(spark, sf_dir):
    tx = S.transaction_table(spark, sf_dir, keep_ts=True)
    ref = tx.filter(F.col("ts") < F.lit(REF_END_TS).cast("timestamp_ntz"))
    return _r9cols(D.windowed_psi(ref, tx, "ts", "Amount", "1 day", 10), ["value"])


SQL_WIN_JS = """
rc AS (SELECT CAST({c} AS VARCHAR) AS cat, count(*) AS n FROM {ref} GROUP BY 1),
rs AS (SELECT cat, n / sum(n) OVER () AS p FROM rc),
cc AS (SELECT date_trunc('day', ts) AS ws, CAST({c} AS VARCHAR) AS cat, count(*) AS n FROM {cur} GROUP BY 1, 2),
wn AS (SELECT ws, sum(n) AS n_rows FROM cc GROUP BY ws),
cats AS (SELECT cat FROM rs UNION SELECT cat FROM cc),
f AS (SELECT wn.ws, wn.n_rows, coalesce(rs.p, 0.0) AS p, coalesce(cc.n, 0) / wn.n_rows AS q
      FROM wn CROSS JOIN cats LEFT JOIN cc ON cc.ws = wn.ws AND cc.cat IS NOT DISTINCT FROM cats.cat LEFT JOIN rs ON rs.cat IS NOT DISTINCT FROM cats.cat)
SELECT ws AS window_start, ws + INTERVAL 1 DAY AS window_end, '{name}' AS "column", 'jensenshannon' AS statistic,
       round(sqrt(greatest(0.0, 0.5 * sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0.0 END)
                           + 0.5 * sum(CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0.0 END))), 9) AS value,
       CAST(n_rows AS BIGINT) AS n_rows
FROM f GROUP BY ws, n_rows"""


@register("d5_label_drift_by_day", sql=f"""
WITH {SQL_TX}, txt AS (SELECT tx.*, events.ts FROM tx JOIN events USING (event_id)),
wref AS (SELECT * FROM txt WHERE ts < TIMESTAMP '2024-01-08 00:00:00'),
{SQL_WIN_JS.format(c='Class', ref='wref', cur='txt', name='Class')}
""")
def d5_label_drift_by_day(spark, sf_dir):
    tx = S.transaction_table(spark, sf_dir, keep_ts=True)
    ref = tx.filter(F.col("ts") < F.lit(REF_END_TS).cast("timestamp_ntz"))
    return _r9cols(D.windowed_js(ref, tx, "ts", "Class", "1 day"), ["value"])


ALERT_THRESHOLDS = {"psi": 0.05, "jensenshannon": 0.1}


@register("d8_drift_alerts", sql=f"""
WITH {SQL_WIN_REF},
e AS (SELECT [quantile_cont(value, 0.1), quantile_cont(value, 0.2), quantile_cont(value, 0.3), quantile_cont(value, 0.4),
              quantile_cont(value, 0.5), quantile_cont(value, 0.6), quantile_cont(value, 0.7), quantile_cont(value, 0.8),
              quantile_cont(value, 0.9)] AS edges FROM wref),
rb AS (SELECT len(list_filter(edges, lambda x: x < value)) AS bin, count(*) AS n FROM wref, e GROUP BY 1),
rs AS (SELECT bin, n / sum(n) OVER () AS ref_share FROM rb),
cb AS (SELECT date_trunc('day', ts) AS ws, len(list_filter(edges, lambda x: x < value)) AS bin, count(*) AS n
       FROM events, e GROUP BY 1, 2),
wn AS (SELECT ws, sum(n) AS n_rows FROM cb GROUP BY ws),
g AS (SELECT ws, n_rows, b AS bin FROM wn, range(10) r(b)),
f AS (SELECT g.ws, greatest(coalesce(cb.n, 0) / g.n_rows, 0.0001) AS c, greatest(coalesce(rs.ref_share, 0.0), 0.0001) AS r
      FROM g LEFT JOIN cb ON cb.ws = g.ws AND cb.bin = g.bin LEFT JOIN rs ON rs.bin = g.bin),
p AS (SELECT ws, sum((c - r) * ln(c / r)) AS value FROM f GROUP BY ws)
SELECT ws AS window_start, 'Amount' AS "column", 'psi' AS statistic, round(value, 9) AS value, 0.05::DOUBLE AS threshold
FROM p WHERE value > 0.05
""")
def d8_drift_alerts(spark, sf_dir):
    tx = S.transaction_table(spark, sf_dir, keep_ts=True)
    ref = tx.filter(F.col("ts") < F.lit(REF_END_TS).cast("timestamp_ntz"))
    al = D.drift_alerts(D.windowed_psi(ref, tx, "ts", "Amount", "1 day", 10), ALERT_THRESHOLDS)
    return _r9cols(al.select("window_start", "column", "statistic", "value", "threshold"), ["value"])


SQL_DOC_SCORES = """
pred AS (SELECT doc_id, lang, CAST(n_chars AS DOUBLE) / (CAST(n_chars AS DOUBLE) + 2000.0) AS p FROM documents),
lab AS (SELECT doc_id, CAST(toxic AS BIGINT) AS y FROM labels)"""


@register("d6_delayed_label_quality", sql=f"""
WITH {SQL_DOC_SCORES},
j AS (SELECT pred.*, lab.y FROM pred LEFT JOIN lab USING (doc_id)),
sm AS (SELECT lang AS model_id, y, p FROM j WHERE y IS NOT NULL),
{SQL_CURVE.strip()}, {SQL_MODEL_METRICS},
pend AS (SELECT lang, count(*) FILTER (WHERE y IS NULL) AS n_unlabelled FROM j GROUP BY lang)
SELECT mm.model_id AS lang, tp, fp, fn, tn, precision, recall, f1, pr_auc, n_unlabelled
FROM mm JOIN pend ON pend.lang = mm.model_id
""")
def d6_delayed_label_quality(spark, sf_dir):
    docs = S.load(spark, sf_dir, "documents")
    pred = docs.select("doc_id", "lang", (F.col("n_chars").cast("double")
                                          / (F.col("n_chars").cast("double") + F.lit(2000.0))).alias("p"))
    lab = S.load(spark, sf_dir, "labels").select("doc_id", F.col("toxic").cast("long").alias("y"))
    q = D.delayed_label_quality(pred, lab, "doc_id", 0.5, by=["lang"])
    return _r9cols(q, ["precision", "recall", "f1", "pr_auc"])


def _two_scores(spark, sf_dir):
    """Two stand-in models over all transactions: rational scores of Amount and of Time."""
    tx = S.transaction_table(spark, sf_dir)
    return tx.select("event_id", F.col("Class").alias("y"),
                     (F.col("Amount") / (F.col("Amount") + F.lit(50.0))).alias("p_amount"),
                     (F.col("Time") / (F.col("Time") + F.lit(1300000.0))).alias("p_time"))


SQL_TWO = f"""{SQL_TX},
two AS (SELECT event_id, Class AS y, Amount / (Amount + 50.0) AS p_amount, Time / (Time + 1300000.0) AS p_time FROM tx)"""


@register("d11_champion_challenger", sql=f"""
WITH {SQL_TWO},
arm AS (SELECT *, CASE WHEN CAST(('0x' || substr(md5(concat_ws('|', '42', CAST(event_id AS VARCHAR))), 1, 13)) AS BIGINT)
                            / 4503599627370496.0 < 0.3 THEN 'challenger' ELSE 'champion' END AS arm FROM two),
sm AS (SELECT arm AS model_id, y, CASE WHEN arm = 'challenger' THEN p_time ELSE p_amount END AS p FROM arm),
{SQL_CURVE.strip()}, {SQL_MODEL_METRICS}
SELECT model_id AS arm, tp, fp, fn, tn, precision, recall, f1, pr_auc FROM mm
""")
def d11_champion_challenger(spark, sf_dir):
    arms = D.assign_arm(_two_scores(spark, sf_dir), ["event_id"], 0.3, SEED)
    sc = arms.select("arm", "y", F.when(F.col("arm") == "challenger", F.col("p_time"))
                     .otherwise(F.col("p_amount")).alias("p"))
    m = E.model_metrics(sc, 0.5, by=["arm"])
    return _r9cols(m, ["precision", "recall", "f1", "pr_auc"])


@register("d12_shadow_agreement", sql=f"""
WITH {SQL_TWO}
SELECT CAST(p_amount >= 0.5 AS INTEGER) AS pred_a, CAST(p_time >= 0.5 AS INTEGER) AS pred_b, count(*) AS n,
       count(*) FILTER (WHERE y = 1) AS n_pos, count(*) / (SELECT count(*) FROM two) AS share
FROM two GROUP BY 1, 2
""")
def d12_shadow_agreement(spark, sf_dir):
    two = _two_scores(spark, sf_dir)
    a = two.select("event_id", "y", F.col("p_amount").alias("p"))
    b = two.select("event_id", F.col("p_time").alias("p"))
    return D.shadow_agreement(a, b, "event_id", 0.5)


@register("d12_shadow_metric_gap", sql=f"""
WITH {SQL_TWO},
sm AS (SELECT 'a' AS model_id, y, p_amount AS p FROM two UNION ALL SELECT 'b', y, p_time FROM two),
{SQL_CURVE.strip()}, {SQL_MODEL_METRICS},
a AS (SELECT * FROM mm WHERE model_id = 'a'), b AS (SELECT * FROM mm WHERE model_id = 'b')
SELECT a.pr_auc AS a_pr_auc, a.precision AS a_precision, a.recall AS a_recall,
       b.pr_auc AS b_pr_auc, b.precision AS b_precision, b.recall AS b_recall,
       round(b.pr_auc - a.pr_auc, 9) AS gap_pr_auc, round(b.precision - a.precision, 9) AS gap_precision,
       round(b.recall - a.recall, 9) AS gap_recall
FROM a, b
""")
def d12_shadow_metric_gap(spark, sf_dir):
    two = _two_scores(spark, sf_dir)
    a = two.select("event_id", "y", F.col("p_amount").alias("p"))
    b = two.select("event_id", F.col("p_time").alias("p"))
    g = D.shadow_metric_gap(a, b, "event_id", 0.5)
    for m in ("a", "b"):
        g = _r9cols(g, [f"{m}_pr_auc", f"{m}_precision", f"{m}_recall"])
    # reported gaps are gaps of the reported (rounded) metrics, as in the SQL
    for x in ("pr_auc", "precision", "recall"):
        g = g.withColumn(f"gap_{x}", r9(F.col(f"b_{x}") - F.col(f"a_{x}")))
    return g


def _corr_weights(spark, sf_dir):
    feat = S.feature_table(spark, sf_dir)
    row = feat.agg(*[F.corr(v, F.col("Class").cast("double")).alias(f"w_{v}") for v in S.E_COLUMNS],
                   *[F.avg(v).alias(f"m_{v}") for v in S.E_COLUMNS]).first()  # 56 numbers: the linear model
    return feat, {v: row[f"w_{v}"] for v in S.E_COLUMNS}, {v: row[f"m_{v}"] for v in S.E_COLUMNS}


@register("d13_linear_contributions", sql=f"""
WITH feat AS ({FEAT_SQL}),
long AS (UNPIVOT (SELECT vec_id, Class, {", ".join(S.E_COLUMNS)} FROM feat) ON {", ".join(S.E_COLUMNS)} INTO NAME feature VALUE x),
wm AS (SELECT feature, corr(x, CAST(Class AS DOUBLE)) AS w, avg(x) AS m FROM long GROUP BY feature),
c AS (SELECT vec_id, feature, w * (x - m) AS contribution FROM long JOIN wm USING (feature)),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY abs(contribution) DESC, feature) AS rank FROM c)
SELECT vec_id, CAST(rank AS INTEGER) AS rank, feature, round(contribution, 9) AS contribution FROM r WHERE rank <= 3
""")
def d13_linear_contributions(spark, sf_dir):
    """Per-row top-3 contributions of a linear scorer whose weights are the features'
    correlations with the label (a model fitted by Spark on the same table)."""
    feat, w, m = _corr_weights(spark, sf_dir)
    return _r9cols(D.linear_contributions(feat, ["vec_id"], w, m, 3), ["contribution"])


# ----------------------------------------------------------------------------
# M: imbalance handling and training (features = embeddings stand-in)
from raresight.operators import train as M  # noqa: E402
from raresight.plans import logistic_gradient  # noqa: E402

# fixed values: the reference's model parameters
LR_PARAMS = {"model": "logistic_regression", "max_iter": 1000, "random_state": 42, "resampling": "none"}
GBT_PARAMS = {"model": "xgboost", "n_estimators": 300, "max_depth": 5, "learning_rate": 0.1,
              "scale_pos_weight": None, "random_state": 42, "resampling": "none"}
THRESHOLD = 0.03


def _feature_split(spark, sf_dir):
    feat = S.feature_table(spark, sf_dir)
    sp = T.stratified_split(feat, ["vec_id"], "Class", TEST_SIZE, SEED)
    return sp.filter(F.col("split") == "train").drop("split"), sp.filter(F.col("split") == "test").drop("split")


SQL_FEAT_SPLIT = f"""
feat AS ({FEAT_SQL}),
fh AS (SELECT *, md5(concat_ws('|', '42', CAST(vec_id AS VARCHAR))) AS h FROM feat),
fr AS (SELECT *, row_number() OVER (PARTITION BY Class ORDER BY h) AS rn, count(*) OVER (PARTITION BY Class) AS n_c FROM fh),
ftrain AS (SELECT * FROM fr WHERE rn > floor(CAST(n_c AS DOUBLE) * 0.2))"""


@register("m1_balanced_weights", sql=f"""
WITH feat AS ({FEAT_SQL}),
c AS (SELECT Class, count(*) AS n_c FROM feat GROUP BY Class)
SELECT vec_id, Class, (SELECT count(*) FROM feat) / (2 * n_c) AS weight FROM feat JOIN c USING (Class)
""")
def m1_balanced_weights(spark, sf_dir):
    return M.with_balanced_weights(S.feature_table(spark, sf_dir), "Class").select("vec_id", "Class", "weight")


@register("m2_positive_weight", sql=f"""
WITH {SQL_FEAT_SPLIT},
w AS (SELECT count(*) FILTER (WHERE Class <> 1) / nullif(count(*) FILTER (WHERE Class = 1), 0) AS w FROM ftrain)
SELECT vec_id, Class, CASE WHEN Class = 1 THEN w ELSE 1.0 END AS weight FROM ftrain, w
""")
def m2_positive_weight(spark, sf_dir):
    train, _ = _feature_split(spark, sf_dir)
    return M.with_positive_weight(train, "Class").select("vec_id", "Class", "weight")


@register("m5_smote_class_counts", sql=f"""
WITH {SQL_FEAT_SPLIT},
c AS (SELECT count(*) FILTER (WHERE Class = 1) AS p, count(*) FILTER (WHERE Class <> 1) AS n FROM ftrain)
SELECT CAST(1 AS BIGINT) AS Class, false AS synthetic, p AS n_rows FROM c
UNION ALL SELECT 1, true, n - p FROM c
UNION ALL SELECT 0, false, n FROM c
""")
def m5_smote_class_counts(spark, sf_dir):
    train, _ = _feature_split(spark, sf_dir)
    res = M.smote(train, S.E_COLUMNS, "Class", "vec_id", 5, SEED)
    return res.groupBy("Class", "synthetic").agg(F.count(F.lit(1)).alias("n_rows"))


def _smote_sql() -> str:
    v = S.E_COLUMNS
    dist = " + ".join(f"pow(a.{c} - b.{c}, 2)" for c in v)
    u_nn = "(CAST(CAST(('0x' || substr(md5(concat_ws('|', '42', 'nn', CAST(sm.vec_id AS VARCHAR), CAST(sm.i AS VARCHAR))), 1, 13)) AS BIGINT) AS DOUBLE) / 4503599627370496.0::DOUBLE)"
    u_gap = "(CAST(CAST(('0x' || substr(md5(concat_ws('|', '42', 'gap', CAST(sm.vec_id AS VARCHAR), CAST(sm.i AS VARCHAR))), 1, 13)) AS BIGINT) AS DOUBLE) / 4503599627370496.0::DOUBLE)"
    interp = ", ".join(f"x.{c} + s.u * (n.{c} - x.{c}) AS {c}" for c in v)
    cols = ", ".join(v)
    return f"""
WITH {SQL_FEAT_SPLIT.strip()},
tr AS (SELECT vec_id, {cols}, Class FROM ftrain),
pos AS (SELECT * FROM tr WHERE Class = 1),
cnt AS (SELECT count(*) FILTER (WHERE Class = 1) AS n_pos, count(*) FILTER (WHERE Class <> 1) AS n_neg FROM tr),
kk AS (SELECT least(5, n_pos - 1) AS k, (n_neg - n_pos) // n_pos AS per, (n_neg - n_pos) % n_pos AS extra FROM cnt),
nn AS (SELECT a.vec_id, b.vec_id AS nn_id,
              row_number() OVER (PARTITION BY a.vec_id ORDER BY sqrt({dist}), b.vec_id) - 1 AS j
       FROM pos a JOIN pos b ON a.vec_id <> b.vec_id),
rk AS (SELECT vec_id, row_number() OVER (ORDER BY md5(concat_ws('|', '42', CAST(vec_id AS VARCHAR)))) - 1 AS r FROM pos),
al AS (SELECT rk.vec_id, kk.per + CASE WHEN rk.r < kk.extra THEN 1 ELSE 0 END AS c, kk.k FROM rk, kk),
sm AS (SELECT al.vec_id, g.i, al.k FROM al, LATERAL (SELECT unnest(range(1, al.c + 1)) AS i) g),
s AS (SELECT sm.vec_id, sm.i, CAST(floor({u_nn} * sm.k) AS INTEGER) AS j, {u_gap} AS u FROM sm),
syn AS (SELECT CAST(NULL AS BIGINT) AS vec_id, {interp}, CAST(1 AS BIGINT) AS Class, true AS synthetic
        FROM s JOIN nn ON nn.vec_id = s.vec_id AND nn.j = s.j
               JOIN pos x ON x.vec_id = s.vec_id JOIN pos n ON n.vec_id = nn.nn_id)
SELECT vec_id, {cols}, Class, false AS synthetic FROM tr
UNION ALL SELECT * FROM syn
"""


@register("m5_smote_rows", sql=_smote_sql())
def m5_smote_rows(spark, sf_dir):
    """The resampled training frame itself (synthetic rows have a null key)."""
    train, _ = _feature_split(spark, sf_dir)
    return M.smote(train, S.E_COLUMNS, "Class", "vec_id", 5, SEED)


def _fit_score(spark, sf_dir, params):
    train, test = _feature_split(spark, sf_dir)
    model = M.fit_model(train, S.E_COLUMNS, params, "Class", "vec_id")
    return M.score(model, test, THRESHOLD).select("vec_id", "Class", "fraud_probability", "is_fraud")


@register("m3_logistic_regression_scores")
def m3_logistic_regression_scores(spark, sf_dir):
    return _fit_score(spark, sf_dir, LR_PARAMS)


@register("m3_logistic_regression_smote_scores")
def m3_logistic_regression_smote_scores(spark, sf_dir):
    return _fit_score(spark, sf_dir, dict(LR_PARAMS, resampling="smote"))


@register("m4_boosted_trees_scores")
def m4_boosted_trees_scores(spark, sf_dir):
    return _fit_score(spark, sf_dir, GBT_PARAMS)


# one tree of depth 1 over every distinct value: second-order gain, positive weight, reg_lambda 1, min_child_weight 1
SQL_STUMP = f"""
{SQL_FEAT_SPLIT.strip()},
pw AS (SELECT count(*) FILTER (WHERE Class <> 1) / nullif(count(*) FILTER (WHERE Class = 1), 0) AS w FROM ftrain),
gh AS (SELECT {", ".join(S.E_COLUMNS)}, CASE WHEN Class = 1 THEN w ELSE 1.0 END * (0.5 - Class) AS g, CASE WHEN Class = 1 THEN w ELSE 1.0 END * 0.25 AS h FROM ftrain, pw),
long AS (UNPIVOT gh ON {", ".join(S.E_COLUMNS)} INTO NAME feature VALUE x),
hist AS (SELECT feature, x, sum(g) AS g, sum(h) AS h FROM long GROUP BY ALL),
cums AS (SELECT feature, x, sum(g) OVER o AS gl, sum(h) OVER o AS hl, sum(g) OVER (PARTITION BY feature) AS gt, sum(h) OVER (PARTITION BY feature) AS ht, lead(x) OVER o AS nx
         FROM hist WINDOW o AS (PARTITION BY feature ORDER BY x)),
gains AS (SELECT *, round(gl * gl / (hl + 1) + (gt - gl) * (gt - gl) / (ht - hl + 1) - gt * gt / (ht + 1), 6) AS gain FROM cums WHERE nx IS NOT NULL AND hl >= 1 AND ht - hl >= 1),
stump AS (SELECT feature, x AS value, gain, -0.1 * gl / (hl + 1) AS below, -0.1 * (gt - gl) / (ht - hl + 1) AS above FROM gains ORDER BY gain DESC, CAST(substr(feature, 2) AS INTEGER), x LIMIT 1)"""
STUMP_PARAMS = dict(GBT_PARAMS, n_estimators=1, max_depth=1)


@register("m4_stump", sql=f"""
WITH {SQL_STUMP} SELECT feature, CAST(value AS DOUBLE) AS value, gain, round(below, 9) AS below, round(above, 9) AS above FROM stump
""")
def m4_stump(spark, sf_dir):
    """The first tree of the weighted boosted model, of depth 1 and exact over all distinct values."""
    train, _ = _feature_split(spark, sf_dir)
    tree = M.fit_boosted_trees(train, S.E_COLUMNS, STUMP_PARAMS, bins=None).trees[0]
    root = tree.splits[1]
    row = (S.E_COLUMNS[root.feature], root.value, root.gain, round(tree.leaves[2], 9), round(tree.leaves[3], 9))
    return spark.createDataFrame([row], "feature string, value double, gain double, below double, above double")


@register("m4_stump_scores", sql=f"""
WITH {SQL_STUMP},
long_test AS (UNPIVOT (SELECT vec_id, Class, {", ".join(S.E_COLUMNS)} FROM fr WHERE rn <= floor(CAST(n_c AS DOUBLE) * 0.2)) ON {", ".join(S.E_COLUMNS)} INTO NAME feature VALUE x),
p AS (SELECT vec_id, Class, 1 / (1 + exp(-CASE WHEN x <= value THEN below ELSE above END)) AS p FROM long_test JOIN stump USING (feature))
SELECT vec_id, Class, round(p, 9) AS fraud_probability, CAST(p >= 0.5 AS INTEGER) AS is_fraud FROM p
""")
def m4_stump_scores(spark, sf_dir):
    train, test = _feature_split(spark, sf_dir)
    model = M.fit_boosted_trees(train, S.E_COLUMNS, STUMP_PARAMS, bins=None)
    return M.score(model, test, 0.5).select("vec_id", "Class", F.round("fraud_probability", 9).alias("fraud_probability"), "is_fraud")


@register("m8_model_metrics")
def m8_model_metrics(spark, sf_dir):
    """Precision, recall, F1 at the versioned threshold and PR-AUC of the fitted model."""
    sc = _fit_score(spark, sf_dir, LR_PARAMS).select(F.col("Class").alias("y"), F.col("fraud_probability").alias("p"))
    return E.model_metrics(sc.withColumn("model_id", F.lit("logistic_regression")), THRESHOLD)


@register("m9_cross_validated_pr_auc")
def m9_cross_validated_pr_auc(spark, sf_dir):
    train, _ = _feature_split(spark, sf_dir)
    return M.cross_validate_pr_auc(train, S.E_COLUMNS, LR_PARAMS, "Class", "vec_id", 5, SEED)


def _newton_sql(steps: int = 12) -> str:
    """``fit`` (m, it, b0, b1, b2): Newton steps for the penalised, weighted logistic loss of the rows ``d`` (m, y, z1, z2, w)."""
    g0, g1, g2 = "sum(w * (y - p))", "sum(w * (y - p) * z1) - b1", "sum(w * (y - p) * z2) - b2"
    h = {"aa": "1", "ab": "z1", "ac": "z2", "bb": "z1 * z1", "bc": "z1 * z2", "cc": "z2 * z2"}
    second = ", ".join(f"sum(w * p * (1 - p) * {x}){' + 1' if n in ('bb', 'cc') else ''} AS {n}" for n, x in h.items())
    return f"""
fit AS (
  SELECT DISTINCT m, 0 AS it, 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2 FROM d
  UNION ALL
  SELECT m, it + 1,
         b0 + (g0 * (bb * cc - bc * bc) - ab * (g1 * cc - bc * g2) + ac * (g1 * bc - bb * g2)) / det,
         b1 + (aa * (g1 * cc - bc * g2) - g0 * (ab * cc - bc * ac) + ac * (ab * g2 - g1 * ac)) / det,
         b2 + (aa * (bb * g2 - g1 * bc) - ab * (ab * g2 - g1 * ac) + g0 * (ab * bc - bb * ac)) / det
  FROM (SELECT *, aa * (bb * cc - bc * bc) - ab * (ab * cc - bc * ac) + ac * (ab * bc - bb * ac) AS det
        FROM (SELECT m, it, b0, b1, b2, {g0} AS g0, {g1} AS g1, {g2} AS g2, {second}
              FROM (SELECT d.*, it, b0, b1, b2, 1 / (1 + exp(-(b0 + b1 * z1 + b2 * z2))) AS p FROM d JOIN fit USING (m) WHERE it < {steps}) GROUP BY m, it, b0, b1, b2))),
fitted AS (SELECT m, b0, b1, b2 FROM fit WHERE it = {steps})"""


# rows of the transaction split as the model sees them: scaled and weighted by the training part alone
SQL_TX_MODEL = f"""
{SQL_TX.strip()}, {SQL_SPLIT.strip()},
moments AS (SELECT avg(Time) AS m1, stddev_pop(Time) AS s1, avg(Amount) AS m2, stddev_pop(Amount) AS s2, count(*) AS n, sum(Class) AS n1 FROM sp WHERE split = 'train'),
z AS (SELECT event_id, Class, split, (Time - m1) / s1 AS z1, (Amount - m2) / s2 AS z2, CASE WHEN Class = 1 THEN n / (2 * n1) ELSE n / (2 * (n - n1)) END AS w FROM sp, moments),
d AS (SELECT 0 AS m, Class AS y, z1, z2, w FROM z WHERE split = 'train'),
{_newton_sql().strip()},
scored AS (SELECT event_id, Class, 1 / (1 + exp(-(b0 + b1 * z1 + b2 * z2))) AS p FROM z, fitted WHERE split = 'test')"""
TX_FEATURES = ["Time", "Amount"]
SQL_AP = """
steps AS (SELECT {by} p, sum(y) AS n_pos, count(*) AS n FROM ps GROUP BY ALL),
run AS (SELECT *, sum(n_pos) OVER ({part} ORDER BY p DESC) AS tps, sum(n) OVER ({part} ORDER BY p DESC) AS seen FROM steps),
ap AS (SELECT {by} coalesce(sum(n_pos * (tps / seen)) / nullif(sum(n_pos), 0), 0.0) AS pr_auc FROM run {group})"""


def _tx_model(spark, sf_dir):
    """(test rows as they came, the training rows' standardiser, the model fitted on the scaled training rows)"""
    tx = S.transaction_table(spark, sf_dir)
    sp = T.stratified_split(tx, ["event_id"], "Class", TEST_SIZE, SEED)
    train = sp.filter(F.col("split") == "train").drop("split")
    params = T.fit_standardizer(train, TX_FEATURES).collect()
    model = M.fit_logistic(T.apply_standardizer(train, params), TX_FEATURES, LR_PARAMS, "Class", "event_id")
    return sp.filter(F.col("split") == "test").drop("split"), params, model


@register("d1_raw_to_decision", sql=f"""
WITH RECURSIVE {SQL_TX_MODEL}
SELECT event_id, Class, round(p, 6) AS fraud_probability, CAST(p >= 0.5 AS INTEGER) AS is_fraud FROM scored
""")
def d1_raw_to_decision(spark, sf_dir):
    """Raw transactions -> standardiser fitted on train -> model -> decision, on test rows."""
    test, params, model = _tx_model(spark, sf_dir)
    return M.raw_to_decision(test, params, model, 0.5).select("event_id", "Class", F.round("fraud_probability", 6).alias("fraud_probability"), "is_fraud")


@register("m3_logistic_coefficients", sql=f"""
WITH RECURSIVE {SQL_TX_MODEL}
SELECT unnest(['intercept', 'Time', 'Amount']) AS term, round(unnest([b0, b1, b2]), 6) AS coefficient, true AS optimal FROM fitted
""")
def m3_logistic_coefficients(spark, sf_dir):
    """The fitted coefficients, each with the check that the penalised gradient, summed from the rows, is 0 there."""
    tx = S.transaction_table(spark, sf_dir)
    sp = T.stratified_split(tx, ["event_id"], "Class", TEST_SIZE, SEED)
    train = sp.filter(F.col("split") == "train").drop("split")
    weighted = M.with_balanced_weights(T.apply_standardizer(train, T.fit_standardizer(train, TX_FEATURES).collect()), "Class")
    model = M.fit_logistic(weighted.drop("weight"), TX_FEATURES, LR_PARAMS, "Class", "event_id")
    check = logistic_gradient(weighted, TX_FEATURES, model.coefficients, model.intercept, "Class", "weight")
    value = F.create_map(*[x for t, b in zip(["intercept", *TX_FEATURES], [model.intercept, *model.coefficients]) for x in (F.lit(t), F.lit(b))])
    return check.select("term", F.round(value[F.col("term")], 6).alias("coefficient"), (F.abs("gradient") <= 1e-8 * F.col("scale")).alias("optimal"))


@register("m3_logistic_optimality", sql="SELECT unnest(['intercept', " + ", ".join(f"'{c}'" for c in S.E_COLUMNS) + "]) AS term, true AS optimal")
def m3_logistic_optimality(spark, sf_dir):
    """Spark ML's fit on all feature columns: the penalised gradient, summed from the rows, is nearly 0 in every term."""
    train, _ = _feature_split(spark, sf_dir)
    model = M.fit_model(train, S.E_COLUMNS, LR_PARAMS, "Class", "vec_id").stages[-1]
    check = logistic_gradient(M.with_balanced_weights(train, "Class"), S.E_COLUMNS, model.coefficients.toArray().tolist(), model.intercept, "Class", "weight")
    return check.select("term", (F.abs("gradient") <= 1e-3 * F.col("scale")).alias("optimal"))


@register("m8_transaction_metrics", sql=f"""
WITH RECURSIVE {SQL_TX_MODEL},
ps AS (SELECT Class AS y, round(p, 9) AS p FROM scored),
{SQL_AP.format(by="", part="", group="").strip()},
conf AS (SELECT count(*) FILTER (WHERE p >= 0.5 AND y = 1) AS tp, count(*) FILTER (WHERE p >= 0.5 AND y <> 1) AS fp, count(*) FILTER (WHERE p < 0.5 AND y = 1) AS fn FROM ps)
SELECT 'logistic_regression' AS model_id, round(coalesce(tp / nullif(tp + fp, 0), 0.0), 6) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0.0), 6) AS recall,
       round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0), 6) AS f1, round(pr_auc, 6) AS pr_auc FROM conf, ap
""")
def m8_transaction_metrics(spark, sf_dir):
    """Score and threshold of the model fitted on the scaled transactions: its metrics on the test rows."""
    test, params, model = _tx_model(spark, sf_dir)
    scored = M.raw_to_decision(test, params, model, 0.5).select(F.col("Class").alias("y"), F.round("fraud_probability", 9).alias("p"), F.lit("logistic_regression").alias("model_id"))
    out = E.model_metrics(scored, 0.5)
    return out.select("model_id", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1", "pr_auc")])


@register("m9_transaction_cross_validation", sql=f"""
WITH RECURSIVE {SQL_TX.strip()},
hs AS (SELECT *, md5(concat_ws('|', '42', CAST(event_id AS VARCHAR))) AS h FROM tx),
rk AS (SELECT *, row_number() OVER (PARTITION BY Class ORDER BY h) - 1 AS r, count(*) OVER (PARTITION BY Class) AS n_c FROM hs),
fo AS (SELECT event_id, Time, Amount, Class, (floor(n_c * 1 / 5) <= r)::INT + (floor(n_c * 2 / 5) <= r)::INT + (floor(n_c * 3 / 5) <= r)::INT + (floor(n_c * 4 / 5) <= r)::INT AS fold FROM rk),
moments AS (SELECT m, avg(Time) AS m1, stddev_pop(Time) AS s1, avg(Amount) AS m2, stddev_pop(Amount) AS s2, count(*) AS n, sum(Class) AS n1 FROM fo, range(5) t(m) WHERE fold <> m GROUP BY m),
z AS (SELECT m, fold, Class AS y, (Time - m1) / s1 AS z1, (Amount - m2) / s2 AS z2, CASE WHEN Class = 1 THEN n / (2 * n1) ELSE n / (2 * (n - n1)) END AS w FROM fo, moments),
d AS (SELECT m, y, z1, z2, w FROM z WHERE fold <> m),
{_newton_sql().strip()},
ps AS (SELECT fold, y, round(1 / (1 + exp(-(b0 + b1 * z1 + b2 * z2))), 9) AS p FROM z JOIN fitted USING (m) WHERE fold = m),
{SQL_AP.format(by="fold,", part="PARTITION BY fold", group="GROUP BY fold").strip()}
SELECT CAST(fold AS INTEGER) AS fold, round(pr_auc, 6) AS pr_auc, round(avg(pr_auc) OVER (), 6) AS mean_pr_auc, round(stddev_pop(pr_auc) OVER (), 6) AS std_pr_auc FROM ap
""")
def m9_transaction_cross_validation(spark, sf_dir):
    """Five models fitted together, scaled and weighted inside their own training parts; PR-AUC per fold, mean and std."""
    tx = S.transaction_table(spark, sf_dir)
    out = M.cross_validate_pr_auc(tx, TX_FEATURES, LR_PARAMS, "Class", "event_id", 5, SEED, scale_cols=TX_FEATURES, digits=9)
    return out.select("fold", *[F.round(c, 6).alias(c) for c in ("pr_auc", "mean_pr_auc", "std_pr_auc")])


# ----------------------------------------------------------------------------
# Streaming forms (run to completion with an availableNow trigger; results land in
# the shared folder and are read back)
from raresight.session import scratch_path  # noqa: E402
from raresight.streaming import jobs as ST  # noqa: E402

STREAM_DELAY_US = 86_400_000_000  # watermark delay of the windowed stream: one day


@register("d7_streaming_bin_counts", sql="""
WITH wref AS (SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-08 00:00:00'),
e AS (SELECT [quantile_cont(value, 0.1), quantile_cont(value, 0.2), quantile_cont(value, 0.3), quantile_cont(value, 0.4),
              quantile_cont(value, 0.5), quantile_cont(value, 0.6), quantile_cont(value, 0.7), quantile_cont(value, 0.8),
              quantile_cont(value, 0.9)] AS edges FROM wref),
b AS (SELECT date_trunc('day', ts) AS window_start, len(list_filter(edges, lambda x: x < value)) AS bin FROM events, e)
SELECT window_start, CAST(bin AS INTEGER) AS bin, count(*) AS n FROM b
WHERE window_start + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY
GROUP BY ALL
""")
def d7_streaming_bin_counts(spark, sf_dir):
    """Windowed bin counts from the events file stream: windows are emitted once the
    watermark (max event time - 1 day) passes their end, so the last open windows stay in state."""
    ev = S.load(spark, sf_dir, "events")
    ref = ev.filter(F.col("ts") < F.lit(REF_END_TS).cast("timestamp_ntz"))
    edges = D.reference_bins(ref, "value", 10).first()["edges"]  # 9 numbers: the reference's bins
    counts = ST.windowed_bin_counts(ST.read_table_stream(spark, sf_dir, "events"), "ts", "value", edges)
    out = scratch_path(spark, "bin-counts")
    q = counts.select("window_start", "bin", "n").writeStream.format("parquet") \
        .option("path", out).option("checkpointLocation", out + "-ckpt").outputMode("append") \
        .trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(out)


# ----------------------------------------------------------------------------
# S: sources and sinks — data Spark derives from the given tables, written to the
# shared folder and read back through the operator under test.
from raresight.sources import files as IO  # noqa: E402

TX_SCHEMA = "event_id bigint, Time double, Amount double, Class bigint"


@register("s1_csv_scan", sql=f"WITH {SQL_TX} SELECT * FROM tx")
def s1_csv_scan(spark, sf_dir):
    """Transactions written as header CSV, read back with the declared schema (FAILFAST)."""
    from pyspark.sql.types import _parse_datatype_string
    path = scratch_path(spark, "transactions-csv")
    S.transaction_table(spark, sf_dir).write.option("header", True).csv(path)
    return IO.read_csv(spark, path, _parse_datatype_string(TX_SCHEMA))


@register("s3_split_sink_and_scan", sql=f"WITH {SQL_TX}, {SQL_SPLIT} SELECT event_id, Time, Amount, Class, split FROM sp")
def s3_split_sink_and_scan(spark, sf_dir):
    """Both splits written as one dataset partitioned by ``split``; each split read
    back by partition pruning (S2 checks the target column)."""
    path = IO.write_splits(_split_tx(spark, sf_dir), scratch_path(spark, "splits"))
    parts = [IO.read_split(spark, path, "Class", split=part).select("event_id", "Time", "Amount", "Class", F.lit(part).alias("split")) for part in ("train", "test")]
    return parts[0].unionByName(parts[1])


@register("s4_report_sink", sql=ORACLE["v7_health_report"])
def s4_report_sink(spark, sf_dir):
    rep = QUERIES["v7_health_report"](spark, sf_dir)
    path = IO.write_report(rep, scratch_path(spark, "validation-report"))
    return spark.read.schema(rep.schema).json(path)


BATCH_ENDS = ["2024-01-11 00:00:00", "2024-01-21 00:00:00", "2024-02-01 00:00:00"]  # the events arrive in three parts, by time


def _arriving(df, ts_col="ts"):
    """The three parts of a frame, as they arrive."""
    begin = None
    for end in BATCH_ENDS:
        until = F.col(ts_col) < F.lit(end).cast(df.schema[ts_col].dataType)
        yield df.filter(until if begin is None else until & (F.col(ts_col) >= F.lit(begin).cast(df.schema[ts_col].dataType)))
        begin = end


def _scoring_stream(spark, sf_dir):
    """D2 on events that arrive in three parts: contract split, standardiser and logistic model fitted on the train
    split, decisions at 0.5 appended to a JSON prediction log; every run goes on where the one before stopped."""
    _, params, model = _tx_model(spark, sf_dir)
    ev = S.load(spark, sf_dir, "events")
    first = ev.select(F.min("ts")).first()[0]  # the stream's clock origin
    contract = V.Contract("raw-features", (V.Rule("Time", "double", ge=0.0), V.Rule("Amount", "double", ge=1.0)),
                          strict=False)
    src, log = scratch_path(spark, "arriving-events"), scratch_path(spark, "prediction-log")
    for part in _arriving(ev):
        part.write.mode("append").parquet(src)
        raw = spark.readStream.schema(ev.schema).parquet(src).select(
            "event_id", seconds_between(F.lit(first).cast("timestamp_ntz"), F.col("ts")).alias("Time"), F.col("value").alias("Amount"))
        ST.score_stream(raw, contract, params, model, 0.5, ["Time", "Amount"], "lr-1", log, log + "-ckpt", keys=["event_id"]).awaitTermination()
    return log


@register("d2_streaming_scoring", sql=f"""
WITH RECURSIVE {SQL_TX_MODEL}
SELECT event_id, round(Time, 6) AS Time, Amount, round(1 / (1 + exp(-(b0 + b1 * z1 + b2 * z2))), 6) AS fraud_probability,
       CAST(1 / (1 + exp(-(b0 + b1 * z1 + b2 * z2))) >= 0.5 AS BIGINT) AS is_fraud, 'lr-1' AS model_version
FROM z JOIN tx USING (event_id), fitted WHERE Amount >= 1.0
""")
def d2_streaming_scoring(spark, sf_dir):
    """Every logged record of three micro-batches, field by field but for the timestamp."""
    log = _scoring_stream(spark, sf_dir)
    full = spark.read.schema(IO.prediction_log_schema(["Time", "Amount"], {"event_id": IO.T.LongType()})).json(f"{log}/batch_id=*/is_valid=true")
    return full.select("event_id", F.round("input.Time", 6).alias("Time"), "input.Amount", F.round("fraud_probability", 6).alias("fraud_probability"), "is_fraud", "model_version")


@register("s5_s6_prediction_log_roundtrip", sql=f"WITH {SQL_TX.strip()} SELECT round(Time, 6) AS Time, Amount FROM tx WHERE Amount >= 1.0")
def s5_s6_prediction_log_roundtrip(spark, sf_dir):
    """S6 writes one record per valid scored row (Amount >= 1 is the stream's contract);
    S5 reads the log back with its schema and flattens ``input``."""
    log = _scoring_stream(spark, sf_dir)
    return IO.read_prediction_log(spark, f"{log}/batch_id=*/is_valid=true", ["Time", "Amount"]).select(F.round("Time", 6).alias("Time"), "Amount")


@register("v10_streaming_quarantine", sql=f"WITH {SQL_TX.strip()} SELECT event_id, round(Time, 6) AS Time, Amount, CAST(NULL AS DOUBLE) AS fraud_probability FROM tx WHERE Amount < 1.0")
def v10_streaming_quarantine(spark, sf_dir):
    """The rows that the stream's contract rejects, as they came and without a score."""
    log = _scoring_stream(spark, sf_dir)
    bad = spark.read.schema(IO.prediction_log_schema(["Time", "Amount"], {"event_id": IO.T.LongType()})).json(f"{log}/batch_id=*/is_valid=false")
    return bad.select("event_id", F.round("input.Time", 6).alias("Time"), "input.Amount", "fraud_probability")


@register("d6_streaming_delayed_labels", sql="""
WITH d AS (SELECT ts, floor(CAST(CAST(('0x' || substr(md5(concat_ws('|', '42', 'delay', CAST(event_id AS VARCHAR))), 1, 13))
                                 AS BIGINT) AS DOUBLE) / 4503599627370496.0::DOUBLE * 259200) AS delay FROM events),
m AS (SELECT max(ts) AS mx FROM events)
SELECT count(*) FILTER (WHERE delay <= 172800) AS n_labelled,
       count(*) FILTER (WHERE delay > 172800 AND ts + INTERVAL 3 DAY < mx) AS n_unlabelled
FROM d, m
""")
def d6_streaming_delayed_labels(spark, sf_dir):
    """Predictions (events stream) joined with labels that arrive 0-72 h later (hash-derived
    delay); labels later than 48 h miss the join and surface as unlabelled rows once the
    watermark passes.  Output: matched / unlabelled counts.  A prediction without a label
    surfaces once the watermark (max event time - 1 day) passes its last chance to match
    (prediction time + 2 days): the SQL states that rule directly."""
    ev = ST.event_time(ST.read_table_stream(spark, sf_dir, "events"), "ts")
    pred = ev.select("event_id", F.col("event_time").alias("pred_time"),
                     (F.col("value") / (F.col("value") + F.lit(50.0))).alias("p"))
    ev2 = ST.event_time(ST.read_table_stream(spark, sf_dir, "events"), "ts")
    delay = F.floor(hash_uniform(SEED, F.lit("delay"), F.col("event_id")) * 72 * 3600).cast("long")
    lab = ev2.select(F.col("event_id"), (F.col("event_time") + F.make_dt_interval(secs=delay)).alias("label_time"),
                     (F.col("event_type") == "error").cast("long").alias("y"))
    joined = ST.delayed_label_join(pred, lab, "event_id", "pred_time", "label_time", "2 days", "1 day")
    out = scratch_path(spark, "delayed-labels")
    q = joined.select(F.col("pr.event_id").alias("event_id"), "p", "y").writeStream.format("parquet") \
        .option("path", out).option("checkpointLocation", out + "-ckpt").outputMode("append") \
        .trigger(availableNow=True).start()
    q.awaitTermination()
    res = spark.read.parquet(out)
    return res.agg(F.count_if(F.col("y").isNotNull()).alias("n_labelled"),
                   F.count_if(F.col("y").isNull()).alias("n_unlabelled"))


QUALITY_BUCKETS = 1000


@register("d6_streaming_label_quality", sql="""
WITH d AS (SELECT event_id, ts, date_trunc('day', ts) AS day, CAST(round(value / (value + 50.0) * 1000) AS INTEGER) AS bucket, CAST(event_type = 'error' AS INTEGER) AS y,
                  floor(CAST(CAST(('0x' || substr(md5(concat_ws('|', '42', 'delay', CAST(event_id AS VARCHAR))), 1, 13)) AS BIGINT) AS DOUBLE) / 4503599627370496.0::DOUBLE * 259200) AS delay FROM events),
m AS (SELECT max(ts) AS mx FROM events),
j AS (SELECT *, delay <= 172800 AND ts + to_seconds(CAST(delay AS BIGINT)) <= mx AS labelled, delay > 172800 AND ts + INTERVAL 3 DAY < mx AS given_up FROM d, m),
j2 AS (SELECT *, NOT labelled AND ts + INTERVAL 3 DAY < mx AS unlabelled FROM j),
h AS (SELECT day, bucket, count(*) FILTER (WHERE labelled AND y = 1) AS n_pos, count(*) FILTER (WHERE labelled AND y = 0) AS n_neg FROM j2 GROUP BY ALL),
r AS (SELECT *, sum(n_pos) OVER w AS tps, sum(n_pos + n_neg) OVER w AS seen FROM h WINDOW w AS (PARTITION BY day ORDER BY bucket DESC)),
q AS (SELECT day, coalesce(sum(n_pos) FILTER (WHERE bucket >= 500), 0) AS tp, coalesce(sum(n_neg) FILTER (WHERE bucket >= 500), 0) AS fp,
             coalesce(sum(n_pos) FILTER (WHERE bucket < 500), 0) AS fn, coalesce(sum(n_neg) FILTER (WHERE bucket < 500), 0) AS tn,
             sum(CASE WHEN n_pos > 0 THEN n_pos * (tps / seen) ELSE 0 END) / nullif(sum(n_pos), 0) AS ap FROM r GROUP BY day),
c AS (SELECT day, count(*) AS n_events, count(*) FILTER (WHERE labelled) AS n_labelled, count(*) FILTER (WHERE unlabelled) AS n_unlabelled FROM j2 GROUP BY day)
SELECT day, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tn AS BIGINT) AS tn,
       CASE WHEN n_labelled > 0 THEN round(coalesce(ap, 0.0), 9) END AS pr_auc, n_labelled, n_unlabelled, n_events - n_labelled - n_unlabelled AS n_pending
FROM c JOIN q USING (day)
""")
def d6_streaming_label_quality(spark, sf_dir):
    """Predictions and labels (0-72 h later by hash) arrive in three parts, each at its own time; labels within 48 h join.  Per
    day: confusion counts, PR-AUC, labelled, given up (the watermark has passed the last chance) and pending predictions."""
    ev = ST.event_time(S.load(spark, sf_dir, "events"), "ts")
    last = ev.agg(F.max("event_time")).first()[0]
    delay = F.floor(hash_uniform(SEED, F.lit("delay"), F.col("event_id")) * 72 * 3600).cast("long")
    pred = ev.select("event_id", F.col("event_time").alias("pred_time"), (F.col("value") / (F.col("value") + F.lit(50.0))).alias("p"))
    lab = ev.select("event_id", (F.col("event_time") + F.make_dt_interval(secs=delay)).alias("label_time"), (F.col("event_type") == "error").cast("long").alias("y")).filter(F.col("label_time") <= F.lit(last))
    src, out = scratch_path(spark, "arriving-labels"), scratch_path(spark, "label-quality")
    for p_part, l_part in zip(_arriving(pred, "pred_time"), _arriving(lab, "label_time")):
        p_part.write.mode("append").parquet(f"{src}/p")
        l_part.write.mode("append").parquet(f"{src}/l")
        p, la = (spark.readStream.schema(f.schema).parquet(f"{src}/{n}") for f, n in ((pred, "p"), (lab, "l")))
        joined = ST.delayed_label_join(p, la, "event_id", "pred_time", "label_time", "2 days", "1 day").select(
            instant_to_ntz(F.date_trunc("day", "pred_time")).alias("day"), "p", "y")
        ST.streaming_label_quality(joined, ["day"], QUALITY_BUCKETS, out, out + "-ckpt").awaitTermination()
    seen = D.quality_from_histogram(spark.read.parquet(out), ["day"], QUALITY_BUCKETS)
    total = ev.groupBy(instant_to_ntz(F.date_trunc("day", "event_time")).alias("day")).agg(F.count(F.lit(1)).alias("n_events"))
    counts = ["tp", "fp", "fn", "tn", "n_labelled", "n_unlabelled"]
    both = total.join(seen, "day", "left").fillna(0, counts)
    return both.select("day", *counts[:4], F.round("pr_auc", 9).alias("pr_auc"), *counts[4:], (F.col("n_events") - F.col("n_labelled") - F.col("n_unlabelled")).alias("n_pending"))


def _sql_windowed_drift(columns: dict[str, str]) -> str:
    """PSI per (day, column) against the first week's deciles, and each day's share of drifted columns."""
    edges = ", ".join(f"quantile_cont(x, {i / 10})" for i in range(1, 10))
    long = " UNION ALL ".join(f"SELECT ts, '{c}' AS col, CAST({e} AS DOUBLE) AS x FROM events" for c, e in columns.items())
    return f"""
long AS ({long}),
e AS (SELECT col, [{edges}] AS edges FROM long WHERE ts < TIMESTAMP '{REF_END_TS}' GROUP BY col),
b AS (SELECT ts, col, len(list_filter(edges, lambda v: v < x)) AS bin FROM long JOIN e USING (col)),
rs AS (SELECT col, bin, count(*) / sum(count(*)) OVER (PARTITION BY col) AS r FROM b WHERE ts < TIMESTAMP '{REF_END_TS}' GROUP BY col, bin),
cb AS (SELECT date_trunc('day', ts) AS ws, col, bin, count(*) AS n FROM b GROUP BY ALL),
n AS (SELECT ws, col, sum(n) AS n_rows FROM cb GROUP BY ALL),
g AS (SELECT ws, col, n_rows, t.bin, greatest(coalesce(cb.n, 0) / n_rows, 0.0001) AS c, greatest(coalesce(r, 0.0), 0.0001) AS r
      FROM n CROSS JOIN range(10) t(bin) LEFT JOIN cb USING (ws, col, bin) LEFT JOIN rs USING (col, bin)),
psi AS (SELECT ws, col, sum((c - r) * ln(c / r)) AS psi FROM g GROUP BY ws, col),
days AS (SELECT ws AS window_start, ws + INTERVAL 1 DAY AS window_end, CAST({len(columns)} AS BIGINT) AS n_columns, count(*) FILTER (WHERE psi >= 0.1) AS n_drifted FROM psi GROUP BY ws)
SELECT *, n_drifted / n_columns AS drift_share, n_drifted / n_columns >= 0.5 AS dataset_drift FROM days"""


DRIFT_COLUMNS = {"Amount": "value", "user": "user_id", "hour": "hour(ts)", "spread": "value * (1 + day(ts) // 10)"}  # the last one drifts


def _drift_frame(events):
    return events.select("ts", F.col("value").alias("Amount"), F.col("user_id").alias("user"), F.hour("ts").alias("hour"), (F.col("value") * (1 + F.floor(F.day("ts") / 10))).alias("spread"))


@register("d7_windowed_drift", sql=f"WITH {_sql_windowed_drift(DRIFT_COLUMNS)}")
def d7_windowed_drift(spark, sf_dir):
    """Daily dataset decision over several columns against the first week, from one count of (day, column, bin)."""
    ev = _drift_frame(S.load(spark, sf_dir, "events"))
    profile = D.reference_profile(ev.filter(F.col("ts") < F.lit(REF_END_TS).cast("timestamp_ntz")), list(DRIFT_COLUMNS)).collect()
    return D.windowed_drift(ev, profile, "ts", list(DRIFT_COLUMNS))


@register("d7_streaming_windowed_drift", sql=f"WITH {_sql_windowed_drift(DRIFT_COLUMNS)} WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY")
def d7_streaming_windowed_drift(spark, sf_dir):
    """The same decisions from events that arrive in three parts: a day is decided once the watermark has passed its end."""
    ev = S.load(spark, sf_dir, "events")
    profile = D.reference_profile(_drift_frame(ev.filter(F.col("ts") < F.lit(REF_END_TS).cast("timestamp_ntz"))), list(DRIFT_COLUMNS)).collect()
    src, out = scratch_path(spark, "arriving-days"), scratch_path(spark, "daily-drift")
    for part in _arriving(ev):
        part.write.mode("append").parquet(src)
        stream = _drift_frame(spark.readStream.schema(ev.schema).parquet(src))
        ST.streaming_windowed_drift(stream, "ts", profile, list(DRIFT_COLUMNS), out, out + "-ckpt").awaitTermination()
    return spark.read.parquet(out).drop("batch_id")


# the closed loop: week 1 is the reference, weeks 2 to 4 arrive one after the other, the last two with other amounts
SQL_LOOP = f"""
ev AS (SELECT event_id, CAST(event_type = 'error' AS INTEGER) AS y, wk, CASE WHEN wk >= 2 THEN value * 2 + 1 ELSE value END AS Amount, CAST(hour(ts) AS DOUBLE) AS hour
       FROM (SELECT *, CAST(floor((day(ts) - 1) / 7) AS INTEGER) AS wk FROM events WHERE ts < TIMESTAMP '2024-01-29 00:00:00')),
rk AS (SELECT *, row_number() OVER (PARTITION BY wk, y ORDER BY md5(concat_ws('|', '42', CAST(event_id AS VARCHAR)))) AS rn, count(*) OVER (PARTITION BY wk, y) AS n_c FROM ev),
sp AS (SELECT *, wk > 0 AND rn <= floor(CAST(n_c AS DOUBLE) * 0.2) AS test FROM rk),
mo AS (SELECT wk AS m, avg(Amount) AS m1, stddev_pop(Amount) AS s1, avg(hour) AS m2, stddev_pop(hour) AS s2, count(*) AS n, sum(y) AS n1 FROM sp WHERE NOT test GROUP BY wk),
d AS (SELECT m, y, (Amount - m1) / s1 AS z1, (hour - m2) / s2 AS z2, CASE WHEN y = 1 THEN n / (2 * n1) ELSE n / (2 * (n - n1)) END AS w FROM sp JOIN mo ON wk = m WHERE NOT test),
{_newton_sql().strip()},
ps AS (SELECT m, wk, y, round(1 / (1 + exp(-(b0 + b1 * (Amount - m1) / s1 + b2 * (hour - m2) / s2))), 9) AS p FROM sp, mo JOIN fitted USING (m) WHERE test AND m <= wk),
steps AS (SELECT m, wk, p, sum(y) AS n_pos, count(*) AS n FROM ps GROUP BY ALL),
runs AS (SELECT *, sum(n_pos) OVER o AS tps, sum(n) OVER o AS seen FROM steps WINDOW o AS (PARTITION BY m, wk ORDER BY p DESC)),
ap AS (SELECT m, wk, round(coalesce(sum(n_pos * (tps / seen)) / nullif(sum(n_pos), 0), 0.0), 6) AS ap FROM runs GROUP BY m, wk),
long AS (SELECT wk, 'Amount' AS col, Amount AS x FROM ev UNION ALL SELECT wk, 'hour', hour FROM ev),
e AS (SELECT col, [{", ".join(f"quantile_cont(x, {i / 10})" for i in range(1, 10))}] AS edges FROM long WHERE wk = 0 GROUP BY col),
cb AS (SELECT wk, col, len(list_filter(edges, lambda v: v < x)) AS bin, count(*) AS n FROM long JOIN e USING (col) GROUP BY ALL),
sh AS (SELECT *, n / sum(n) OVER (PARTITION BY wk, col) AS share FROM cb),
psi AS (SELECT w.wk, c.col, sum((greatest(coalesce(a.share, 0), 0.0001) - greatest(coalesce(r.share, 0), 0.0001)) * ln(greatest(coalesce(a.share, 0), 0.0001) / greatest(coalesce(r.share, 0), 0.0001))) AS psi
        FROM range(1, 4) w(wk) CROSS JOIN (SELECT DISTINCT col FROM e) c CROSS JOIN range(10) b(bin)
        LEFT JOIN sh a ON a.wk = w.wk AND a.col = c.col AND a.bin = b.bin LEFT JOIN sh r ON r.wk = 0 AND r.col = c.col AND r.bin = b.bin GROUP BY ALL),
dr AS (SELECT wk, count(*) FILTER (WHERE psi >= 0.1) / 2 AS share FROM psi GROUP BY wk),
l1 AS (SELECT 0 AS inc, dr.share, a.ap AS ia, c.ap AS ca, dr.share >= 0.5 AND c.ap > a.ap AS won FROM dr, ap a, ap c WHERE dr.wk = 1 AND a.wk = 1 AND a.m = 0 AND c.wk = 1 AND c.m = 1),
l2 AS (SELECT CASE WHEN l1.won THEN 1 ELSE l1.inc END AS inc, dr.share, a.ap AS ia, c.ap AS ca, dr.share >= 0.5 AND c.ap > a.ap AS won FROM l1, dr, ap a, ap c WHERE dr.wk = 2 AND a.wk = 2 AND a.m = CASE WHEN l1.won THEN 1 ELSE l1.inc END AND c.wk = 2 AND c.m = 2),
l3 AS (SELECT CASE WHEN l2.won THEN 2 ELSE l2.inc END AS inc, dr.share, a.ap AS ia, c.ap AS ca, dr.share >= 0.5 AND c.ap > a.ap AS won FROM l2, dr, ap a, ap c WHERE dr.wk = 3 AND a.wk = 3 AND a.m = CASE WHEN l2.won THEN 2 ELSE l2.inc END AND c.wk = 3 AND c.m = 3),
rows_of AS (SELECT 0 AS batch_id, * FROM l1 UNION ALL SELECT 1, * FROM l2 UNION ALL SELECT 2, * FROM l3)
SELECT CAST(batch_id AS INTEGER) AS batch_id, CAST(share AS DOUBLE) AS drift_share, CASE WHEN share >= 0.5 THEN ia END AS incumbent_pr_auc, CASE WHEN share >= 0.5 THEN ca END AS candidate_pr_auc, won AS promoted FROM rows_of"""


@register("d9_closed_loop", sql=f"WITH RECURSIVE {SQL_LOOP}")
def d9_closed_loop(spark, sf_dir):
    """Three weeks arrive as three micro-batches: each is checked against the stored profile of the first week; on drift a
    candidate is fitted on the batch and promoted when it beats the incumbent on the batch's test part."""
    ev = S.load(spark, sf_dir, "events").filter(F.col("ts") < F.lit("2024-01-29 00:00:00").cast("timestamp_ntz"))
    week = F.floor((F.day("ts") - 1) / 7).cast("int")
    amount = F.when(week >= 2, F.col("value") * 2 + 1).otherwise(F.col("value"))
    rows = ev.select("event_id", (F.col("event_type") == "error").cast("long").alias("Class"), amount.alias("Amount"), F.hour("ts").cast("double").alias("hour"), week.alias("wk"))
    features = ["Amount", "hour"]
    reference = rows.filter("wk = 0").drop("wk")
    profile = D.reference_profile(reference, features).collect()
    store, src = scratch_path(spark, "model-store"), scratch_path(spark, "arriving-weeks")
    first = M.newton_logistic(reference, features, "Class", scale=features)[0]
    ST.write_model(spark, store, -1, first, None, True)
    for wk in (1, 2, 3):
        rows.filter(F.col("wk") == wk).drop("wk").write.mode("append").parquet(src)
        stream = spark.readStream.schema(reference.schema).parquet(src)
        ST.retraining_loop(stream, profile, features, store, store + "-ckpt").awaitTermination()
    return spark.read.parquet(f"{store}/decisions").select("batch_id", "drift_share", "incumbent_pr_auc", "candidate_pr_auc", "promoted")


# ----------------------------------------------------------------------------
# Extreme imbalance: positives thinned by hash to ~1/256 (about 0.08 %, the reference's
# table has 0.17 %), same rule on both sides.
SQL_TX_RARE = """
tx AS (
  SELECT event_id,
         CAST(date_diff('microsecond', (SELECT min(ts) FROM events), ts) AS DOUBLE) / 1e6 AS Time,
         value AS Amount,
         CAST(CASE WHEN event_type = 'error' AND md5(CAST(event_id AS VARCHAR)) < '01' THEN 1 ELSE 0 END AS BIGINT) AS Class
  FROM events)"""


def _rare_tx(spark, sf_dir):
    return S.thin_positives(S.transaction_table(spark, sf_dir), "event_id", "Class", "01")


@register("p7_imbalance_rare", sql=ORACLE["p7_imbalance_events"].replace(SQL_TX.strip(), SQL_TX_RARE.strip()))
def p7_imbalance_rare(spark, sf_dir):
    return P.imbalance(_rare_tx(spark, sf_dir))


@register("flagship_cost_threshold_rare",
          sql=ORACLE["flagship_cost_threshold"].replace(SQL_TX.strip(), SQL_TX_RARE.strip()))
def flagship_cost_threshold_rare(spark, sf_dir):
    tx = _rare_tx(spark, sf_dir)
    split = T.stratified_split(tx, ["event_id"], "Class", TEST_SIZE, SEED)
    params = T.fit_standardizer(split.filter(F.col("split") == "train"), ["Time", "Amount"])
    test = T.apply_standardizer(split.filter(F.col("split") == "test"), params)
    scored = test.select(F.col("Class").alias("y"), standin_score(F.col("Amount")).alias("p"))
    return E.cost_optimal_threshold(scored, COST_FP, COST_FN, label="y", score="p")


@register("t6_split_summary_rare", sql=ORACLE["t6_split_summary"].replace(SQL_TX.strip(), SQL_TX_RARE.strip()))
def t6_split_summary_rare(spark, sf_dir):
    sp = T.stratified_split(_rare_tx(spark, sf_dir), ["event_id"], "Class", TEST_SIZE, SEED)
    return _r9cols(T.split_summary(sp), ["pos_rate_pct"])


@register("d5_score_drift_by_day", sql=ORACLE["d7_windowed_psi"]
          .replace("quantile_cont(value,", "quantile_cont(value / (value + 50.0),")
          .replace("list_filter(edges, lambda x: x < value)", "list_filter(edges, lambda x: x < value / (value + 50.0))")
          .replace("'Amount' AS \"column\"", "'p' AS \"column\""))
def d5_score_drift_by_day(spark, sf_dir):
    """Prediction drift: PSI per day of a stand-in model's score against its first-week bins."""
    tx = S.transaction_table(spark, sf_dir, keep_ts=True).withColumn(
        "p", F.col("Amount") / (F.col("Amount") + F.lit(50.0)))
    ref = tx.filter(F.col("ts") < F.lit(REF_END_TS).cast("timestamp_ntz"))
    return _r9cols(D.windowed_psi(ref, tx, "ts", "p", "1 day", 10), ["value"])


@register("d8_streaming_drift_alerts", sql=ORACLE["d8_drift_alerts"].replace(
    "FROM p WHERE value > 0.05",
    "FROM p WHERE value > 0.05 AND ws + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY"))
def d8_streaming_drift_alerts(spark, sf_dir):
    """D7 + D8 on the events stream: PSI of each closed daily window against first-week bins,
    alerts above 0.05.  Windows still open at the end of the stream (the watermark has not
    passed them) are, correctly, not reported."""
    ev = S.load(spark, sf_dir, "events")
    ref = ev.filter(F.col("ts") < F.lit(REF_END_TS).cast("timestamp_ntz"))
    edges, shares = D.reference_bin_shares(ref, "value", 10)
    out = scratch_path(spark, "stream-alerts")
    q = ST.streaming_drift_alerts(ST.read_table_stream(spark, sf_dir, "events"), "ts", "value", edges, shares,
                                  ALERT_THRESHOLDS["psi"], out, out + "-ckpt")
    q.awaitTermination()
    res = spark.read.parquet(out).select("window_start", F.lit("Amount").alias("column"), "statistic", "value",
                                         "threshold")
    return _r9cols(res, ["value"])


@register("d3_psi_halves", sql=f"""
WITH {SQL_HALVES.strip()},
e AS (SELECT [quantile_cont(value, 0.1), quantile_cont(value, 0.2), quantile_cont(value, 0.3), quantile_cont(value, 0.4),
              quantile_cont(value, 0.5), quantile_cont(value, 0.6), quantile_cont(value, 0.7), quantile_cont(value, 0.8),
              quantile_cont(value, 0.9)] AS edges FROM ref),
rb AS (SELECT len(list_filter(edges, lambda x: x < value)) AS bin, count(*) AS n FROM ref, e GROUP BY 1),
rs AS (SELECT bin, n / sum(n) OVER () AS ref_share FROM rb),
cb AS (SELECT len(list_filter(edges, lambda x: x < value)) AS bin, count(*) AS n FROM cur, e GROUP BY 1),
tot AS (SELECT sum(n) AS n_cur FROM cb),
f AS (SELECT greatest(coalesce(cb.n, 0) / tot.n_cur, 0.0001) AS c, greatest(coalesce(rs.ref_share, 0.0), 0.0001) AS r, n_cur
      FROM range(10) g(bin) CROSS JOIN tot LEFT JOIN cb ON cb.bin = g.bin LEFT JOIN rs ON rs.bin = g.bin)
SELECT 'Amount' AS "column", CAST(max(n_cur) AS BIGINT) AS n_cur, round(sum((c - r) * ln(c / r)), 9) AS psi FROM f
""")
def d3_psi_halves(spark, sf_dir):
    """Column PSI of Amount, second half of January against the first half's deciles."""
    ref, cur = _halves(spark, sf_dir)
    return _r9cols(D.column_psi(ref, cur, ["Amount"], 10), ["psi"])


# ----------------------------------------------------------------------------
# V9: the gate at three boundaries (two tables that fail, one that passes)
@register("v9_gate_verdicts", sql=f"""
WITH {SQL_TX},
ev AS ({ORACLE["v6_contract_summary_events"]}),
cu AS ({ORACLE["v6_contract_summary_customer"]})
SELECT 'events' AS boundary, "column", "check", n_failed, 'rejected' AS verdict FROM ev WHERE n_failed > 0
UNION ALL SELECT 'customer', "column", "check", n_failed, 'rejected' FROM cu WHERE n_failed > 0
UNION ALL SELECT 'transactions', NULL, NULL, CAST(0 AS BIGINT), 'passed' FROM tx
          HAVING count(*) FILTER (WHERE Time IS NULL OR Amount IS NULL OR Time < 0 OR Amount < 0 OR Class NOT IN (0, 1)) = 0
""")
def v9_gate_verdicts(spark, sf_dir):
    from raresight.errors import ContractViolation

    boundaries = [("events", S.load(spark, sf_dir, "events"), EVENTS_CONTRACT), ("customer", S.load(spark, sf_dir, "customer"), CUSTOMER_CONTRACT),
                  ("transactions", S.transaction_table(spark, sf_dir).drop("event_id"), V.raw_transaction_contract(features=()))]
    out = None
    for name, df, contract in boundaries:
        try:
            V.enforce(df, contract, name)
            rows = spark.createDataFrame([(None, None, 0)], "column string, check string, n_failed bigint").withColumn("verdict", F.lit("passed"))
        except ContractViolation:
            rows = V.contract_summary(df, contract).filter("n_failed > 0").withColumn("verdict", F.lit("rejected"))
        rows = rows.select(F.lit(name).alias("boundary"), "column", "check", "n_failed", "verdict")
        out = rows if out is None else out.unionByName(rows)
    return out


# M6: the training frame of each strategy: rows and weights by class
@register("m6_strategy_frames", sql=f"""
WITH {SQL_FEAT_SPLIT},
c AS (SELECT Class, count(*) AS n FROM ftrain GROUP BY Class),
t AS (SELECT sum(n) AS n, count(*) AS k, max(n) FILTER (WHERE Class = 1) AS p, max(n) FILTER (WHERE Class = 0) AS q FROM c)
SELECT 'logistic_regression' AS model, 'none' AS resampling, Class, c.n AS n_rows, round(t.n / (t.k * c.n), 9) AS weight FROM c, t
UNION ALL SELECT 'xgboost', 'none', Class, c.n, round(CASE WHEN Class = 1 THEN t.q / t.p ELSE 1.0 END, 9) FROM c, t
UNION ALL SELECT 'logistic_regression', 'smote', Class, greatest(c.n, t.q), CAST(NULL AS DOUBLE) FROM c, t
""")
def m6_strategy_frames(spark, sf_dir):
    train, _ = _feature_split(spark, sf_dir)
    out = None
    for params in (LR_PARAMS, GBT_PARAMS, dict(LR_PARAMS, resampling="smote")):
        frame, weight = M.training_frame(train, params, S.E_COLUMNS, "Class", "vec_id")
        value = F.max(weight) if weight else F.lit(None).cast("double")  # one weight per class
        rows = frame.groupBy("Class").agg(F.count(F.lit(1)).alias("n_rows"), F.round(value, 9).alias("weight")).select(
            F.lit(params["model"]).alias("model"), F.lit(params["resampling"]).alias("resampling"), "Class", "n_rows", "weight")
        out = rows if out is None else out.unionByName(rows)
    return out


# D10 over features: both modes of the injection
def _unit_sql(feature: str, part: int) -> str:
    return (f"(CAST(CAST(('0x' || substr(md5(concat_ws('|', '0', '{feature}:{part}', CAST(vec_id AS VARCHAR))), 1, 13)) AS BIGINT) AS DOUBLE)"
            " / 4503599627370496.0::DOUBLE)")


@register("d10_feature_shift", sql=f"""
WITH feat AS ({FEAT_SQL})
SELECT vec_id, {", ".join(f"{v} * 2.0::DOUBLE + 3.0::DOUBLE AS {v}" for v in S.E_COLUMNS)}, Class FROM feat
""")
def d10_feature_shift(spark, sf_dir):
    return D.inject_drift(S.feature_table(spark, sf_dir), ["vec_id"], S.E_COLUMNS, None, None, seed=0)


@register("d10_feature_resample", sql=f"""
WITH feat AS ({FEAT_SQL})
SELECT vec_id, {", ".join(f"round(3.0 + 2.0 * (sqrt(-2.0 * ln(1.0 - {_unit_sql(v, 1)})) * cos(2 * pi() * {_unit_sql(v, 2)})), 6) AS {v}" for v in S.E_COLUMNS)}, Class
FROM feat
""")
def d10_feature_resample(spark, sf_dir):
    out = D.inject_drift(S.feature_table(spark, sf_dir), ["vec_id"], S.E_COLUMNS, None, None, seed=0, mode="resample")
    return out.select("vec_id", *[F.round(v, 6).alias(v) for v in S.E_COLUMNS], "Class")
