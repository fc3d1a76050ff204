"""Structured Streaming forms of the scoring and monitoring operators.

* D2 ``score_stream``: validate (V10) -> scale + score (D1) -> prediction log (S6),
  quarantined rows to their own sink; append mode, checkpointed.
* D7 ``windowed_bin_counts``: per (tumbling window, reference bin) counts with a
  watermark, so the state is bin counts of open windows — never rows.
* D6 ``delayed_label_join``: stream-stream left outer join of predictions with labels
  arriving up to ``max_delay`` later; unlabelled predictions surface once the
  watermark passes.
* D9 ``closed_loop``: ``foreachBatch`` running the batch drift check on each
  micro-batch and calling back (alert, retrain) when drift is found.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from raresight.functions import instant_to_ntz, ntz_to_instant
from raresight.operators import contracts as V
from raresight.operators import monitor as D
from raresight.operators import evaluate as E
from raresight.operators import prepare as T
from raresight.operators import train as M
from raresight.plans import LogisticFit, newton_logistic
from raresight.session import stored
from raresight.sources.files import to_prediction_log


def read_table_stream(spark: SparkSession, sf_dir: str, name: str, max_files: int | None = None) -> DataFrame:
    """A given parquet table as a file stream (schema taken from the table, never inferred per file)."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(sf_dir)


def score_stream(raw: DataFrame, contract: V.Contract, scaler_params, model, threshold: float,
                 feature_cols: list[str], model_version: str, log_path: str,
                 checkpoint: str, trigger: dict | None = None, keys: list[str] = ()):
    """D2: one streaming query; each micro-batch validates and scores its rows in one pass and writes them as JSON lines,
    partitioned by validity: ``is_valid=true`` is the prediction log (with ``keys``), ``is_valid=false`` the quarantine, whose
    rows carry no score.  Returns the started query."""
    params = scaler_params.collect() if isinstance(scaler_params, DataFrame) else scaler_params
    flagged = V.with_validity(raw, contract)

    def sink(batch: DataFrame, batch_id: int) -> None:
        # idempotent per micro-batch: a batch re-run after a failure overwrites its own
        # directory instead of appending twice (exactly-once output with the checkpoint)
        # and the batch is computed once: one write, partitioned by validity
        held = {f"_raw_{c}": F.col(c) for c in feature_cols}  # the log holds the input as it came, not as it was scaled
        scored = M.raw_to_decision(batch.withColumns(held), params, model, threshold).withColumns({c: F.col(f"_raw_{c}") for c in feature_cols})
        log = to_prediction_log(scored, feature_cols, model_version, keep=["is_valid", *keys])
        log.write.mode("overwrite").partitionBy("is_valid").json(f"{log_path}/batch_id={batch_id}")

    w = flagged.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


def event_time(stream: DataFrame, ts_col: str, out: str = "event_time") -> DataFrame:
    """Watermarks need TIMESTAMP; a TIMESTAMP_NTZ column is read as UTC wall clock."""
    if dict(stream.dtypes)[ts_col] == "timestamp_ntz":
        return stream.withColumn(out, ntz_to_instant(ts_col))
    return stream.withColumn(out, F.col(ts_col))


def windowed_bin_counts(stream: DataFrame, ts_col: str, value_col: str, edges: list[float],
                        window: str = "1 day", watermark: str = "1 day") -> DataFrame:
    """D7 streaming: (window_start, window_end, bin, n) per tumbling window, finalised by the
    watermark.  ``edges`` are the reference bin edges (a fixed, small list)."""
    arr = F.array(*[F.lit(float(e)) for e in edges])
    x = F.col(value_col).cast("double")
    s = event_time(stream, ts_col).withWatermark("event_time", watermark).filter(x.isNotNull())
    agg = s.groupBy(F.window("event_time", window).alias("w"), D.bin_index(x, arr, len(edges)).alias("bin")) \
        .agg(F.count(F.lit(1)).alias("n"))
    return agg.select(instant_to_ntz("w.start").alias("window_start"), instant_to_ntz("w.end").alias("window_end"),
                      "bin", "n")


def streaming_drift_alerts(stream: DataFrame, ts_col: str, value_col: str, edges: list[float],
                           ref_shares: list[float], threshold: float, out_path: str, checkpoint: str,
                           window: str = "1 day", watermark: str = "1 day", trigger: dict | None = None):
    """D7 + D8 streaming: watermarked (window, bin) counts; each micro-batch holds the windows
    the watermark has just closed, so PSI per window is final there, and windows above the
    threshold are written as alerts (idempotently, one directory per batch)."""
    counts = windowed_bin_counts(stream, ts_col, value_col, edges, window, watermark)
    spark = stream.sparkSession
    shares = spark.createDataFrame([(b, float(v)) for b, v in enumerate(ref_shares)], "bin int, ref_share double")

    def sink(batch: DataFrame, batch_id: int) -> None:
        c = batch.select(F.struct(F.col("window_start").alias("start"), F.col("window_end").alias("end")).alias("w"),
                         "bin", "n")
        psi = D.psi_from_counts(c, shares, len(edges) + 1, value_col)
        D.drift_alerts(psi, {"psi": threshold}).write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    w = counts.writeStream.foreachBatch(sink).outputMode("append").option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def delayed_label_join(predictions: DataFrame, labels: DataFrame, key: str, pred_ts: str, label_ts: str,
                       max_delay: str = "2 days", watermark: str = "1 day") -> DataFrame:
    """D6 streaming: left outer stream-stream join; a label counts when it arrives within
    ``max_delay`` after the prediction.  Both sides carry watermarks so state is bounded."""
    p = predictions.withWatermark(pred_ts, watermark).alias("pr")
    lab = labels.withWatermark(label_ts, watermark).alias("lb")  # both event times must be TIMESTAMP
    cond = (F.col(f"pr.{key}") == F.col(f"lb.{key}")) & \
        (F.col(f"lb.{label_ts}") >= F.col(f"pr.{pred_ts}")) & \
        (F.col(f"lb.{label_ts}") <= F.col(f"pr.{pred_ts}") + F.expr(f"INTERVAL {max_delay}"))
    return p.join(lab, cond, "leftOuter")


def closed_loop(stream: DataFrame, reference: DataFrame, num_cols, cat_cols, on_drift: Callable,
                checkpoint: str, share: float = D.DRIFT_SHARE, trigger: dict | None = None):
    """D9: per micro-batch, the dataset-drift decision against the reference; when it is
    true, ``on_drift(batch_df, batch_id, report_row)`` runs (alert, then retrain)."""
    def check(batch: DataFrame, batch_id: int) -> None:
        row = D.detect_drift(reference, batch, num_cols, cat_cols, share).first()
        if row is not None and row["dataset_drift"]:
            on_drift(batch, batch_id, row)

    w = stream.writeStream.foreachBatch(check).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def streaming_windowed_drift(stream: DataFrame, ts_col: str, profile: list, cols: list[str], out_path: str, checkpoint: str, window: str = "1 day",
                             watermark: str = "1 day", threshold: float = D.PSI_THRESHOLD, share: float = D.DRIFT_SHARE, trigger: dict | None = None):
    """D7 over many columns: the state is (window, column, bin) counts; each micro-batch writes the decisions of the
    windows that the watermark has just closed (one directory per batch, so a re-run replaces it)."""
    timed = event_time(stream, ts_col).withWatermark("event_time", watermark).withColumn("_w", F.window("event_time", window))
    counts = D.binned(D.df_long(timed, cols, ["_w"]), profile).groupBy("_w", "column", "bin").agg(F.count(F.lit(1)).alias("n"))

    def sink(batch: DataFrame, batch_id: int) -> None:
        out = D.drift_share_by(D.psi_by_column(batch, profile, ["_w"], threshold), len(cols), ["_w"], share)
        out.select(instant_to_ntz("_w.start").alias("window_start"), instant_to_ntz("_w.end").alias("window_end"),
                   "n_columns", "n_drifted", "drift_share", "dataset_drift").write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    w = counts.writeStream.foreachBatch(sink).outputMode("append").option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def streaming_label_quality(joined: DataFrame, by: list[str], buckets: int, out_path: str, checkpoint: str, trigger: dict | None = None):
    """D6: each micro-batch of the delayed-label join adds its score histogram (``by``..., bucket, counts); the histograms
    merge by addition, so quality at any time is ``quality_from_histogram`` of what has been written."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        D.score_histogram(batch, by, buckets).write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    w = joined.writeStream.foreachBatch(sink).outputMode("append").option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


MODEL_ROW = "features array<string>, intercept double, coefficients array<double>, mean array<double>, std array<double>, pr_auc double, promoted boolean"
DECISION_ROW = "drift_share double, incumbent_pr_auc double, candidate_pr_auc double, promoted boolean"


def write_model(spark: SparkSession, store: str, batch_id: int, model: LogisticFit, pr_auc: float | None, promoted: bool) -> None:
    """A version of the model table; written again, it replaces itself."""
    row = (model.features, model.intercept, model.coefficients, model.mean, model.std, pr_auc, promoted)
    spark.createDataFrame([row], MODEL_ROW).write.mode("overwrite").parquet(f"{store}/models/batch_id={batch_id}")


def incumbent_before(spark: SparkSession, store: str, batch_id: int) -> LogisticFit:
    """The last promoted version before a batch: what a re-run of the batch finds as well."""
    r = spark.read.schema("batch_id int, " + MODEL_ROW).option("basePath", f"{store}/models").parquet(f"{store}/models") \
        .filter((F.col("batch_id") < batch_id) & F.col("promoted")).orderBy(F.desc("batch_id")).limit(1).first()
    return LogisticFit(list(r["features"]), r["intercept"], list(r["coefficients"]), list(r["mean"]), list(r["std"]))


def retraining_loop(stream: DataFrame, profile: list, features: list[str], store: str, checkpoint: str, label: str = "Class", key: str = "event_id", cols: list[str] | None = None,
                    test_size: float = 0.2, seed: int = 42, share: float = D.DRIFT_SHARE, digits: int = 6, trigger: dict | None = None):
    """D9 whole: drift check -> retrain -> compare -> promote, for every micro-batch.

    The check compares the batch's bin counts with the stored ``profile``; the reference itself is not read.  On drift a
    candidate is fitted on the batch's training part, and candidate and incumbent (the last promoted version in
    ``store``/models, version -1 being the caller's first) are scored on its test part; the candidate is promoted on strictly
    greater PR-AUC (to ``digits`` places).  Decisions (``store``/decisions) and versions have a directory per batch: a re-run
    replaces its own and reads earlier ones only."""
    spark, monitored = stream.sparkSession, cols or features

    def step(batch: DataFrame, batch_id: int) -> None:
        rows = stored(batch, "loop-batch")  # read by the check, the split, the fit's steps and both scores
        counts = D.binned(D.df_long(rows, monitored), profile).groupBy("column", "bin").agg(F.count(F.lit(1)).alias("n"))
        found = D.drift_share_by(D.psi_by_column(counts, profile), len(monitored), (), share).first()
        drift = found["drift_share"] or 0.0
        scores: dict[str, float | None] = {"incumbent": None, "candidate": None}
        promoted = False
        if found["dataset_drift"]:
            split = stored(T.stratified_split(rows, [key], label, test_size, seed), "loop-split")
            candidate = newton_logistic(split.filter("split = 'train'"), features, label, scale=features)[0]
            incumbent = incumbent_before(spark, store, batch_id)
            test = split.filter("split = 'test'")
            models = F.array(F.struct(F.lit("incumbent").alias("model_id"), F.round(incumbent.probability(), 9).alias("p")), F.struct(F.lit("candidate").alias("model_id"), F.round(candidate.probability(), 9).alias("p")))
            both = test.select(F.col(label).alias("y"), F.explode(models).alias("m")).select("y", "m.*")
            scores |= {r["model_id"]: round(r["pr_auc"], digits) for r in E.average_precision(both, by=["model_id"]).collect()}
            promoted = scores["candidate"] > scores["incumbent"]
            write_model(spark, store, batch_id, candidate, scores["candidate"], promoted)
        spark.createDataFrame([(float(drift), scores["incumbent"], scores["candidate"], promoted)], DECISION_ROW).write.mode("overwrite").parquet(f"{store}/decisions/batch_id={batch_id}")

    w = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()
