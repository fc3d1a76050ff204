"""Streaming forms agree with batch: windowed counts, delayed-label join, closed loop."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF01
from raresight.session import scratch_path
from raresight.streaming import jobs as ST


def _run(df, spark, name):
    out = scratch_path(spark, name)
    q = df.writeStream.format("parquet").option("path", out).option("checkpointLocation", out + "-ckpt") \
        .outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(out)


def test_streamed_bin_counts_equal_batch_for_closed_windows(spark):
    edges = [10.0, 50.0, 100.0]
    res = _run(ST.windowed_bin_counts(ST.read_table_stream(spark, SF01, "events"), "ts", "value", edges),
               spark, "bins")
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    last = ev.agg(F.max("ts")).first()[0] - dt.timedelta(days=1)
    b = sum((F.when(F.lit(e) < F.col("value"), 1).otherwise(0) for e in edges), F.lit(0))
    batch = ev.groupBy(F.date_trunc("day", "ts").alias("window_start"), b.alias("bin")).count() \
        .filter(F.col("window_start") + F.expr("INTERVAL 1 DAY") <= F.lit(last))
    got = {(r["window_start"], r["bin"]): r["n"] for r in res.collect()}
    want = {(r["window_start"], r["bin"]): r["count"] for r in batch.collect()}
    assert got == want and len(got) > 0


def test_delayed_labels_late_ones_surface_unlabelled(spark):
    base = dt.datetime(2024, 1, 1)
    preds = [(i, base + dt.timedelta(days=i), 0.5) for i in range(10)]
    labels = [(i, base + dt.timedelta(days=i + (1 if i % 2 == 0 else 3)), i % 2) for i in range(10)]
    pdir, ldir = scratch_path(spark, "preds"), scratch_path(spark, "labels")
    spark.createDataFrame(preds, "k long, pred_time timestamp, p double").write.parquet(pdir)
    spark.createDataFrame(labels, "k long, label_time timestamp, y long").write.parquet(ldir)
    p = spark.readStream.schema("k long, pred_time timestamp, p double").parquet(pdir)
    lab = spark.readStream.schema("k long, label_time timestamp, y long").parquet(ldir)
    j = ST.delayed_label_join(p, lab, "k", "pred_time", "label_time", "2 days", "1 day")
    res = _run(j.select(F.col("pr.k").alias("k"), "y"), spark, "joined").collect()
    matched = {r["k"] for r in res if r["y"] is not None}
    late = {r["k"] for r in res if r["y"] is None}
    assert matched == {0, 2, 4, 6, 8}          # labels within 2 days join
    assert late and late <= {1, 3, 5, 7, 9}     # labels 3 days late never join; they surface once expired


def test_closed_loop_fires_on_drift_only(spark):
    ref = spark.createDataFrame([(float(i % 100),) for i in range(2000)], "x double")
    src_same, src_drift = scratch_path(spark, "same"), scratch_path(spark, "drift")
    ref.write.parquet(src_same)
    ref.select((F.col("x") * 3 + 500).alias("x")).write.parquet(src_drift)
    fired = []
    for src, expect in [(src_same, False), (src_drift, True)]:
        fired.clear()
        q = ST.closed_loop(spark.readStream.schema("x double").parquet(src), ref, ["x"], [],
                           lambda b, i, r: fired.append(r["drift_share"]), src + "-ckpt")
        q.awaitTermination()
        assert bool(fired) is expect


def test_prediction_log_round_trip_batch_and_stream(spark):
    from raresight.sources import files as IO
    scored = spark.createDataFrame([(1.0, 2.0, 0.9, 1), (3.0, 4.0, 0.1, 0)],
                                   "Time double, Amount double, fraud_probability double, is_fraud long")
    path = scratch_path(spark, "log")
    IO.write_prediction_log(IO.to_prediction_log(scored, ["Time", "Amount"], "v1"), path)
    batch = IO.read_prediction_log(spark, path, ["Time", "Amount"])
    assert sorted(tuple(r) for r in batch.collect()) == [(1.0, 2.0), (3.0, 4.0)]
    streamed = _run(IO.read_prediction_log(spark, path, ["Time", "Amount"], streaming=True), spark, "log-stream")
    assert sorted(tuple(r) for r in streamed.collect()) == [(1.0, 2.0), (3.0, 4.0)]
    assert all(r["timestamp"].endswith("+00:00") and r["model_version"] == "v1" for r in spark.read.json(path).collect())


def _forget_last_commit(checkpoint):
    """As if the driver died after a batch's output and before its commit."""
    import os

    commits = "/" + checkpoint.removeprefix("file:").lstrip("/") + "/commits"
    last = max(int(n) for n in os.listdir(commits) if n.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        if os.path.exists(f"{commits}/{name}"):
            os.remove(f"{commits}/{name}")
    return last


def test_scoring_log_replayed_batch_replaces_itself(spark):
    from raresight.operators import contracts as V
    from raresight.plans import LogisticFit
    from raresight.sources import files as IO

    schema = "event_id long, Time double, Amount double"
    src, log = scratch_path(spark, "in"), scratch_path(spark, "log")
    model = LogisticFit(["Time", "Amount"], 0.1, [0.5, -0.25], [0.0, 0.0], [1.0, 1.0])
    contract = V.Contract("raw", (V.Rule("Time", "double", ge=0.0), V.Rule("Amount", "double", ge=1.0)), strict=False)
    params = [{"column": "Time", "mean": 1.0, "std": 2.0}]

    def run():
        ST.score_stream(spark.readStream.schema(schema).parquet(src), contract, params, model, 0.5, ["Time", "Amount"], "v1", log, log + "-ckpt", keys=["event_id"]).awaitTermination()

    def logged(valid):
        fields = IO.prediction_log_schema(["Time", "Amount"], {"event_id": IO.T.LongType()})
        rows = spark.read.schema(fields).json(f"{log}/batch_id=*/is_valid={valid}").collect()
        return sorted((r.event_id, r.input.Time, r.input.Amount, r.fraud_probability, r.is_fraud, r.model_version) for r in rows)

    for b in range(3):
        spark.createDataFrame([(10 * b + i, float(i), float(i)) for i in range(4)], schema).write.mode("append").parquet(src)
        run()
    whole = logged("true"), logged("false")
    assert [r[0] for r in whole[0]] == [1, 2, 3, 11, 12, 13, 21, 22, 23] and [r[:4] for r in whole[1]] == [(10 * b, 0.0, 0.0, None) for b in range(3)]
    p = 1 / (1 + 2.718281828459045 ** -(0.1 + 0.5 * (3.0 - 1.0) / 2.0 - 0.25 * 3.0))
    assert abs(whole[0][2][3] - p) < 1e-12 and whole[0][2][1:3] == (3.0, 3.0)  # the input as it came
    assert _forget_last_commit(log + "-ckpt") == 2
    run()
    assert (logged("true"), logged("false")) == whole


def test_retraining_loop_replay_and_promotion(spark):
    """A replayed batch decides as it did: it reads versions before it only, and replaces its own."""
    import random

    from raresight.operators import monitor as D
    from raresight.plans import newton_logistic

    rnd = random.Random(1)

    def week(start, slope, shift):
        rows = []
        for i in range(400):
            x = rnd.gauss(shift, 1)
            rows.append((start + i, x, rnd.gauss(0, 1), int(rnd.random() < 1 / (1 + 2.72 ** -(slope * (x - shift))))))
        return spark.createDataFrame(rows, "event_id long, a double, b double, Class long")

    reference = week(0, 2.0, 0.0)
    profile = D.reference_profile(reference, ["a", "b"]).collect()
    store, src = scratch_path(spark, "store"), scratch_path(spark, "weeks")
    ST.write_model(spark, store, -1, newton_logistic(reference, ["a", "b"], scale=["a", "b"])[0], None, True)

    def run():
        ST.retraining_loop(spark.readStream.schema(reference.schema).parquet(src), profile, ["a", "b"], store, store + "-ckpt").awaitTermination()

    def decisions():
        return sorted(tuple(r) for r in spark.read.parquet(f"{store}/decisions").select("batch_id", "drift_share", "incumbent_pr_auc", "candidate_pr_auc", "promoted").collect())

    for w in (week(1000, 2.0, 0.0), week(2000, -2.0, 3.0), week(3000, -2.0, 3.0)):
        w.write.mode("append").parquet(src)
        run()
    first = decisions()
    assert first[0][1] < 0.5 and first[0][2:] == (None, None, False)  # no drift: nothing is fitted
    assert first[1][1] >= 0.5 and first[1][4] and first[1][3] > first[1][2]  # the other way round: the candidate wins
    assert first[2][2] is not None and abs(first[2][2] - first[2][3]) < 0.1  # now it is the incumbent
    assert _forget_last_commit(store + "-ckpt") == 2
    run()
    assert decisions() == first
