"""File sources and sinks: CSV scan (S1), split parquet scan/sink (S2, S3),
report sink (S4), prediction-log scan/sink (S5, S6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from raresight.errors import IngestError


def read_csv(spark: SparkSession, path: str, schema: T.StructType, failfast: bool = True) -> DataFrame:
    """Header CSV with a declared schema (never inferred), read by column name: the file's columns may come in
    any order.  A missing or unexpected column raises.

    ``failfast`` raises ``IngestError`` for a malformed row, after one parsing pass that stops at the first;
    otherwise malformed rows are kept with a ``_corrupt_record`` column for counting.
    """
    try:  # the header alone; a missing path is reported here
        header = spark.read.option("header", True).csv(path).columns
    except Exception as exc:
        raise IngestError(f"cannot read CSV at {path}: {exc}") from exc
    declared = {f.name: f for f in schema.fields}
    if sorted(header) != sorted(declared):
        missing, extra = [c for c in declared if c not in header], [c for c in header if c not in declared]
        raise IngestError(f"CSV at {path} does not have the declared columns: missing {missing}, unexpected {extra}")
    in_file = [declared[c] for c in header]
    # every part file must have the same header: a different one fails the job instead of being read by position
    reader = spark.read.option("header", True).option("enforceSchema", False)
    corrupt = T.StructField("_corrupt_record", T.StringType())
    kept = (reader.schema(T.StructType([*in_file, corrupt])).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record").csv(path).select(*declared, "_corrupt_record"))
    if not failfast:
        return kept
    try:
        bad = kept.filter("_corrupt_record is not null").take(1)
    except Exception as exc:  # a part file with another header
        raise IngestError(f"cannot parse CSV at {path}: {exc}") from exc
    if bad:
        raise IngestError(f"malformed row in CSV at {path}: {bad[0]['_corrupt_record']!r}")
    return reader.schema(T.StructType(in_file)).option("mode", "FAILFAST").csv(path).select(*declared)


def read_split(spark: SparkSession, path: str, target: str = "Class", split: str | None = None) -> DataFrame:
    """Read a processed split; a missing path or a missing target column raises."""
    try:
        df = spark.read.parquet(path)
    except Exception as exc:
        raise IngestError(f"cannot read split at {path}: {exc}") from exc
    if target not in df.columns:
        raise IngestError(f"split at {path} has no target column {target!r}")
    if split is not None:
        if "split" not in df.columns:
            raise IngestError(f"{path} is not partitioned by split")
        df = df.filter(F.col("split") == split)  # partition pruning on the directory
    return df


def write_splits(df: DataFrame, path: str, split_col: str = "split") -> str:
    """Write both splits as one parquet dataset partitioned by ``split``."""
    df.write.mode("overwrite").partitionBy(split_col).parquet(path)
    return path


def write_report(report: DataFrame, path: str) -> str:
    """A (one-row) report frame as JSON; coalesce(1) is safe because reports are tiny."""
    report.coalesce(1).write.mode("overwrite").json(path)
    return path


PREDICTION_LOG_FIELDS = ["timestamp", "input", "fraud_probability", "is_fraud", "model_version"]


def prediction_log_schema(feature_cols: list[str], keys: dict[str, T.DataType] | None = None) -> T.StructType:
    return T.StructType([
        T.StructField("timestamp", T.StringType()),
        T.StructField("input", T.StructType([T.StructField(c, T.DoubleType()) for c in feature_cols])),
        T.StructField("fraud_probability", T.DoubleType()),
        T.StructField("is_fraud", T.LongType()),
        T.StructField("model_version", T.StringType()),
        *[T.StructField(k, t) for k, t in (keys or {}).items()],
    ])


def to_prediction_log(scored: DataFrame, feature_cols: list[str], model_version: str,
                      prob_col: str = "fraud_probability", decision_col: str = "is_fraud", keep: list[str] = ()) -> DataFrame:
    """Shape scored rows as log records: UTC timestamp, nested ``input``, score, decision, version (and ``keep``).  Rows whose
    ``is_valid`` is among the kept columns and false get neither score nor decision."""
    scores = F.col("is_valid") if "is_valid" in keep else F.lit(True)
    tz = scored.sparkSession.conf.get("spark.sql.session.timeZone")
    utc_wall = F.to_utc_timestamp(F.current_timestamp(), tz)  # rendered in the session zone = UTC clock
    return scored.select(
        F.concat(F.date_format(utc_wall, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00")).alias("timestamp"),
        F.struct(*[F.col(c).cast("double").alias(c) for c in feature_cols]).alias("input"),
        F.when(scores, F.col(prob_col).cast("double")).alias("fraud_probability"),
        F.when(scores, F.col(decision_col).cast("long")).alias("is_fraud"),
        F.lit(model_version).alias("model_version"), *keep,
    )


def write_prediction_log(log: DataFrame, path: str, checkpoint: str | None = None):
    """Append log records as JSON lines; a streaming frame gets a checkpointed append query."""
    if log.isStreaming:
        return (log.writeStream.format("json").option("path", path)
                .option("checkpointLocation", checkpoint).outputMode("append"))
    log.write.mode("append").json(path)
    return path


def read_prediction_log(spark: SparkSession, path: str, feature_cols: list[str], streaming: bool = False) -> DataFrame:
    """Read the JSONL log with its declared schema and flatten ``input`` to columns."""
    schema = prediction_log_schema(feature_cols)
    reader = spark.readStream if streaming else spark.read
    return reader.schema(schema).json(path).select("input.*")
