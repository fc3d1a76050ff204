"""Sources and sinks: declared-schema CSV (fail fast or count bad rows), split scan checks."""

import pytest
from pyspark.sql import types as T

from raresight.errors import IngestError
from raresight.session import scratch_path
from raresight.sources import files as IO

SCHEMA = T.StructType([T.StructField("Time", T.DoubleType()), T.StructField("Class", T.LongType())])


def _csv(spark, lines):
    path = scratch_path(spark, "csv")
    spark.createDataFrame([(ln,) for ln in lines], "value string").coalesce(1).write.text(path)
    return path


def test_csv_failfast_and_permissive(spark):
    path = _csv(spark, ["Time,Class", "1.0,0", "oops,1", "2.5,1"])
    with pytest.raises(IngestError, match="oops"):
        IO.read_csv(spark, path, SCHEMA)
    df = IO.read_csv(spark, path, SCHEMA, failfast=False)
    rows = df.collect()
    assert len(rows) == 3 and sum(r["_corrupt_record"] is not None for r in rows) == 1


def test_split_scan_checks_target_and_prunes(spark):
    df = spark.createDataFrame([(1.0, 0, "train"), (2.0, 1, "test")], "Time double, Class long, split string")
    path = IO.write_splits(df, scratch_path(spark, "splits"))
    assert IO.read_split(spark, path, "Class", split="test").count() == 1
    with pytest.raises(IngestError):
        IO.read_split(spark, path, "Label")
    with pytest.raises(IngestError):
        IO.read_split(spark, scratch_path(spark, "missing"), "Class")


def test_scale_conf_sizes_for_100_tb():
    from raresight.session import scale_conf
    c = scale_conf(100 * 2 ** 40, total_cores=8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 100 * 2 ** 40 // (256 << 20)  # 409,600 x 256 MB
    assert int(c["spark.sql.files.maxPartitionBytes"]) == 256 << 20
    small = scale_conf(10 << 20, total_cores=8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16  # never fewer than 2 per core
