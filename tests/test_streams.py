"""The stream of distinct events: restarts, late rows, repeated rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.streaming import distinct, incremental

SCHEMA = "event_id long, ts timestamp, value double"


def deliver(spark, root, rows):
    spark.createDataFrame(rows, "event_id long, ts string, value double").withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(f"{root}/inbox")


def run(spark, root, delay="1 hour"):
    schema = spark.createDataFrame([], SCHEMA).schema
    stream = incremental.read_stream(spark, f"{root}/inbox", schema, files_per_batch=100)
    query = distinct.load_new(distinct.distinct_events(stream, delay=delay), f"{root}/table", f"{root}/checkpoint")
    rows = sorted((r["event_id"], r["value"]) for r in spark.read.parquet(f"{root}/table").collect())
    return rows, distinct.counts(query)


def test_restarts_read_nothing_twice(spark, tmp_path):
    root = f"file://{tmp_path}"
    deliver(spark, root, [(1, "2024-01-01 10:00:00", 1.0), (2, "2024-01-01 10:10:00", 2.0), (2, "2024-01-01 10:10:00", 2.0)])
    rows, seen = run(spark, root)
    assert rows == [(1, 1.0), (2, 2.0)] and seen == {"read": 3, "late": 0, "repeated": 1}
    assert run(spark, root) == (rows, {"read": 0, "late": 0, "repeated": 0})  # nothing new
    # a repeated row of the run before, a new one, and one behind the watermark (09:10)
    deliver(spark, root, [(2, "2024-01-01 10:10:00", 9.0), (3, "2024-01-01 12:00:00", 3.0), (4, "2024-01-01 09:05:00", 4.0)])
    rows, seen = run(spark, root)
    assert rows == [(1, 1.0), (2, 2.0), (3, 3.0)] and seen == {"read": 3, "late": 1, "repeated": 1}
    # late, but not too late
    deliver(spark, root, [(5, "2024-01-01 11:30:00", 5.0), (1, "2024-01-01 10:00:00", 1.0)])
    rows, seen = run(spark, root)
    assert rows == [(1, 1.0), (2, 2.0), (3, 3.0), (5, 5.0)] and seen["late"] == 1


def test_a_broken_run_is_taken_up(spark, tmp_path):
    """Files of a batch that was not committed are no part of the table, and its rows come once."""
    root = f"file://{tmp_path}"
    deliver(spark, root, [(k, "2024-01-01 10:00:00", float(k)) for k in range(20)])
    run(spark, root)
    deliver(spark, root, [(k, "2024-01-01 10:30:00", float(k)) for k in range(10, 40)])
    schema = spark.createDataFrame([], SCHEMA).schema
    failing = F.when(F.col("event_id") == 39, F.raise_error(F.lit("lost")).cast("double")).otherwise(F.col("value"))
    stream = incremental.read_stream(spark, f"{root}/inbox", schema).withColumn("value", failing)
    try:
        distinct.load_new(distinct.distinct_events(stream), f"{root}/table", f"{root}/checkpoint")
        raise AssertionError("it should have failed")
    except Exception as error:
        assert "lost" in str(error)
    assert len(spark.read.parquet(f"{root}/table").collect()) == 20
    rows, _ = run(spark, root)
    assert rows == [(k, float(k)) for k in range(40)]
