"""Queries that read a stream."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.plans import queries as q
from tidewell.sources.adapter import SalesTables
from tidewell.sources.settled import discard, shared_folder
from tidewell.streaming import distinct, incremental

#: Deliveries of the events, days each, and days that the stream waits for late rows.
DELIVERIES, DAYS, WAIT = 4, 8, 2


def deliveries(t: SalesTables) -> DataFrame:
    """The events with the number of the delivery that brings them: most with their days; every fifth id comes
    twice with one delivery, every seventh again with the next, and every eleventh only with the next."""
    events = t.table("events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")
    first = events.agg(F.min(F.unix_micros("ts")).alias("first")).first()["first"] or 0
    day = F.floor((F.unix_micros("ts") - first) / (DAYS * 86_400_000_000))
    own = F.least(F.lit(DELIVERIES - 1), day).cast("int")
    late, again = F.col("event_id") % 11 == 0, F.col("event_id") % 7 == 0
    times = F.array_compact(F.array(F.when(~late, own), F.when(~late & (F.col("event_id") % 5 == 0), own), F.when(late | again, own + 1)))
    return events.withColumn("delivery", F.explode(times))


@q.query(
    "events_stream_dedup",
    f"""WITH e AS (SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, user_id, event_type, value, least({DELIVERIES - 1}, CAST((epoch_us(CAST(ts AS TIMESTAMP)) - (SELECT min(epoch_us(CAST(ts AS TIMESTAMP))) FROM events)) // {DAYS * 86_400_000_000} AS INT)) AS own FROM events),
    d AS (SELECT *, own AS delivery FROM e WHERE event_id % 11 <> 0 UNION ALL SELECT *, own + 1 FROM e WHERE event_id % 11 = 0 OR event_id % 7 = 0),
    seen AS (SELECT delivery + 1 AS delivery, max(epoch_ms(ts)) - {WAIT * 86_400_000} AS mark FROM d GROUP BY 1),
    marks AS (SELECT x.delivery, max(y.mark) AS mark FROM seen x JOIN seen y ON y.delivery <= x.delivery GROUP BY 1)
    SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, value, CAST(min(delivery) AS BIGINT) AS delivery FROM d LEFT JOIN marks USING (delivery)
    WHERE mark IS NULL OR epoch_us(ts) > mark * 1000 GROUP BY ALL""",
)
def events_stream_dedup(t):
    """The deliveries arrive one after the other, and the stream is started anew for each."""
    root = f"{shared_folder(t.spark)}/tidewell-events-{uuid.uuid4().hex}"
    atexit.register(discard, t.spark, root)
    rows = deliveries(t)
    rows.write.partitionBy("delivery").parquet(f"{root}/all")
    written = t.spark.read.parquet(f"{root}/all")
    for k in range(DELIVERIES + 1):
        written.where(F.col("delivery") == k).select(rows.columns).write.mode("append").parquet(f"{root}/inbox")
        stream = incremental.read_stream(t.spark, f"{root}/inbox", rows.schema, files_per_batch=1_000_000)
        distinct.load_new(distinct.distinct_events(stream, delay=f"{WAIT} days"), f"{root}/table", f"{root}/checkpoint")
    return t.spark.read.parquet(f"{root}/table").select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"), "user_id", "event_type", "value", "delivery")
