"""Events once each, from deliveries that repeat some and bring some late.

The stream keeps the ids it has seen in a state store until the watermark passes them, so state is bounded
by what arrives within the delay, not by the table.  Rows at or before the watermark are late and are
left out; their number stands in the query's progress.  Files read and state are in the checkpoint and the
table has a log of its batches, so a run that breaks off or starts again reads and writes nothing twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def distinct_events(stream: DataFrame, key: str = "event_id", at: str = "ts", delay: str = "2 days") -> DataFrame:
    """The first row of each key, if its time is past the watermark; copies may differ in time by the delay."""
    timed = stream.withColumn(at, F.col(at).cast("timestamp"))  # watermarks need a time zone
    return timed.withWatermark(at, delay).dropDuplicatesWithinWatermark([key])


def load_new(events: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Appends what is there and not yet read to a table of files, and ends."""
    query = events.writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def counts(query: StreamingQuery) -> dict[str, int]:
    """Rows that a run read, and those of them that were late or repeated."""
    found = {"read": 0, "late": 0, "repeated": 0}
    for progress in query.recentProgress:
        found["read"] += progress["numInputRows"]
        for state in progress["stateOperators"]:
            found["late"] += state["numRowsDroppedByWatermark"]
            found["repeated"] += state["customMetrics"].get("numDroppedDuplicateRows", 0)
    return found
