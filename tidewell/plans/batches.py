"""Batches with commit markers: write the data, then the markers; the marker is the truth.

All batches that are not committed are written by one job, and one aggregate gives their hashes and
rows, so the number of Spark jobs does not depend on the number of batches.  The markers of batches that
are committed together are one document, as a file each would take longer than the data.  A batch without a
marker never happened, whatever files it left; its folder is overwritten when it is tried again.  The checkpoint
of a load is the upper bound of the last batch of an unbroken row of markers.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from enum import StrEnum
from itertools import pairwise
from typing import Any
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.identity import batch_id, content_hashes
from tidewell.operators.gold import fact_batches
from tidewell.operators.quality import ContractError
from tidewell.plans.retry import Retry
from tidewell.plans.store import Store

#: Batches of one load at most: their bounds and markers pass through the driver, about a kilobyte each.
MOST_BATCHES = 200_000


@dataclass(frozen=True)
class Batch:
    number: int
    low: Any
    high: Any
    batch_id: str


class Action(StrEnum):
    WRITE = "WRITE"
    SKIP = "SKIP"


def plan_batches(df: DataFrame, table: str, key: str, size: int, snapshot: str, after: Any = None) -> list[Batch]:
    """Batches of size rows in key order; rows of one key stay together, so a batch whose last key repeats has more.
    Only the bounds reach the driver; a size that makes more than MOST_BATCHES of them raises."""
    rows = df if after is None else df.where(F.col(key) > F.lit(after))
    found = fact_batches(rows, size, key).orderBy("batch_number").limit(MOST_BATCHES + 1).collect()
    if len(found) > MOST_BATCHES:
        raise ContractError(f"{table}: batches of {size} rows are more than {MOST_BATCHES}; ask for larger ones")
    bounds = [after, *(r["upper_bound"] for r in found)]
    return [Batch(n, low, high, batch_id(table, key, low, high, snapshot)) for n, (low, high) in enumerate(pairwise(bounds), 1)]


def inside(key: str, batches: list[Batch]) -> Column:
    """Whether a key is in one of the batches; batches side by side make one range."""
    ranges: list[list[Any]] = []
    for b in batches:
        if ranges and ranges[-1][1] == b.low:
            ranges[-1][1] = b.high
        else:
            ranges.append([b.low, b.high])
    found = F.lit(False)
    for low, high in ranges:
        upper = F.col(key) <= F.lit(high)
        found = found | (upper if low is None else (F.col(key) > F.lit(low)) & upper)
    return found


def place_of(key: Column, batches: list[Batch]) -> Column:
    """The place in the list of the batch that a key inside of them is in: the first whose upper bound is not below
    it.  A binary search over the bounds, so a key's cost grows with the logarithm of their number."""
    last = len(batches) - 1
    bounds = F.array(*[F.lit(b.high) for b in batches])
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(last.bit_length()))]).cast("array<int>")

    def step(at: Column, width: Column) -> Column:
        return F.when((at + width <= last) & (F.get(bounds, at + width - 1) < key), at + width).otherwise(at)

    return F.aggregate(steps, F.lit(0), step)


def id_at(place: Column, batches: list[Batch]) -> Column:
    """The id of the batch at a place in the list."""
    return F.get(F.split(F.lit(" ".join(b.batch_id for b in batches)), " "), place)


def batch_of(key: Column, batches: list[Batch]) -> Column:
    """The id of the batch that a key inside of them is in."""
    return id_at(place_of(key, batches), batches)


#: The end of the name of a document that holds the markers of several batches.
_MANY = ".batches.json"


def _marker(batch: Batch, digest: str, rows: int) -> dict:
    return {"number": batch.number, "low": batch.low, "high": batch.high, "batch_id": batch.batch_id, "content_hash": digest, "rows": rows}


def _held(marker: dict | None, batch: str, digest: str) -> Action:
    if marker is None:
        return Action.WRITE
    if marker["content_hash"] != digest:
        raise ContractError(f"batch {batch} is committed with other content")
    return Action.SKIP


class BatchLog:
    """Markers of the batches of one load: a document for each commit, of one marker or of a list."""

    def __init__(self, store: Store, load: str):
        self.store, self.folder = store, f"control/batches/{load}"

    def _name(self, batch: str) -> str:
        return f"{self.folder}/{batch}.json"

    def _markers(self, ending: str) -> list[dict]:
        found = [self.store.get(f"{self.folder}/{n}") for n in self.store.names(self.folder) if n.endswith(ending)]
        return [m for document in found for m in (document if isinstance(document, list) else [document])]

    def committed(self) -> list[dict]:
        """Markers by batch number."""
        return sorted(self._markers(".json"), key=lambda m: m["number"])

    def resolve(self, batch: str, digest: str) -> Action:
        """SKIP what is committed with the same content; other content under the same id is a conflict."""
        marker = self.store.get(self._name(batch)) or next((m for m in self._markers(_MANY) if m["batch_id"] == batch), None)
        return _held(marker, batch, digest)

    def commit(self, batch: Batch, digest: str, rows: int) -> None:
        self.store.put(self._name(batch.batch_id), _marker(batch, digest, rows))

    def commit_all(self, found: list[tuple[Batch, str, int]]) -> None:
        """Commits batches, with their hashes and rows, at once: readers see all of them or none."""
        if found:
            self.store.put(f"{self.folder}/{found[0][0].batch_id}{_MANY}", [_marker(*x) for x in found])

    def checkpoint(self, start: Any = None) -> Any:
        """The last bound up to which everything after start is committed; start if nothing is."""
        last = start
        for expected, marker in enumerate(self.committed(), 1):
            if marker["number"] != expected or marker["low"] != last:
                break
            last = marker["high"]
        return last


def write_batches(
    df: DataFrame, key: str, batches: list[Batch], log: BatchLog, folder: str, build: Callable[[DataFrame], DataFrame] = lambda x: x, retry: Retry = Retry(), before: Callable[[Batch], None] | None = None
) -> int:
    """Writes what is not committed yet, and holds what is against the rows as they are now; returns the
    rows of all committed batches.  before: called ahead of each commit; if it raises, the batches ahead are committed."""
    spark, marks = df.sparkSession, {m["batch_id"]: m for m in log.committed()}
    closed, fresh = [b for b in batches if b.batch_id in marks], [b for b in batches if b.batch_id not in marks]

    def of(some: list[Batch]) -> DataFrame:
        return build(df.where(inside(key, some))).withColumn("_batch", place_of(F.col(key), some))

    def named(rows: DataFrame, some: list[Batch]) -> DataFrame:
        return rows.withColumn("batch_id", id_at(F.col("_batch"), some)).drop("_batch")

    if closed:
        now = content_hashes(named(of(closed), closed), "batch_id")
        for batch in closed:
            _held(marks[batch.batch_id], batch.batch_id, now.get(batch.batch_id, ("no rows", 0))[0])
    if fresh:
        rows = named(of(fresh).repartition("_batch"), fresh)  # a task writes whole batches, and no sampling runs the plan once more

        def step() -> dict[Any, tuple[str, int]]:
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(log.store.path(folder))
            written = spark.read.schema(rows.schema).parquet(log.store.path(folder))
            return content_hashes(written.where(F.col("batch_id").isin([b.batch_id for b in fresh])), "batch_id")

        found, ready = retry.run(step), []
        try:
            for batch in fresh:
                if before:
                    before(batch)
                ready.append((batch, *found[batch.batch_id]))
        finally:
            log.commit_all(ready)
    return sum(m["rows"] for m in log.committed())


def read_committed(log: BatchLog, folder: str) -> DataFrame:
    """The rows of committed batches only."""
    paths = [log.store.path(f"{folder}/batch_id={m['batch_id']}") for m in log.committed()]
    if not paths:
        raise ContractError(f"{folder}: no committed batch")
    return log.store.spark.read.parquet(*paths)
