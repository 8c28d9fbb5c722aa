"""Ranks over a whole table without a window in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.sources.settled import settle


def global_ranks(df: DataFrame, order: list[Column], name: str, weight: str | None = None) -> tuple[DataFrame, int]:
    """df with the place of each row in the order, from 0, and the number of rows; with a weight, the weights of the
    rows before it, and of all.  Rows are dealt by range of the order and ranked in their range; the ranges are
    written once, as two reads of them must agree, and their sums (one a range) are added up on the driver.  The
    order should name each row: rows equal by it stay in one range."""
    one = F.col(weight) if weight else F.lit(1).cast("long")
    dealt = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    before = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = settle(dealt.withColumn("_before", F.coalesce(F.sum(one).over(before), F.lit(0).cast("long"))), "ranks")
    sums = {r["_range"]: r["n"] for r in placed.groupBy("_range").agg(F.sum(one).alias("n")).collect()}
    offsets, whole = [], 0
    for k in sorted(sums):
        offsets.append((k, whole))
        whole += sums[k]
    starts = F.broadcast(df.sparkSession.createDataFrame(offsets, "_range int, _offset long"))
    return placed.join(starts, "_range").withColumn(name, F.col("_offset") + F.col("_before")).drop("_range", "_before", "_offset"), whole


def tile(rank: Column, rows: int, tiles: int) -> Column:
    """The tile of a rank by the rule of ntile: sizes differ by one at most, and larger tiles come first."""
    size, larger = divmod(rows, tiles)
    inside = F.floor(rank / (size + 1))
    after = larger + F.floor((rank - larger * (size + 1)) / max(size, 1))
    return (F.when(rank < larger * (size + 1), inside).otherwise(after) + 1).cast("long")
