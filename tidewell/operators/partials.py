"""Aggregates in parts that merge: decimal sums, and exact distinct counts as bitmaps.

A part holds a row for each range of 32,768 ids that it has seen, with a bitmap of these ids.  Parts of
batches, days or buckets merge by OR and addition, so an increment costs what it brings.  Lines are
summed per order before anything else is shuffled by value, and one aggregate counts all the distinct
columns: no row is repeated for each of them, as with several count(DISTINCT).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def partials(lines: DataFrame, sums: dict[str, Column], distinct: tuple[str, ...] = (), order: str = "sales_order_id", part: Column | None = None) -> DataFrame:
    """part, column, range, ids (bitmap), rows, orders and the sums.  Orders must not cross parts, so that
    their numbers add up; distinct: columns of whole numbers.  NULLs are no ids."""
    part = F.lit(0).cast("long") if part is None else part
    seen = {f"_{c}": F.collect_set(c) for c in distinct}
    orders = lines.groupBy(part.alias("part"), F.col(order).alias("_order")).agg(F.count("*").alias("rows"), *[F.sum(c).alias(n) for n, c in sums.items()], *[c.alias(n) for n, c in seen.items()])

    def tagged(column: str) -> Column:
        return F.transform(F.col(f"_{column}"), lambda v: F.struct(F.lit(column).alias("column"), v.cast("long").alias("id")))

    ids = [tagged(c) for c in distinct]
    listed = F.concat(*ids) if ids else F.array().cast("array<struct<column:string,id:long>>")
    each = orders.select("part", "_order", "rows", *sums, F.posexplode_outer(listed).alias("_place", "_id"))
    first = F.coalesce(F.col("_place"), F.lit(0)) == 0  # an order's sums count once, whatever ids it has
    number = F.col("_id.id")
    return each.groupBy("part", F.col("_id.column").alias("column"), F.bitmap_bucket_number(number).alias("range")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("ids"), F.sum(F.when(first, F.col("rows"))).alias("rows"), F.count_if(first & F.col("_order").isNotNull()).alias("orders"),
        *[F.sum(F.when(first, F.col(n))).alias(n) for n in sums],
    )


def partials_of_heads(lines: DataFrame, sums: dict[str, Column], distinct: tuple[str, ...], head: Column, order: str = "sales_order_id", part: Column | None = None) -> DataFrame:
    """The same for lines of which one of each order is marked (head), so nothing is shuffled per order: a row of
    sums a part, and rows of ids.  The lines, which should be a table, are read once for the sums and once for the ids."""
    part = F.lit(0).cast("long") if part is None else part
    whole = lines.groupBy(part.alias("part")).agg(F.count("*").alias("rows"), F.count_if(head & F.col(order).isNotNull()).alias("orders"), *[F.sum(c).alias(n) for n, c in sums.items()])
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("long").alias("id")) for c in distinct]))
    seen = lines.select(part.alias("part"), each.alias("_id")).where("_id.id is not null")
    number = F.col("_id.id")
    ids = seen.groupBy("part", F.col("_id.column").alias("column"), F.bitmap_bucket_number(number).alias("range")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("ids"))
    return ids.unionByName(whole, allowMissingColumns=True)


def total(parts: DataFrame, sums: tuple[str, ...], distinct: tuple[str, ...] = ()) -> DataFrame:
    """rows, orders, the sums (NULL without rows), and the number of distinct ids of each column; one row."""
    merged = parts.groupBy("column", "range").agg(F.bitmap_or_agg("ids").alias("ids"), *[F.sum(c).alias(c) for c in ("rows", "orders", *sums)])
    none = F.lit(0).cast("long")
    return merged.agg(
        F.coalesce(F.sum("rows"), none).alias("rows"), F.coalesce(F.sum("orders"), none).alias("orders"), *[F.sum(n).alias(n) for n in sums],
        *[F.coalesce(F.sum(F.when(F.col("column") == c, F.bitmap_count("ids"))), none).alias(c) for c in distinct],
    )
