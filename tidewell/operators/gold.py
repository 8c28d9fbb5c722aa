"""The star schema: five dimensions and the line-item fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions.columns import MONEY, date_key
from tidewell.operators.quality import ContractError, first_per_key
from tidewell.operators.ranks import global_ranks

#: The dimensions' columns, before any is renamed, and the fact's measures.
CUSTOMER = ("customer_id", "customer_name", "customer_type", "customer_name_source", "person_id", "store_id", "territory_id", "account_number")
PRODUCT = ("product_id", "product_name", "product_number", "product_line", "class", "style", "list_price", "standard_cost", "is_discontinued")
TERRITORY = ("territory_id", "territory_name", "country_region_code", "territory_group")
SALESPERSON = ("salesperson_id", "territory_id", "salesperson_name", "sales_quota", "bonus", "commission_pct", "name_source")
MEASURES = ("order_qty", "unit_price", "discount_amount", "line_total", "net_sales")


def dim_date(headers: DataFrame) -> DataFrame:
    """One row a day from the first to the last order date; a single aggregate bounds the calendar."""
    ends = headers.agg(F.min("order_date").cast("date").alias("low"), F.max("order_date").cast("date").alias("high"))
    guarded = ends.select(F.when(F.col("low").isNull(), F.raise_error(F.lit("no valid order date"))).otherwise(F.sequence("low", "high")).alias("days"))
    days = guarded.select(F.explode("days").alias("full_date"))
    return days.select(
        date_key(F.col("full_date")).alias("date_id"), "full_date", F.year("full_date").cast("bigint").alias("year"), F.quarter("full_date").cast("bigint").alias("quarter"),
        F.month("full_date").cast("bigint").alias("month"), F.date_format("full_date", "MMMM").alias("month_name"), F.dayofmonth("full_date").cast("bigint").alias("day"),
        (F.weekday("full_date") >= 5).alias("is_weekend"),
    )


def dim_customer(customers: DataFrame) -> DataFrame:
    return first_per_key(customers.select(*CUSTOMER), "customer_id")


def dim_product(products: DataFrame) -> DataFrame:
    return first_per_key(products.select(*PRODUCT), "product_id").withColumnsRenamed({"class": "product_class", "style": "product_style"})


def dim_territory(territories: DataFrame) -> DataFrame:
    return first_per_key(territories.select(*TERRITORY), "territory_id")


def dim_salesperson(salespeople: DataFrame) -> DataFrame:
    return first_per_key(salespeople.select(*SALESPERSON), "salesperson_id")


def fact_sales(details: DataFrame, headers: DataFrame) -> DataFrame:
    """One row a detail line; a line without its header raises when the row is read."""
    known = headers.select("sales_order_id", F.col("order_date").cast("date").alias("order_date"), "customer_id", "territory_id", "salesperson_id", F.lit(True).alias("_known"))
    lines = details.join(known, "sales_order_id", "left")
    unmatched = F.concat(F.lit("detail without header: order "), F.coalesce(F.col("sales_order_id").cast("string"), F.lit("NULL")))
    order_id = F.when(F.col("_known").isNull(), F.raise_error(unmatched).cast("bigint")).otherwise(F.col("sales_order_id"))
    gross = F.col("order_qty").cast("decimal(5,0)") * F.col("unit_price").cast("decimal(14,4)")
    return lines.select(
        "sales_order_detail_id", order_id.alias("sales_order_id"), date_key(F.col("order_date")).alias("order_date_id"), "customer_id", "product_id", "territory_id", "salesperson_id",
        F.col("order_qty").cast("bigint").alias("order_qty"), F.col("unit_price").cast(MONEY).alias("unit_price"),
        F.round(gross - F.col("line_total").cast(MONEY), 4).cast(MONEY).alias("discount_amount"), F.col("line_total").cast(MONEY).alias("line_total"), F.col("line_total").cast(MONEY).alias("net_sales"),
    )


def require_unique(df: DataFrame, key: str, what: str) -> None:
    """Raises if a key repeats: the many-to-one guard before a fact is built."""
    if df.groupBy(key).count().where("count > 1").limit(1).count():
        raise ContractError(f"{what}: {key} is not unique")


def fact_batches(details: DataFrame, batch_size: int, key: str = "sales_order_detail_id") -> DataFrame:
    """Batches in key order: number, exclusive lower and inclusive upper bound, rows.  A batch has batch_size
    rows, and more where its last key repeats, as a key's rows stay together; rows without a key are in none.
    Ranks are prefix sums over ranges of the key, so no task sorts the whole table; only the batches, one row
    each, are numbered in one task."""
    keys = details.select(F.col(key).alias("k")).where("k is not null")
    ranked, _ = global_ranks(keys.groupBy("k").agg(F.count("*").alias("_rows")), [F.asc("k")], "_place", weight="_rows")
    out = ranked.groupBy(F.expr(f"cast(_place div {batch_size} as bigint)").alias("b")).agg(F.max("k").alias("upper_bound"), F.sum("_rows").alias("rows"))
    in_order = Window.orderBy("b")
    return out.select(F.row_number().over(in_order).cast("bigint").alias("batch_number"), F.lag("upper_bound").over(in_order).alias("lower_bound"), "upper_bound", "rows")
