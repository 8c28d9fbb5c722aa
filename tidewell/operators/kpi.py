"""KPIs, their comparison with a baseline, and the dashboard's queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions.columns import ratio
from tidewell.operators.partials import partials, partials_of_heads, total

KPIS = ("total_revenue", "total_orders", "total_line_items", "total_units", "avg_order_value", "avg_item_price", "total_discount", "discount_rate", "total_customers")
TOLERANCE = 0.02


def _gross() -> Column:
    return F.col("unit_price").cast("decimal(14,4)") * F.col("order_qty").cast("decimal(5,0)")


_SUMS = ("revenue", "units", "gross", "discount")


def kpi_partials(rows: DataFrame, revenue: Column | None = None, discount: Column | None = None, part: Column | None = None, head: Column | None = None) -> DataFrame:
    """What the nine KPIs need of some lines, in parts that merge; sums are decimals until the end.  head: true
    for one line of each order, where that is known."""
    sums = {"revenue": F.col("net_sales") if revenue is None else revenue, "units": F.col("order_qty"), "gross": _gross(), "discount": F.col("discount_amount") if discount is None else discount}
    return partials(rows, sums, ("customer_id",), part=part) if head is None else partials_of_heads(rows, sums, ("customer_id",), head, part=part)


def kpis_of(parts: DataFrame) -> DataFrame:
    """The nine KPIs of all parts together."""
    c, none = F.col, F.lit(0)
    whole = total(parts, _SUMS, ("customer_id",)).withColumns({n: F.coalesce(c(n), none) for n in _SUMS})
    return whole.select(
        c("revenue").cast("double").alias("total_revenue"), c("orders").alias("total_orders"), c("rows").alias("total_line_items"), c("units").cast("bigint").alias("total_units"),
        ratio(c("revenue"), c("orders")).alias("avg_order_value"), ratio(c("gross"), c("units")).alias("avg_item_price"), c("discount").cast("double").alias("total_discount"),
        ratio(c("discount"), c("gross")).alias("discount_rate"), c("customer_id").alias("total_customers"),
    )


def kpi_gold(fact: DataFrame) -> DataFrame:
    return kpis_of(kpi_partials(fact))


def kpi_baseline(details: DataFrame, headers: DataFrame) -> DataFrame:
    """The same KPIs from Silver; the discount is not rounded per line."""
    rows = details.join(headers.select("sales_order_id", "customer_id"), "sales_order_id")
    return kpis_of(kpi_partials(rows, F.col("line_total"), _gross() - F.col("line_total")))


def relative_variance(actual: Column, expected: Column) -> Column:
    """|actual - expected| / |expected|; for an expected 0: 0 if equal, else 1."""
    return F.when(expected == 0, F.when(actual == 0, 0.0).otherwise(1.0)).otherwise(F.abs(actual - expected) / F.abs(expected))


def kpi_variance(actual: DataFrame, expected: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """A row a KPI: actual, expected, variance, and whether it is within the tolerance (inclusive)."""

    def long(df: DataFrame, name: str) -> DataFrame:
        pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("kpi"), F.col(k).cast("double").alias(name)) for k in KPIS]))
        return df.select(pairs.alias("p")).select("p.*")

    both = long(actual, "actual").join(long(expected, "expected"), "kpi")
    return both.withColumn("variance", relative_variance(F.col("actual"), F.col("expected"))).withColumn("passed", F.col("variance") <= tolerance)


def _whole(column: Column, places: int = 2) -> Column:
    return F.round(column, places).cast("double")


def dashboard_totals(fact: DataFrame, assigned_only: bool = False) -> DataFrame:
    """avg_line_value is per line, unlike the KPI avg_order_value."""
    rows = fact.where("salesperson_id is not null") if assigned_only else fact
    sums = {"revenue": F.col("net_sales"), "discount": F.col("discount_amount"), "units": F.col("order_qty")}
    whole = total(partials(rows, sums, ("customer_id",)), tuple(sums), ("customer_id",))
    return whole.select(
        F.col("rows").alias("line_items"), "orders", F.col("customer_id").alias("customers"), _whole(F.col("revenue")).alias("revenue"), _whole(F.col("discount")).alias("discount"), "units",
        F.round(ratio(F.col("revenue"), F.col("rows")), 2).alias("avg_line_value"),
    )


def top_salespersons(fact: DataFrame, people: DataFrame, n: int = 10) -> DataFrame:
    named = fact.join(people.select(F.col("salesperson_id").cast("bigint").alias("salesperson_id"), "salesperson_name"), "salesperson_id")
    out = named.groupBy("salesperson_id", "salesperson_name").agg(F.count_distinct("sales_order_id").alias("orders"), _whole(F.sum("net_sales")).alias("revenue"), F.round(ratio(F.sum("net_sales"), F.count("*")), 2).alias("avg_line_value"))
    return out.orderBy(F.desc("revenue"), "salesperson_id").limit(n)


def revenue_by_period(fact: DataFrame, dates: DataFrame, *parts: str) -> DataFrame:
    days = dates.select(F.col("date_id").alias("order_date_id"), *parts)
    return fact.join(days, "order_date_id").groupBy(*parts).agg(F.sum("net_sales").cast("double").alias("revenue"), F.count_distinct("sales_order_id").alias("orders"))


def revenue_by_territory(fact: DataFrame, territories: DataFrame) -> DataFrame:
    """Revenue and line items are summed per territory before the names are joined."""
    sums = fact.groupBy("territory_id").agg(F.sum("net_sales").alias("revenue"), F.count("*").alias("line_items"))
    return sums.join(territories, "territory_id").select("territory_id", "territory_name", F.col("revenue").cast("double").alias("revenue"), "line_items")


def orders_by_territory(fact: DataFrame, territories: DataFrame) -> DataFrame:
    counts = fact.groupBy("territory_id").agg(F.count_distinct("sales_order_id").alias("orders"))
    return counts.join(territories, "territory_id").select("territory_id", "territory_name", "orders")


def top_products(fact: DataFrame, products: DataFrame, n: int = 10) -> DataFrame:
    sums = fact.groupBy("product_id").agg(F.sum("net_sales").alias("total"), F.sum("order_qty").alias("quantity"))
    best = sums.orderBy(F.desc("total"), "product_id").limit(n)
    return best.join(products, "product_id").select("product_id", "product_name", F.col("total").cast("double").alias("revenue"), "quantity")


def revenue_by_salesperson(fact: DataFrame, people: DataFrame) -> DataFrame:
    sums = fact.groupBy("salesperson_id").agg(F.sum("net_sales").alias("revenue"))
    return sums.join(people, "salesperson_id").select("salesperson_id", "salesperson_name", F.col("revenue").cast("double").alias("revenue"))


def top_customers(fact: DataFrame, customers: DataFrame, n: int = 20) -> DataFrame:
    sums = fact.groupBy("customer_id").agg(F.count_distinct("sales_order_id").alias("orders"), F.sum("net_sales").alias("total"), F.count("*").alias("lines"))
    best = sums.orderBy(F.desc("total"), "customer_id").limit(n)
    return best.join(customers, "customer_id").select("customer_id", "customer_name", "orders", F.col("total").cast("double").alias("revenue"), F.round(ratio(F.col("total"), F.col("lines")), 2).alias("avg_line_value"))


def bi_validation(fact: DataFrame) -> DataFrame:
    sums, people = {"revenue": F.col("net_sales"), "units": F.col("order_qty"), "gross": _gross(), "discount": F.col("discount_amount")}, ("customer_id", "salesperson_id")
    whole = total(partials(fact, sums, people), tuple(sums), people)
    return whole.select(
        _whole(F.col("revenue")).alias("revenue"), "orders", F.col("rows").alias("line_items"), "units", F.round(ratio(F.col("revenue"), F.col("orders")), 2).alias("avg_order_value"),
        F.round(ratio(F.col("gross"), F.col("units")), 2).alias("avg_item_price"), _whole(F.col("discount")).alias("discount"), F.col("customer_id").alias("customers"), F.col("salesperson_id").alias("salespeople"),
    )


def sliced_revenue(fact: DataFrame, low: int, high: int, territories: list[int], products: DataFrame) -> DataFrame:
    """The dashboard's slicers: dates between, territories in a list, products in a table."""
    rows = fact.where(F.col("order_date_id").between(low, high) & F.col("territory_id").isin(territories)).join(products.select("product_id"), "product_id", "left_semi")
    return rows.groupBy("territory_id").agg(F.sum("net_sales").cast("double").alias("revenue"), F.count("*").alias("line_items"))


def revenue_growth(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Extension: revenue of each year and its growth over the year before."""
    years = revenue_by_period(fact, dates, "year").select("year", "revenue")
    before = F.lag("revenue").over(Window.orderBy("year"))
    return years.select("year", "revenue", F.when(before.isNotNull(), F.round((F.col("revenue") - before) / before, 6)).alias("growth"))


def rfm(fact: DataFrame, as_of: int, exact: bool = False) -> DataFrame:
    """Extension: recency (days), frequency (orders) and money of every customer; exact: money as the decimal it is."""
    sums = fact.groupBy("customer_id").agg(F.max("order_date_id").alias("last"), F.count_distinct("sales_order_id").alias("frequency"), F.sum("net_sales").alias("money"))
    day = lambda c: F.to_date(c.cast("string"), "yyyyMMdd")
    return sums.select("customer_id", F.datediff(day(F.lit(as_of)), day(F.col("last"))).cast("bigint").alias("recency"), "frequency", F.col("money") if exact else F.col("money").cast("double").alias("money"))
