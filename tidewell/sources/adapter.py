"""The sales domain over the warehouse tables: headers, details, customers, people, products,
territories and salespeople, as DataFrames and as the same relations in SQL.

Money is built from whole cents, so that no rounded double becomes a decimal.  A detail's id is its
order's id times 10,000 plus its rank within the order: unique, and ranked per order, not globally.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewell.functions.columns import MONEY, money


class SalesTables:
    """Silver-like frames of one folder of tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def header(self) -> DataFrame:
        seller = self.table("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_suppkey").alias("seller"))
        homes = self.table("customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").cast("bigint").alias("territory_id"))
        orders = self.table("orders").join(seller, "o_orderkey", "left").join(homes, "o_custkey", "left")
        return orders.select(
            F.col("o_orderkey").alias("sales_order_id"), F.col("o_orderdate").cast("date").alias("order_date"), F.col("o_custkey").alias("customer_id"),
            F.when(F.col("o_orderstatus") != "P", F.col("seller")).alias("salesperson_id"), "territory_id",
            money(F.round(F.col("o_totalprice") * 100).cast("bigint") * 100).alias("total_due"), F.col("o_orderstatus").alias("status_code"),
        )

    def detail(self) -> DataFrame:
        """Lines are ranked by the column that later joins and filters name, so they are shuffled once, before anything is derived."""
        place = Window.partitionBy("sales_order_id").orderBy("l_linenumber", "product_id", "l_suppkey", "l_shipdate", "l_quantity")
        named = self.table("lineitem").select(
            F.col("l_orderkey").alias("sales_order_id"), F.col("l_partkey").alias("product_id"), "l_linenumber", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice", "l_discount"
        )
        lines = named.withColumn("_place", F.row_number().over(place)).select(
            (F.col("sales_order_id") * 10000 + F.col("_place")).alias("sales_order_detail_id"), "sales_order_id", "product_id", F.col("l_quantity").cast("bigint").alias("order_qty"),
            money(F.expr("(cast(round(l_extendedprice * 100) as bigint) * 100) div cast(l_quantity as bigint)")).alias("unit_price"),
            F.col("l_discount").cast("decimal(5,2)").alias("unit_price_discount"),
        )
        total = F.round(F.col("order_qty").cast("decimal(5,0)") * F.col("unit_price").cast("decimal(14,4)") * (F.lit(1).cast("decimal(3,2)") - F.col("unit_price_discount")), 4)
        return lines.withColumn("line_total", total.cast(MONEY))

    def customer(self) -> DataFrame:
        store = F.col("c_mktsegment") == "MACHINERY"
        return self.table("customer").select(
            F.col("c_custkey").alias("customer_id"), F.when(~store, F.col("c_custkey")).alias("person_id"), F.when(store, F.col("c_custkey")).alias("store_id"),
            F.col("c_nationkey").cast("bigint").alias("territory_id"), F.col("c_name").alias("account_number"),
        )

    def person(self) -> DataFrame:
        parts = F.split("c_name", "#")
        return self.table("customer").select(F.col("c_custkey").alias("business_entity_id"), parts[0].alias("first_name"), parts[1].alias("last_name"))

    def territory(self) -> DataFrame:
        regions = self.table("region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
        return self.table("nation").join(regions, "n_regionkey").select(
            F.col("n_nationkey").cast("bigint").alias("territory_id"), F.col("n_name").alias("territory_name"), F.substring("n_name", 1, 2).alias("country_region_code"), F.col("r_name").alias("territory_group")
        )

    def product(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"), F.concat(F.lit("P-"), F.col("p_partkey").cast("string")).alias("product_number"),
            F.col("p_brand").alias("product_line"), F.col("p_type").alias("class"), F.col("p_size").cast("string").alias("style"),
            money(F.round(F.col("p_retailprice") * 100).cast("bigint") * 100).alias("list_price"), F.lit(None).cast(MONEY).alias("standard_cost"), F.lit(False).alias("is_discontinued"),
        )

    def salesperson(self) -> DataFrame:
        return self.table("supplier").select(
            F.col("s_suppkey").alias("salesperson_id"), F.col("s_nationkey").cast("bigint").alias("territory_id"), F.col("s_name").alias("salesperson_name"),
            F.lit(0).cast("bigint").alias("sales_quota"), F.lit(0).cast("bigint").alias("bonus"), F.lit(0.0).alias("commission_pct"),
            F.lit("PERSON").alias("name_source"),
        )


_MONEY = "CAST(CAST({} AS DECIMAL(15,0)) * CAST('0.0001' AS DECIMAL(5,4)) AS DECIMAL(19,4))"
#: The same relations for DuckDB; each name is a CTE.
RELATIONS: dict[str, str] = {
    "header": f"""SELECT o_orderkey AS sales_order_id, CAST(o_orderdate AS DATE) AS order_date, o_custkey AS customer_id,
        CASE WHEN o_orderstatus <> 'P' THEN seller END AS salesperson_id, CAST(c_nationkey AS BIGINT) AS territory_id,
        {_MONEY.format("CAST(round(o_totalprice * 100) AS BIGINT) * 100")} AS total_due, o_orderstatus AS status_code
        FROM orders LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS seller FROM lineitem GROUP BY 1) s ON l_orderkey = o_orderkey LEFT JOIN customer ON c_custkey = o_custkey""",
    "priced": f"""SELECT l_orderkey * 10000 + row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity) AS sales_order_detail_id,
        l_orderkey AS sales_order_id, l_partkey AS product_id, CAST(l_quantity AS BIGINT) AS order_qty,
        {_MONEY.format("(CAST(round(l_extendedprice * 100) AS BIGINT) * 100) // CAST(l_quantity AS BIGINT)")} AS unit_price, CAST(l_discount AS DECIMAL(5,2)) AS unit_price_discount FROM lineitem""",
    "detail": """SELECT *, CAST(round(CAST(order_qty AS DECIMAL(5,0)) * CAST(unit_price AS DECIMAL(14,4)) * (CAST(1 AS DECIMAL(3,2)) - unit_price_discount), 4) AS DECIMAL(19,4)) AS line_total FROM priced""",
    "cust": """SELECT c_custkey AS customer_id, CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_custkey END AS person_id, CASE WHEN c_mktsegment = 'MACHINERY' THEN c_custkey END AS store_id,
        CAST(c_nationkey AS BIGINT) AS territory_id, c_name AS account_number FROM customer""",
    "person": "SELECT c_custkey AS business_entity_id, split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name FROM customer",
    "territory": """SELECT CAST(n_nationkey AS BIGINT) AS territory_id, n_name AS territory_name, substr(n_name, 1, 2) AS country_region_code, r_name AS territory_group
        FROM nation JOIN region ON r_regionkey = n_regionkey""",
    "product": f"""SELECT p_partkey AS product_id, p_name AS product_name, 'P-' || CAST(p_partkey AS VARCHAR) AS product_number, p_brand AS product_line, p_type AS class, CAST(p_size AS VARCHAR) AS style,
        {_MONEY.format("CAST(round(p_retailprice * 100) AS BIGINT) * 100")} AS list_price, CAST(NULL AS DECIMAL(19,4)) AS standard_cost, false AS is_discontinued FROM part""",
    "salesperson": """SELECT s_suppkey AS salesperson_id, CAST(s_nationkey AS BIGINT) AS territory_id, s_name AS salesperson_name, CAST(0 AS BIGINT) AS sales_quota, CAST(0 AS BIGINT) AS bonus,
        CAST(0.0 AS DOUBLE) AS commission_pct, 'PERSON' AS name_source FROM supplier""",
}


def with_relations(body: str, *names: str, **more: str) -> str:
    """A query whose CTEs are the named relations, then the given ones."""
    wanted = [n for n in RELATIONS if n in names or (n == "priced" and "detail" in names)]
    parts = [f"{n} AS ({RELATIONS[n]})" for n in wanted] + [f"{n} AS ({sql})" for n, sql in more.items()]
    return f"WITH {', '.join(parts)} {body}"
