"""Raw Bronze frames made of the warehouse tables with deterministic dirt, in Spark and in SQL.

Orders and customers get unconvertible texts at fixed remainders of their ids and a newer copy of
every seventh row, so that quarantine and dedup have something to do; SQL makes the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.functions.columns import record_hash
from tidewell.sources.adapter import SalesTables

OLD, NEW = "2024-09-01", "2024-09-02"


def with_lineage(df: DataFrame, source_table: str, load_date: str | None = None, system: str = "sales_oltp") -> DataFrame:
    """Adds source system and table, load date (unless it is there) and the hash of the business columns."""
    business = [c for c in df.columns if not c.startswith("_")]
    stamped = df.withColumns({"_source_system": F.lit(system), "_source_table": F.lit(source_table)})
    stamped = stamped.withColumn("_load_date", F.lit(load_date)) if load_date is not None else stamped
    return stamped.withColumn("_record_hash", record_hash(business))


def raw_header(t: SalesTables) -> DataFrame:
    key = F.col("sales_order_id")
    total = F.col("total_due")

    def copy(amount, load_date):
        return [
            key.alias("SalesOrderID"), F.when(key % 97 == 0, "not-a-date").otherwise(F.col("order_date").cast("string")).alias("OrderDate"),
            F.when(key % 101 == 0, "12.5").otherwise(F.col("customer_id").cast("string")).alias("CustomerID"), F.col("salesperson_id").alias("SalesPersonID"), F.col("territory_id").alias("TerritoryID"),
            F.when(key % 89 == 0, "abc").otherwise(amount.cast("decimal(19,4)").cast("string")).alias("TotalDue"), F.col("status_code").alias("Status"),
            F.date_add("order_date", 12).cast("string").alias("DueDate"), F.date_add("order_date", 7).cast("string").alias("ShipDate"),
            (amount - F.lit("3.75").cast("decimal(3,2)")).cast("decimal(19,4)").cast("string").alias("SubTotal"), F.lit("2.5000").alias("TaxAmt"), F.lit("1.2500").alias("Freight"),
            (key % 2 == 0).alias("OnlineOrderFlag"), F.lit(load_date).alias("_load_date"),
        ]

    base = t.header()
    rows = base.select(*copy(total, OLD)).unionByName(base.where(key % 7 == 0).select(*copy(total + 1, NEW)))
    return with_lineage(rows, "sales_order_header")


def raw_detail(t: SalesTables) -> DataFrame:
    key = F.col("sales_order_detail_id")
    rows = t.detail().select(
        F.col("sales_order_id").alias("SalesOrderID"), key.alias("SalesOrderDetailID"), F.col("product_id").alias("ProductID"),
        F.when(key % 103 == 0, "1.5").otherwise(F.col("order_qty").cast("string")).alias("OrderQty"), F.col("unit_price").cast("string").alias("UnitPrice"),
        F.col("unit_price_discount").cast("string").alias("UnitPriceDiscount"), F.when(key % 107 == 0, "1,000").otherwise(F.col("line_total").cast("string")).alias("LineTotal"),
    )
    return with_lineage(rows, "sales_order_detail", OLD)


def raw_customer(t: SalesTables) -> DataFrame:
    key = F.col("customer_id")

    def copy(account, load_date):
        return [key.alias("CustomerID"), F.col("person_id").alias("PersonID"), F.col("store_id").alias("StoreID"), F.col("territory_id").alias("TerritoryID"), account.alias("AccountNumber"), F.lit(load_date).alias("_load_date")]

    base = t.customer()
    first = F.when(key % 83 == 0, "   ").otherwise(F.concat(F.lit(" "), F.col("account_number"), F.lit("\t")))
    rows = base.select(*copy(first, OLD)).unionByName(base.where(key % 7 == 0).select(*copy(F.concat(F.col("account_number"), F.lit("-v2")), NEW)))
    return with_lineage(rows, "customer")


def raw_person(t: SalesTables) -> DataFrame:
    return t.person().select(F.col("business_entity_id").alias("BusinessEntityID"), F.col("first_name").alias("FirstName"), F.col("last_name").alias("LastName"))


def raw_territory(t: SalesTables) -> DataFrame:
    """Every eleventh territory's country and every thirteenth's group are blank."""
    key = F.col("territory_id")
    rows = t.territory().select(
        key.alias("TerritoryID"), F.concat(F.lit("  "), F.col("territory_name"), F.lit(" ")).alias("Name"), F.when(key % 11 == 0, " \t").otherwise(F.col("country_region_code")).alias("CountryRegionCode"),
        F.when(key % 13 == 0, "").otherwise(F.col("territory_group")).alias("Group"),
    )
    return with_lineage(rows, "sales_territory", OLD)


def raw_salesperson(t: SalesTables) -> DataFrame:
    """Every tenth salesperson's id names no person."""
    key = F.col("salesperson_id")
    rows = t.salesperson().select(
        F.when(key % 10 == 0, key + 100_000_000).otherwise(key).alias("BusinessEntityID"), F.col("territory_id").alias("TerritoryID"), F.lit("250000").alias("SalesQuota"),
        F.lit("0").alias("Bonus"), F.lit("0.0150").alias("CommissionPct"),
    )
    return with_lineage(rows, "sales_person", OLD)


def raw_product(t: SalesTables) -> DataFrame:
    key = F.col("product_id")
    rows = t.product().select(
        key.alias("ProductID"), F.concat(F.lit("  "), F.col("product_name"), F.lit("  ")).alias("Name"), F.when(key % 83 == 0, "  ").otherwise(F.col("product_number")).alias("ProductNumber"), F.col("product_line").alias("ProductLine"),
        F.col("class").alias("Class"), F.col("style").alias("Style"), F.when(key % 79 == 0, "n/a").otherwise(F.col("list_price").cast("string")).alias("ListPrice"), F.lit(None).cast("string").alias("StandardCost"),
        F.when(key % 5 == 0, "2024-01-01").alias("DiscontinuedDate"),
    )
    return with_lineage(rows, "product", OLD)


def hash_sql(*columns: str) -> str:
    values = ", ".join(f"coalesce(CAST(\"{c}\" AS VARCHAR), '\\N')" for c in sorted(columns))
    return f"sha256(concat_ws(chr(31), {values}))"


def _stamped(sql: str, source_table: str, columns: tuple[str, ...]) -> str:
    return f"SELECT *, 'sales_oltp' AS _source_system, '{source_table}' AS _source_table, {hash_sql(*columns)} AS _record_hash FROM ({sql})"


def _header_copy(amount: str, load_date: str) -> str:
    return f"""SELECT sales_order_id AS SalesOrderID, CASE WHEN sales_order_id % 97 = 0 THEN 'not-a-date' ELSE CAST(order_date AS VARCHAR) END AS OrderDate,
    CASE WHEN sales_order_id % 101 = 0 THEN '12.5' ELSE CAST(customer_id AS VARCHAR) END AS CustomerID, salesperson_id AS SalesPersonID, territory_id AS TerritoryID,
    CASE WHEN sales_order_id % 89 = 0 THEN 'abc' ELSE CAST(CAST({amount} AS DECIMAL(19,4)) AS VARCHAR) END AS TotalDue, status_code AS Status,
    CAST(order_date + 12 AS VARCHAR) AS DueDate, CAST(order_date + 7 AS VARCHAR) AS ShipDate, CAST(CAST({amount} - 3.75 AS DECIMAL(19,4)) AS VARCHAR) AS SubTotal, '2.5000' AS TaxAmt, '1.2500' AS Freight,
    sales_order_id % 2 = 0 AS OnlineOrderFlag, '{load_date}' AS _load_date FROM header"""


_HEADER = ("SalesOrderID", "OrderDate", "CustomerID", "SalesPersonID", "TerritoryID", "TotalDue", "Status", "DueDate", "ShipDate", "SubTotal", "TaxAmt", "Freight", "OnlineOrderFlag")
_CUSTOMER = ("CustomerID", "PersonID", "StoreID", "TerritoryID", "AccountNumber")
#: The raw frames for DuckDB, over the relations of the adapter.
RAW: dict[str, str] = {
    "raw_header": _stamped(f"{_header_copy('total_due', OLD)} UNION ALL {_header_copy('total_due + 1', NEW)} WHERE sales_order_id % 7 = 0", "sales_order_header", _HEADER),
    "raw_detail": _stamped(
        f"""SELECT sales_order_id AS SalesOrderID, sales_order_detail_id AS SalesOrderDetailID, product_id AS ProductID, CASE WHEN sales_order_detail_id % 103 = 0 THEN '1.5' ELSE CAST(order_qty AS VARCHAR) END AS OrderQty,
        CAST(unit_price AS VARCHAR) AS UnitPrice, CAST(unit_price_discount AS VARCHAR) AS UnitPriceDiscount, CASE WHEN sales_order_detail_id % 107 = 0 THEN '1,000' ELSE CAST(line_total AS VARCHAR) END AS LineTotal, '{OLD}' AS _load_date FROM detail""",
        "sales_order_detail", ("SalesOrderID", "SalesOrderDetailID", "ProductID", "OrderQty", "UnitPrice", "UnitPriceDiscount", "LineTotal"),
    ),
    "raw_customer": _stamped(
        f"""SELECT customer_id AS CustomerID, person_id AS PersonID, store_id AS StoreID, territory_id AS TerritoryID, CASE WHEN customer_id % 83 = 0 THEN '   ' ELSE ' ' || account_number || chr(9) END AS AccountNumber, '{OLD}' AS _load_date FROM cust
        UNION ALL SELECT customer_id, person_id, store_id, territory_id, account_number || '-v2', '{NEW}' FROM cust WHERE customer_id % 7 = 0""",
        "customer", _CUSTOMER,
    ),
    "raw_territory": _stamped(
        f"""SELECT territory_id AS TerritoryID, '  ' || territory_name || ' ' AS Name, CASE WHEN territory_id % 11 = 0 THEN ' ' || chr(9) ELSE country_region_code END AS CountryRegionCode,
        CASE WHEN territory_id % 13 = 0 THEN '' ELSE territory_group END AS "Group", '{OLD}' AS _load_date FROM territory""",
        "sales_territory", ("TerritoryID", "Name", "CountryRegionCode", "Group"),
    ),
    "raw_salesperson": _stamped(
        f"""SELECT CASE WHEN salesperson_id % 10 = 0 THEN salesperson_id + 100000000 ELSE salesperson_id END AS BusinessEntityID, territory_id AS TerritoryID, '250000' AS SalesQuota, '0' AS Bonus, '0.0150' AS CommissionPct,
        '{OLD}' AS _load_date FROM salesperson""",
        "sales_person", ("BusinessEntityID", "TerritoryID", "SalesQuota", "Bonus", "CommissionPct"),
    ),
    "raw_product": _stamped(
        f"""SELECT product_id AS ProductID, '  ' || product_name || '  ' AS Name, CASE WHEN product_id % 83 = 0 THEN '  ' ELSE product_number END AS ProductNumber, product_line AS ProductLine, class AS Class, style AS Style,
        CASE WHEN product_id % 79 = 0 THEN 'n/a' ELSE CAST(list_price AS VARCHAR) END AS ListPrice, CAST(NULL AS VARCHAR) AS StandardCost, CASE WHEN product_id % 5 = 0 THEN '2024-01-01' END AS DiscontinuedDate, '{OLD}' AS _load_date FROM product""",
        "product", ("ProductID", "Name", "ProductNumber", "ProductLine", "Class", "Style", "ListPrice", "StandardCost", "DiscontinuedDate"),
    ),
}
