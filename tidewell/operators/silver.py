"""Silver cleaners: pure DataFrame to DataFrame functions over raw (CamelCase, text) frames."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions.columns import full_name, strip, to_date, to_number
from tidewell.operators.quality import ConversionRules, dedup_by_signature, with_signature

#: Raw columns and their Silver names, per table, in the contract's order.
HEADER = {
    "SalesOrderID": "sales_order_id", "OrderDate": "order_date", "DueDate": "due_date", "ShipDate": "ship_date", "CustomerID": "customer_id", "SalesPersonID": "salesperson_id",
    "TerritoryID": "territory_id", "SubTotal": "subtotal", "TaxAmt": "tax_amt", "Freight": "freight", "TotalDue": "total_due", "OnlineOrderFlag": "is_online_order", "Status": "status_code",
}
DETAIL = {
    "SalesOrderID": "sales_order_id", "SalesOrderDetailID": "sales_order_detail_id", "ProductID": "product_id", "OrderQty": "order_qty", "UnitPrice": "unit_price",
    "UnitPriceDiscount": "unit_price_discount", "LineTotal": "line_total",
}
CUSTOMER = {"CustomerID": "customer_id", "PersonID": "person_id", "StoreID": "store_id", "TerritoryID": "territory_id", "AccountNumber": "account_number"}
TERRITORY = {"TerritoryID": "territory_id", "Name": "territory_name", "CountryRegionCode": "country_region_code", "Group": "territory_group"}
SALESPERSON = {"BusinessEntityID": "salesperson_id", "TerritoryID": "territory_id", "SalesQuota": "sales_quota", "Bonus": "bonus", "CommissionPct": "commission_pct"}
PRODUCT = {
    "ProductID": "product_id", "Name": "product_name", "ProductNumber": "product_number", "ProductLine": "product_line", "Class": "class", "Style": "style",
    "ListPrice": "list_price", "StandardCost": "standard_cost", "DiscontinuedDate": "discontinued_date",
}
LINEAGE = ("_source_system", "_load_date", "_record_hash")

#: Which raw columns must convert, or must not be blank, per table.
RULES: dict[str, ConversionRules] = {
    "sales_order_header": ConversionRules(("OrderDate", "DueDate", "ShipDate"), ("SubTotal", "TaxAmt", "Freight", "TotalDue"), ("SalesOrderID", "CustomerID")),
    "sales_order_detail": ConversionRules((), ("UnitPrice", "UnitPriceDiscount", "LineTotal"), ("SalesOrderDetailID", "SalesOrderID", "ProductID", "OrderQty")),
    "customer": ConversionRules(integers=("CustomerID",), texts=("AccountNumber",)),
    "sales_territory": ConversionRules(integers=("TerritoryID",), texts=("Name", "CountryRegionCode", "Group")),
    "sales_person": ConversionRules((), ("SalesQuota", "Bonus", "CommissionPct"), ("BusinessEntityID",)),
    "product": ConversionRules((), ("ListPrice", "StandardCost"), ("ProductID",), ("Name", "ProductNumber")),
}


def _named(frame: DataFrame, names: dict[str, str]) -> DataFrame:
    """Renames what exists, adds what is missing (with source system and load date) as NULL, and drops the rest but lineage."""
    missing = {old: F.lit(None).cast("string") for old in (*names, *LINEAGE[:2]) if old not in frame.columns}
    full = frame.withColumns(missing) if missing else frame
    return full.select(*[F.col(c).alias(names.get(c, c)) for c in (*names, *[c for c in LINEAGE if c in full.columns])])


def _finished(frame: DataFrame, key: str, columns: list[str], signature: bool) -> DataFrame:
    """One row a key, in the contract's columns, with source system and load date, and the record hash if there
    is one.  With signature, all rows, with what decides between those of one load date: they are merged with
    others of their keys, which takes one row a key anyway.  The sink puts rows in key order."""
    signed = with_signature(frame, key)
    rows = signed if signature else dedup_by_signature(signed, key, "_signature")
    return rows.select(*columns, *[c for c in LINEAGE if c in frame.columns], *(["_signature"] if signature else []))


def clean_header(frame: DataFrame, signature: bool = False) -> DataFrame:
    dates, amounts = ("order_date", "due_date", "ship_date"), ("subtotal", "tax_amt", "freight", "total_due")
    converted = _named(frame, HEADER).withColumns({c: to_date(F.col(c).cast("string")) for c in dates} | {c: to_number(F.col(c)) for c in amounts})
    return _finished(converted, "sales_order_id", list(HEADER.values()), signature)


def clean_detail(frame: DataFrame, signature: bool = False) -> DataFrame:
    named = _named(frame, DETAIL)
    converted = named.withColumns({c: to_number(F.col(c)) for c in ("unit_price", "unit_price_discount", "line_total")} | {"order_qty": F.col("order_qty").cast("string").try_cast("bigint")})
    return _finished(converted, "sales_order_detail_id", list(DETAIL.values()), signature)


def one_person(people: DataFrame, key: str = "BusinessEntityID") -> DataFrame:
    """Each person once: the least first, then last name, so that the choice is the same every run."""
    place = Window.partitionBy(key).orderBy(F.col("FirstName").asc_nulls_last(), F.col("LastName").asc_nulls_last())
    return people.withColumn("_place", F.row_number().over(place)).where("_place = 1").select(F.col(key).alias("_person"), F.col("FirstName").alias("_first"), F.col("LastName").alias("_last"))


def clean_customer(frame: DataFrame, people: DataFrame, signature: bool = False) -> DataFrame:
    """Individuals are named by their person and stores by their account; an individual without both
    names raises when the row is read."""
    named = _named(frame, CUSTOMER).withColumn("account_number", strip("account_number"))
    individual = F.col("person_id").isNotNull()
    joined = named.join(one_person(people), F.col("person_id") == F.col("_person"), "left")
    unresolved = individual & (F.col("_first").isNull() | F.col("_last").isNull())
    name = (
        F.when(unresolved, F.raise_error(F.concat(F.lit("customer without a resolved name: "), F.col("customer_id").cast("string"))).cast("string"))
        .when(individual, full_name(F.col("_first"), F.col("_last"))).otherwise(F.col("account_number"))
    )
    typed = joined.withColumns(
        {"customer_type": F.when(individual, "INDIVIDUAL").otherwise("STORE"), "customer_name": name, "customer_name_source": F.when(individual, "PERSON").otherwise("ACCOUNT")}
    ).drop("_person", "_first", "_last")
    columns = ["customer_id", "customer_name", "customer_type", "customer_name_source", "person_id", "store_id", "territory_id", "account_number"]
    return _finished(typed, "customer_id", columns, signature)


def clean_territory(frame: DataFrame, signature: bool = False) -> DataFrame:
    return _finished(_named(frame, TERRITORY).withColumn("territory_name", strip("territory_name")), "territory_id", list(TERRITORY.values()), signature)


def clean_salesperson(frame: DataFrame, people: DataFrame, signature: bool = False) -> DataFrame:
    """Missing names become an empty text, which validation rejects later."""
    named = _named(frame, SALESPERSON)
    numbers = {c: to_number(F.col(c)) for c in ("sales_quota", "bonus", "commission_pct")}
    joined = named.withColumns(numbers).join(one_person(people), F.col("salesperson_id") == F.col("_person"), "left")
    typed = joined.withColumns({"business_entity_id": F.col("salesperson_id"), "salesperson_name": full_name(F.col("_first"), F.col("_last")), "name_source": F.lit("PERSON")}).drop("_person", "_first", "_last")
    columns = ["salesperson_id", "business_entity_id", "territory_id", "salesperson_name", "sales_quota", "bonus", "commission_pct", "name_source"]
    return _finished(typed, "salesperson_id", columns, signature)


def rebuild_salespeople(frame: DataFrame, people: DataFrame, person_type: str = "SP") -> DataFrame:
    """The one-off repair: names from people of one type only, joined on the key as text."""
    keyed = people.where(F.col("PersonType") == person_type).withColumn("BusinessEntityID", F.col("BusinessEntityID").cast("string"))
    return clean_salesperson(frame.withColumn("BusinessEntityID", F.col("BusinessEntityID").cast("string")), keyed)


def clean_product(frame: DataFrame, signature: bool = False) -> DataFrame:
    named = _named(frame, PRODUCT)
    typed = named.withColumns(
        {"list_price": to_number(F.col("list_price")), "standard_cost": to_number(F.col("standard_cost")), "product_name": strip("product_name"), "is_discontinued": F.col("discontinued_date").isNotNull()}
    )
    columns = ["product_id", "product_name", "product_number", "product_line", "class", "style", "list_price", "standard_cost", "is_discontinued"]
    return _finished(typed, "product_id", columns, signature)


#: Cleaners of one frame; those of customers and salespeople also take the people.
CLEANERS: dict[str, Callable[..., DataFrame]] = {
    "sales_order_header": clean_header, "sales_order_detail": clean_detail, "customer": clean_customer,
    "sales_territory": clean_territory, "sales_person": clean_salesperson, "product": clean_product,
}
