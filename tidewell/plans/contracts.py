"""Table contracts: names, keys, columns, types, foreign keys, states."""

from __future__ import annotations

from dataclasses import dataclass, field
from enum import StrEnum

from pyspark.sql import types as T

from tidewell.functions.identity import safe_name


class Status(StrEnum):
    """States of runs, tables and batches."""

    STARTED = "STARTED"
    READING = "READING"
    VALIDATING = "VALIDATING"
    LOADING = "LOADING"
    SUCCESS = "SUCCESS"
    SUCCESS_WITH_REJECTIONS = "SUCCESS_WITH_REJECTIONS"
    PARTIAL_SUCCESS = "PARTIAL_SUCCESS"
    FAILED = "FAILED"
    RETRYING = "RETRYING"
    QUARANTINED = "QUARANTINED"
    PUBLISHED = "PUBLISHED"


GOOD = (Status.SUCCESS, Status.SUCCESS_WITH_REJECTIONS)


@dataclass(frozen=True)
class TableSpec:
    """A source table and its Bronze target; incremental loads go by the ordering key."""

    source: str
    target: str
    key: str
    required: tuple[str, ...]
    ordering: str = ""

    def __post_init__(self):
        for name in (self.source, self.target, self.key, *self.required):
            safe_name(name)
        if self.key not in self.required:
            raise ValueError(f"{self.target}: the key must be among the required columns")

    @property
    def order_by(self) -> str:
        return self.ordering or self.key


@dataclass(frozen=True)
class ModelSpec:
    """A Silver or Gold table: its exact columns and types, required values and foreign keys."""

    name: str
    key: str
    schema: T.StructType
    required: tuple[str, ...] = ()
    foreign_keys: dict[str, tuple[str, str]] = field(default_factory=dict)
    batched: bool = False

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(self.schema.fieldNames())


_TYPES = {"BIGINT": T.LongType(), "STRING": T.StringType(), "DATE": T.DateType(), "BOOLEAN": T.BooleanType(), "DECIMAL(19,4)": T.DecimalType(19, 4)}


def _spec(name: str, key: str, columns: str, *required: str, **more) -> ModelSpec:
    """columns: "name TYPE, ..."; read here, as Spark's own reader needs a session."""
    pairs = [c.split(" ") for c in columns.split(", ")]
    return ModelSpec(name, key, T.StructType([T.StructField(n, _TYPES[t]) for n, t in pairs]), required, **more)


#: The tables of each layer.
BRONZE = {
    s.target: s
    for s in (
        TableSpec("SalesOrderHeader", "sales_order_header", "SalesOrderID", ("SalesOrderID", "OrderDate", "CustomerID")),
        TableSpec("SalesOrderDetail", "sales_order_detail", "SalesOrderDetailID", ("SalesOrderDetailID", "SalesOrderID", "ProductID", "OrderQty", "UnitPrice", "LineTotal")),
        TableSpec("Customer", "customer", "CustomerID", ("CustomerID", "PersonID", "StoreID", "AccountNumber")),
        TableSpec("SalesTerritory", "sales_territory", "TerritoryID", ("TerritoryID", "Name", "CountryRegionCode", "Group")),
        TableSpec("SalesPerson", "sales_person", "BusinessEntityID", ("BusinessEntityID", "TerritoryID")),
        TableSpec("Person", "person", "BusinessEntityID", ("BusinessEntityID", "FirstName", "LastName")),
        TableSpec("Product", "product", "ProductID", ("ProductID", "Name", "ProductNumber", "ListPrice")),
    )
}
SILVER = {
    "sales_order_header": _spec("sales_order_header_clean", "sales_order_id", "sales_order_id BIGINT, order_date DATE, customer_id STRING, territory_id BIGINT, salesperson_id BIGINT, total_due DECIMAL(19,4), _source_system STRING, _load_date STRING", "customer_id", "order_date"),
    "sales_order_detail": _spec("sales_order_detail_clean", "sales_order_detail_id", "sales_order_detail_id BIGINT, sales_order_id BIGINT, product_id BIGINT, order_qty BIGINT, unit_price DECIMAL(19,4), unit_price_discount DECIMAL(19,4), line_total DECIMAL(19,4), _source_system STRING, _load_date STRING", "sales_order_id", "product_id"),
    "customer": _spec("customer_clean", "customer_id", "customer_id BIGINT, customer_name STRING, customer_type STRING, customer_name_source STRING, person_id BIGINT, store_id BIGINT, territory_id BIGINT, account_number STRING, _source_system STRING, _load_date STRING", "customer_name"),
    "sales_territory": _spec("sales_territory_clean", "territory_id", "territory_id BIGINT, territory_name STRING, country_region_code STRING, territory_group STRING, _source_system STRING, _load_date STRING", "territory_name"),
    "sales_person": _spec("sales_person_clean", "salesperson_id", "salesperson_id BIGINT, business_entity_id BIGINT, territory_id BIGINT, salesperson_name STRING, sales_quota DECIMAL(19,4), bonus DECIMAL(19,4), commission_pct DECIMAL(19,4), name_source STRING, _source_system STRING, _load_date STRING", "salesperson_name"),
    "product": _spec("product_clean", "product_id", "product_id BIGINT, product_name STRING, product_number STRING, product_line STRING, class STRING, style STRING, list_price DECIMAL(19,4), standard_cost DECIMAL(19,4), is_discontinued BOOLEAN, _source_system STRING, _load_date STRING", "product_name"),
}
GOLD = {
    s.name: s
    for s in (
        _spec("dim_date", "date_id", "date_id BIGINT, full_date DATE, year BIGINT, quarter BIGINT, month BIGINT, month_name STRING, day BIGINT, is_weekend BOOLEAN"),
        _spec("dim_customer", "customer_id", "customer_id BIGINT, customer_name STRING, customer_type STRING, customer_name_source STRING, person_id BIGINT, store_id BIGINT, territory_id BIGINT, account_number STRING"),
        _spec("dim_product", "product_id", "product_id BIGINT, product_name STRING, product_number STRING, product_line STRING, product_class STRING, product_style STRING, list_price DECIMAL(19,4), standard_cost DECIMAL(19,4), is_discontinued BOOLEAN"),
        _spec("dim_territory", "territory_id", "territory_id BIGINT, territory_name STRING, country_region_code STRING, territory_group STRING"),
        _spec("dim_salesperson", "salesperson_id", "salesperson_id BIGINT, territory_id BIGINT, salesperson_name STRING, sales_quota DECIMAL(19,4), bonus DECIMAL(19,4), commission_pct DECIMAL(19,4), name_source STRING"),
        _spec(
            "fact_sales", "sales_order_detail_id",
            "sales_order_detail_id BIGINT, sales_order_id BIGINT, order_date_id BIGINT, customer_id BIGINT, product_id BIGINT, territory_id BIGINT, salesperson_id BIGINT, order_qty BIGINT, unit_price DECIMAL(19,4), discount_amount DECIMAL(19,4), line_total DECIMAL(19,4), net_sales DECIMAL(19,4)",
            foreign_keys={"order_date_id": ("dim_date", "date_id"), "customer_id": ("dim_customer", "customer_id"), "product_id": ("dim_product", "product_id"), "territory_id": ("dim_territory", "territory_id"), "salesperson_id": ("dim_salesperson", "salesperson_id")},
            batched=True,
        ),
    )
}


def check_contract(spec: ModelSpec, specs: dict[str, ModelSpec]) -> list[str]:
    """What is wrong with a contract itself: keys that are no columns, foreign keys to nowhere."""
    wrong = [] if spec.key in spec.columns else [f"{spec.name}: key {spec.key} is no column"]
    for column, (parent, key) in spec.foreign_keys.items():
        if column not in spec.columns:
            wrong.append(f"{spec.name}: foreign key {column} is no column")
        if parent not in specs or specs[parent].key != key:
            wrong.append(f"{spec.name}: {column} refers to {parent}.{key}, which is no key")
    return wrong


def ddl(spec: ModelSpec) -> str:
    """CREATE TABLE text with informational keys, for catalogs that keep them."""
    columns = [f"{f.name} {f.dataType.simpleString().upper()}" + (" NOT NULL" if f.name == spec.key else "") for f in spec.schema.fields]
    keys = [f"PRIMARY KEY ({spec.key})"] + [f"FOREIGN KEY ({c}) REFERENCES {p} ({k})" for c, (p, k) in spec.foreign_keys.items()]
    return f"CREATE TABLE {spec.name} ({', '.join(columns + keys)})"
